"""A block of one day: all layers of its states, and the audits that must find nothing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import audit, pit, states

DAY = dt.date(2025, 7, 2)
UTC = dt.UTC
FORECAST = "source string, run_time timestamp, ensemble_member string, member_type string, variable string, level string, forecast_hour int, valid_time timestamp, available_time timestamp, value double, value_f double, units string, temporal_stat string, temporal_window_hours int"


def forecast_rows():
    rows = []
    for source, variable, hours in (("hrrr", "TMP", range(49)), ("gfs", "TMP", range(121)), ("nbm", "TMP", range(1, 37)), ("ecmwf_deterministic", "2t", range(0, 145, 3))):
        for run in (dt.datetime(2025, 7, 1, 0, tzinfo=UTC), dt.datetime(2025, 7, 2, 0, tzinfo=UTC)):
            for h in hours:
                for v in (variable, "RH"):
                    rows.append((source, run, None, None, v, "2 m", h, run + dt.timedelta(hours=h), run + dt.timedelta(hours=4), 300.0, 70.0 + run.day + h / 100, "K", "instant", None))
    run = dt.datetime(2025, 7, 1, 0, tzinfo=UTC)
    for m in range(31):
        for h in range(0, 61, 3):
            rows.append(("gefs", run, f"gep{m:02d}", "perturbed", "TMP", "2 m", h, run + dt.timedelta(hours=h), run + dt.timedelta(hours=6), 300.0, 60.0 + m, "K", "instant", None))
    return rows


@pytest.fixture(scope="module")
def parts(spark):
    grid = times.state_grid(spark.createDataFrame([(DAY,)], "day date"))
    at = lambda h, m=0: dt.datetime(2025, 7, 2, h, m, tzinfo=UTC)
    obs = [("725053-94728", at(h, 51), 60.0 + h, 50.0, 3.0, 1010.0, True) for h in range(4, 20)] + [("725030-14732", at(9), 99.0, 50.0, 3.0, 1010.0, True), ("725030-14732", at(10), 0.0, 0.0, 0.0, 0.0, False)]
    o = spark.createDataFrame(obs, "station_id string, observation_time timestamp, temperature_f double, dewpoint_f double, wind_speed_ms double, station_pressure_hpa double, is_real_observation boolean")
    b = spark.createDataFrame([("a", at(2), "HEAD\n.SYNOPSIS...\nfine\n"), ("b", at(12, 30), "HEAD\n.NEAR TERM...\nhot\n.MARINE...\ncalm\n")], "product_id string, issuance_time timestamp, raw_text string")
    return states.Parts(grid, spark.createDataFrame(forecast_rows(), FORECAST), o, b, pit.schedules(spark))


def test_wide_rows(parts, spark):
    f = states.structured_features(parts, spark.createDataFrame([(DAY, 90.0, None, 24, 60.0, "OK")], "day date, label_tmax_f double, label_time_of_max timestamp, label_observation_count int, label_largest_gap_minutes double, label_quality string")).cache()
    assert f.count() == 12 and len(f.columns) == 131
    r = {(x["local_hour"], x["state_mode"]): x for x in f.collect()}
    early, noon = r[6, "proxy"], r[12, "proxy"]
    assert early["hrrr_usable_for_daily_max"] and early["hrrr_run"].day == 2 and early["hrrr_forecast_tmax_f"] == pytest.approx(72.27)
    assert early["hrrr_previous_run"].day == 1 and early["hrrr_revision_f"] == pytest.approx(72.27 - 71.48)  # 48 hours don't reach the day's end
    assert early["nbm_run"].day == 2 and early["nbm_previous_run"] is None
    assert early["gefs_tmax_mean_f"] == 75.0 and early["gefs_member_count_available"] == 31
    assert early["KNYC_current_temp_f"] == 69.0 and early["KLGA_available"] and not noon["KLGA_available"] and noon["KLGA_tmax_so_far_f"] == 99.0
    assert noon["afd_product_id"] == "b" and early["afd_product_id"] == "a"
    strict = r[12, "strict"]
    assert strict["KNYC_current_temp_f"] is None and not strict["afd_available"] and strict["hrrr_run"] == noon["hrrr_run"]
    assert strict["label_tmax_f"] == 90.0
    assert audit.exposed(f, "state_mode", ["KNYC_current_temp_f", "afd_product_id"]).isEmpty()
    assert audit.policies_differ(f, ["target_date", "local_hour"], "state_mode", "hrrr_forecast_tmax_f").isEmpty()
    assert audit.lookahead(f, "query_time_utc", ["hrrr_usable_since", "gefs_usable_since", "KNYC_latest_observation_time_utc", "afd_issuance_time"]).isEmpty()
    assert audit.leakage_columns(spark, f).isEmpty()


def test_long_tables(parts):
    t = states.forecast_trajectories(parts)
    assert t.filter("source = 'gfs'").count() == 12 * 24
    assert audit.without_detail(parts.runs.filter(F.col("source").isin(*states.MODELS)), "usable_for_daily_max", t, ["state_id", "source"]).isEmpty()
    assert states.gefs_members(parts).count() == 12 * 31
    a = states.atmospheric_trajectories(parts)
    assert {r[0] for r in a.select("variable").distinct().collect()} == {"RH"}
    assert audit.inconsistent_hours(a, "run_time", "valid_time", "forecast_hour").isEmpty()
    assert states.gefs_member_trajectories(parts).count() == 12 * 31 * 8
    h = {r["state_id"]: r[1] for r in states.highest_so_far(parts).collect()}
    assert max(h.values()) == 99.0


def test_documents(parts):
    d = [json.loads(r["input"]) for r in states.weather_input(parts).collect()]
    assert len(d) == 12
    late = [x for x in d if x["target"]["local_hour"] == 16 and "afd" in x][0]
    assert [s["section_name"] for s in late["afd"]["sections"]] == ["NEAR TERM"]
    left = late["models"]["gfs"]["remaining_target_day_trajectory"]
    assert left[0]["local_hour"] == 16 and len(left) == 8
    assert late["cross_model"]["forecast_count"] == 5
    assert states.size_audit(states.weather_input(parts)).first()["n"] == 12
