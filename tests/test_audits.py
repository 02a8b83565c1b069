"""Named checks, fingerprints, window maxima and reports on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import audit, labels, pit


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_there_are_47_named_checks_and_each_can_fail(spark):
    t = ts("2025-06-01 12:00:00")
    late, early = ts("2025-06-01 12:00:01"), ts("2025-06-01 06:00:00")
    run = ", ".join(f"{r}_{w}:timestamp" for r in audit.ROLES for w in ("run_time", "available_time"))
    kind = f"struct<{run.replace(' ', '')},complete:boolean>"
    stations = ["KNYC", "KLGA", "KJFK", "KEWR"]
    schema = "id int, query_time timestamp, " + ", ".join(f"{s} {kind}" for s in audit.SOURCES) + ", " + ", ".join(f"{n}_time timestamp" for n in stations) + ", afd_time timestamp"
    good, bad = (*[early] * 6, True), (*[late] * 6, False)
    rows = [(1, t, *[good] * 6, *[early] * 4, early), (2, t, *[bad] * 6, *[late] * 4, late), (3, t, *[None] * 11), (4, t, (None, None, None, late, None, None, None), *[None] * 10)]
    rules = audit.state_rules(stations)
    assert len(rules) == 47
    found = {}
    for r in audit.violations(spark.createDataFrame(rows, schema), ["id"], rules).collect():
        found.setdefault(r["id"], set()).add(r["check_name"])
    assert found == {2: set(rules), 4: {"hrrr_latest_usable_available_time_le_t"}}


def test_a_fingerprint_knows_points_not_their_order(spark):
    points = [("a", 40.0 + i / 4, -74.0 - j / 4) for i in range(5) for j in range(7)]
    one = spark.createDataFrame(points, "s string, y double, x double")
    again = spark.createDataFrame(points[::-1] + points[:3], "s string, y double, x double").repartition(3)
    moved = spark.createDataFrame([*points[1:], ("a", 40.0, -74.25001), ("b", 1.0, 1.0)], "s string, y double, x double")
    f = lambda d: audit.fingerprint(d, ["s"], "y", "x")
    assert f(one).collect() == f(again).collect()
    assert f(one).first()["n_lat"] == 5 and f(one).first()["n_lon"] == 7
    got = {r["s"]: r["status"] for r in audit.grid_check(f(one), f(moved), ["s"], F.lit(1.0)).collect()}
    assert got == {"a": "FLAGGED_FOR_INVESTIGATION", "b": "PROBE_FAILED"}
    assert [r["status"] for r in audit.grid_check(f(one), f(again), ["s"], F.lit(1.0)).collect()] == ["PASS"]
    assert [r["status"] for r in audit.grid_check(f(one), f(again), ["s"], F.lit(26.0)).collect()] == ["FLAGGED_FOR_INVESTIGATION"]


def test_windows_cover_a_day_however_long_it_is(spark):
    days = pit.local_days(spark.sql("SELECT DATE'2025-03-09' AS day UNION ALL SELECT DATE'2025-03-10'"))  # 23 hours, 24 hours
    bounds = {str(r["day"]): (r["day_start"], r["day_end"]) for r in days.collect()}
    start, end = bounds["2025-03-09"]
    hour = dt.timedelta(hours=1)
    rows, at, k = [], start, 0
    while at < end:  # windows of six hours and less, up to the day's end
        stop = min(at + 6 * hour, end)
        rows.append(("m", start, at, stop, 50.0 + k))
        at, k = stop, k + 1
    rows += [("m", start, start, start + 3 * hour, 49.0), ("m", start, end - hour, end + 5 * hour, 90.0), ("m", start, end, end, 99.0)]
    got = {str(r["day"]): r for r in pit.window_maxima(spark.createDataFrame(rows, "source string, run_time timestamp, start_time timestamp, end_time timestamp, value double"), days).collect()}
    a, b = got["2025-03-09"], got["2025-03-10"]
    assert (a["covered_hours"], a["full_day_coverage"], a["reconstructed_max"], a["n_windows"], a["n_straddling"]) == (23.0, True, 53.0, 5, 1)
    assert (b["covered_hours"], b["full_day_coverage"], b["reconstructed_max"], b["n_straddling"]) == (0.0, False, None, 1)


def test_label_report(spark):
    schema = "target_date date, n_final_candidates int, n_preliminary_rejected long, label_f double, label_status string, issuance_time timestamp, product_id string, selection_error string"
    day = lambda n: dt.date(2025, 1, n)
    at = ts("2025-01-09 06:00:00")
    rows = [(day(1), 1, 0, 30.0, "OK", at, "a", None), (day(2), 2, 1, 300.0, "OK", at, "b", None), (day(3), 0, 0, None, "LABEL_UNAVAILABLE_CLINYC", None, None, None), (day(4), 2, 0, None, None, None, None, "irreducible tie"), (day(1), 1, 0, 31.0, "OK", None, "c", None)]
    got = {r["metric"]: r["value"] for r in labels.report(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"n_days_expected": 5, "n_days_available": 3, "n_days_missing": 1, "multi_final_days": 1, "days_with_preliminary_rejected": 1, "selection_errors": 1, "impossible_values": 1, "provenance_gaps": 1, "duplicate_target_dates": 1, "coverage_pct": 60.0}
