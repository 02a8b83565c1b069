"""Point-in-time rules on small frames: freshness, completeness, no lookahead, days of 23 and 25 hours, ids."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import observations, times
from tidemark.operators import pit
from tidemark.operators.asof import asof_join

UTC = dt.UTC


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def days(spark, *names):
    return pit.local_days(spark.createDataFrame([(dt.date.fromisoformat(n),) for n in names], "day date"))


def test_query_times_follow_the_clock_change(spark):
    d = spark.createDataFrame([(dt.date(2025, 1, 15),), (dt.date(2025, 7, 15),), (dt.date(2025, 3, 9),), (dt.date(2025, 11, 2),)], "day date")
    hours = [r[0] for r in d.select(F.hour(times.local_query_time(F.col("day"), F.lit(6)))).collect()]
    assert hours == [11, 10, 10, 11]
    length = [round((r["day_end"] - r["day_start"]).total_seconds() / 3600) for r in pit.local_days(d).orderBy("day").collect()]
    assert length == [24, 23, 24, 25]


def test_state_ids_are_the_published_ones(spark):
    cal = times.calendar(spark, "2024-07-01", "2024-12-31")
    grid = times.state_grid(cal)
    ids = {r["state_id"] for r in grid.select("state_id").collect()}
    assert grid.count() == 2208 == len(ids)
    assert {"2ac6901eba30956b", "df97055b77bc5402", "8bcc3d6cd979a198", "79c47d995d97e11d", "0962bd0fda083977"} <= ids


def ensemble(spark, members, hours, run="2025-07-01T00:00:00", available="2025-07-01T04:00:00", source="gefs"):
    rows = [(source, at(run), f"gep{m:02d}", h, at(run) + dt.timedelta(hours=h), at(available), 70.0 + m) for m in members for h in hours]
    return spark.createDataFrame(rows, "source string, run_time timestamp, ensemble_member string, forecast_hour int, valid_time timestamp, available_time timestamp, value double")


DAY = "2025-07-02"
NEEDED = [h for h in range(0, 241, 3) if 28 <= h < 52]  # the local day of a midnight run


def complete(spark, rows):
    return {r["run_time"].hour: r for r in pit.run_completeness(rows, days(spark, DAY), pit.schedules(spark)).collect()}[0]


def test_ensemble_completeness(spark):
    full = complete(spark, ensemble(spark, range(31), NEEDED))
    assert (full["status"], full["points"], full["member_count"]) == ("COMPLETE", len(NEEDED), 31)
    assert complete(spark, ensemble(spark, range(30), NEEDED))["status"] == "INCOMPLETE"
    short = complete(spark, ensemble(spark, range(30), NEEDED).union(ensemble(spark, [30], NEEDED[:-1])))
    assert (short["status"], short["points"], short["member_count"]) == ("INCOMPLETE", len(NEEDED) - 1, 31)


def test_a_newer_partial_run_is_seen_but_not_used(spark):
    rows = ensemble(spark, range(31), NEEDED).union(ensemble(spark, range(5), [h - 6 for h in NEEDED], "2025-07-01T06:00:00", "2025-07-01T10:00:00"))
    d, s = days(spark, DAY), pit.schedules(spark)
    states = d.select(F.lit("s").alias("state_id"), "day", F.lit(at("2025-07-02T12:00:00")).alias("query_time"))
    r = pit.forecast_states(states, rows, d, s).first()
    assert r["usable_run"].hour == 0 and r["seen_run"].hour == 6 and r["newer_run_arriving"] and r["seen_status"] == "INCOMPLETE" and r["tmax"] == 100.0
    before = pit.forecast_states(states.withColumn("query_time", F.lit(at("2025-07-01T03:59:59"))), rows, d, s)
    assert before.isEmpty()  # nothing had been published yet


def test_wrong_variables_stay_out(spark):
    d = spark.createDataFrame([("gfs", "TMP"), ("gfs", "DPT"), ("ecmwf_deterministic", "2t"), ("ecmwf_deterministic", "mx2t3"), ("gefs", "TMAX")], "source string, variable string")
    assert sorted(map(tuple, pit.temperature_rows(d).collect())) == [("ecmwf_deterministic", "2t"), ("gfs", "TMP")]


def observed(spark, rows, t="2025-07-02T12:00:00"):
    o = spark.createDataFrame([(s, at(w), v) for s, w, v in rows], "station string, observation_time timestamp, temperature_f double")
    s = days(spark, DAY).select(F.lit("s").alias("state_id"), F.lit(at(t)).alias("query_time"), "day_start", "day_end")
    return {r["station"]: r for r in observations.state(o, s, ["station"]).collect()}


def test_freshness(spark):
    r = observed(spark, [("A", "2025-07-02T11:51:00", 71.0), ("B", "2025-07-02T06:00:00", 60.0), ("C", "2025-07-02T05:59:00", 61.0), ("D", "2025-07-02T12:05:00", 90.0)])
    assert r["A"]["available"] and r["A"]["current_f"] == 71.0 and not r["A"]["stale"]
    assert r["B"]["available"]  # exactly six hours old
    assert not r["C"]["available"] and r["C"]["current_f"] is None and r["C"]["age_minutes"] == 361.0
    assert not r["D"]["has_eligible"]  # five minutes in the future


def test_maximum_so_far_is_the_days_own(spark):
    r = observed(spark, [("A", "2025-07-01T20:00:00", 90.0), ("A", "2025-07-02T10:00:00", 65.0), ("A", "2025-07-02T11:00:00", 65.0), ("A", "2025-07-02T11:30:00", 64.0)])["A"]
    assert r["tmax_so_far_f"] == 65.0 and r["time_of_max_us"] == int(at("2025-07-02T10:00:00").timestamp() * 1e6)
    assert r["change_previous_f"] == -1.0 and r["change_1h_f"] == -1.0


def test_asof_keys_and_times_may_be_null(spark):
    left = spark.createDataFrame([(1, None, 5), (2, "a", None), (3, "a", 5), (4, None, 1)], "i int, k string, t long")
    right = spark.createDataFrame([("a", 4, "x"), (None, 5, "n"), ("a", None, "y")], "k string, u long, v string")
    got = {r["i"]: r["match"]["v"] if r["match"] else None for r in asof_join(left, right, ["k"], "t", "u", bucket_us=2).collect()}
    assert got == {1: "n", 2: None, 3: "x", 4: None}
    assert asof_join(left.limit(0), right, ["k"], "t", "u").isEmpty()
    assert [r["match"] for r in asof_join(left, right.limit(0), ["k"], "t", "u").collect()] == [None] * 4


def test_resumed_work_finds_nothing(spark):
    d = days(spark, DAY)
    plan = pit.work_plan(d, spark.createDataFrame([("gfs", 0), ("gfs", 6)], "source string, run_hour int"), pit.schedules(spark))
    assert plan.count() > 40 and pit.pending(plan, plan).isEmpty()
    assert pit.pending(plan, plan.limit(0)).count() == plan.count()


def test_cross_model_with_one_source_has_no_spread(spark):
    r = pit.cross_model(spark.createDataFrame([("s", "gfs", 80.0), ("s", "other", 1.0)], "state_id string, source string, tmax double"), ("hrrr", "gfs")).first()
    assert r["forecast_count"] == 1 and r["std"] is None and r["pairs"] == []
