"""What was knowable at an instant: masks, run completeness, and the runs a state may read.

A forecast row (source, run_time, valid_time, ensemble_member, available_time, value) counts at t once its
``available_time`` is at or before t. A run is usable for a day when every scheduled point of that day has arrived (for
an ensemble: for every one of the expected members). Rows are first reduced to one row per run and day, which says when
it became complete; states then meet these few rows, never all forecast rows. Only the rows of the runs that a state
has chosen are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.times import local_day_bounds
from tidemark.operators.asof import HOUR
from tidemark.operators.joins import small
from tidemark.sources.sinks import staged

#: Availability kinds, run states, members an ensemble must have.
S3_PROXY, OBSERVATION_ONLY, ISSUANCE_ONLY, UNKNOWN = "S3_LAST_MODIFIED_PROXY", "OBSERVATION_TIME_ONLY", "ISSUANCE_TIME_ONLY", "UNKNOWN"
COMPLETE, INCOMPLETE, NOT_APPLICABLE = "COMPLETE", "INCOMPLETE", "NOT_APPLICABLE"
MEMBERS = {"gefs": 31, "ecmwf_ensemble": 51}
#: The instantaneous temperature of each source; period maxima must not enter a path.
TEMPERATURE = {"ecmwf_deterministic": "2t", "ecmwf_ensemble": "2t"}
LOOK_BACK_DAYS = 3
#: Last hourly, last three-hourly (medium and full runs) and last six-hourly step of the blend.
NBM_HOURLY, NBM_MEDIUM, NBM_THREE, NBM_SIX = 36, 189, 192, 264


def eligibility_time(status: Column, policy: Column, available: Column, observed: Column, issued: Column) -> Column:
    """When a row became knowable under a policy; null: never."""
    proxy = policy == "proxy"
    return F.when(status == S3_PROXY, available).when(proxy & (status == OBSERVATION_ONLY), observed).when(proxy & (status == ISSUANCE_ONLY), issued)


def eligible(known_at: Column, t: Column) -> Column:
    """No lookahead: known, and not after t."""
    return F.coalesce(known_at <= t, F.lit(False))


def temperature_rows(df: DataFrame) -> DataFrame:
    """Rows of each source's own instantaneous temperature."""
    wanted = F.lit("TMP")
    for source, variable in TEMPERATURE.items():
        wanted = F.when(F.col("source") == source, variable).otherwise(wanted)
    return df.filter(F.col("variable") == wanted)


def schedules(spark: SparkSession) -> DataFrame:
    """(source, run_hour, forecast_hour): the native schedules, some thousand rows whatever the data's size."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("run_hour"))
    long_run = F.when(F.col("run_hour") % 6 == 0, 48).otherwise(18)
    by_three = F.concat(F.sequence(F.lit(0), F.lit(144), F.lit(3)), F.sequence(F.lit(150), F.lit(360), F.lit(6)))
    lists = {
        "hrrr": F.sequence(F.lit(0), long_run),
        "gfs": F.sequence(F.lit(0), F.lit(120)),
        "gefs": F.sequence(F.lit(0), F.lit(240), F.lit(3)),
        "ecmwf_deterministic": by_three,
        "ecmwf_ensemble": by_three,
        "nbm": nbm_hours(F.col("run_hour")),
    }
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("source"), v.alias("hours")) for k, v in lists.items()])).alias("s")
    return hours.select("run_hour", rows).select("s.source", "run_hour", F.explode("s.hours").alias("forecast_hour"))


def nbm_tier(run_hour: Column) -> Column:
    """How far a run reaches, by its place in the six-hour cycle."""
    return F.when(run_hour % 6 <= 1, "full").when(run_hour % 6 == 3, "medium").otherwise("short")


def nbm_hours(run_hour: Column) -> Column:
    """Forecast hours of a run: hourly, then three-hourly, then six-hourly, as far as its tier goes."""
    hourly, medium, full = F.sequence(F.lit(1), F.lit(NBM_HOURLY)), F.sequence(F.lit(NBM_HOURLY + 3), F.lit(NBM_MEDIUM), F.lit(3)), F.sequence(F.lit(NBM_HOURLY + 3), F.lit(NBM_THREE), F.lit(3))
    last = F.sequence(F.lit(NBM_THREE + 6), F.lit(NBM_SIX), F.lit(6))
    tier = nbm_tier(run_hour)
    return F.when(tier == "short", hourly).when(tier == "medium", F.concat(hourly, medium)).otherwise(F.concat(hourly, full, last))


def expected_points(runs: DataFrame, days: DataFrame, schedule: DataFrame) -> DataFrame:
    """(source, run_time, day, valid_time, forecast_hour): scheduled points of each run within each day.

    ``runs``: (source, run_time); ``days``: (day, day_start, day_end). Only days that a run's schedule can reach are met.
    """
    at = runs.withColumn("run_hour", F.hour("run_time")).join(small(schedule), ["source", "run_hour"])
    points = at.withColumn("valid_time", F.timestamp_add("HOUR", F.col("forecast_hour"), F.col("run_time")))
    near = F.explode(F.sequence(F.date_sub(F.to_date("valid_time"), 1), F.to_date("valid_time")))
    keyed = points.withColumn("day", near).join(days.select("day", "day_start", "day_end").distinct(), "day")
    return keyed.filter((F.col("valid_time") >= F.col("day_start")) & (F.col("valid_time") < F.col("day_end"))).select("source", "run_time", "day", "valid_time", "forecast_hour")


def in_day(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows with the day they are valid for (half-open local days)."""
    near = F.explode(F.sequence(F.date_sub(F.to_date("valid_time"), 1), F.to_date("valid_time")))
    keyed = rows.withColumn("day", near).join(small(days.select("day", "day_start", "day_end").distinct()), "day")
    return keyed.filter((F.col("valid_time") >= F.col("day_start")) & (F.col("valid_time") < F.col("day_end"))).drop("day_start", "day_end")


def with_until(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Arrived rows with ``until`` (microseconds): at or before a state's ``query_time`` if and only if the arrival is.

    It is the next query time, or the end of the hour of arrival, so that query times are found by an equality join.
    """
    at, t = F.unix_micros("available_time"), F.unix_micros("query_time")
    hours = states.select(F.floor(t / HOUR).alias("__hour"), t.alias("t")).groupBy("__hour").agg(F.collect_set("t").alias("__times"))
    placed = rows.filter("available_time is not null").withColumn("__hour", F.floor(at / HOUR)).join(small(hours), "__hour", "left")
    next_one = F.array_min(F.filter("__times", lambda x: x >= at))
    return placed.withColumn("until", F.coalesce(next_one, (F.col("__hour") + 1) * HOUR)).drop("__hour", "__times")


def condensed(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Rows that no state can tell apart become at most two: all of one point and member that arrive between the same query times.

    They keep the first and the last arrival, each with the largest value; so maxima, first and last arrivals, counts of
    points, and what is known at a state's ``query_time`` are those of all rows.
    """
    key = ["source", "run_time", "ensemble_member", "forecast_hour", "valid_time"]
    g = with_until(rows, states).groupBy(*key, "until").agg(F.max("value").alias("value"), F.min("available_time").alias("first"), F.max("available_time").alias("last"))
    return g.select(*key, "value", F.explode(F.array_distinct(F.array("first", "last"))).alias("available_time"))


def runs_of(rows: DataFrame) -> DataFrame:
    """(source, run_time, first_seen): one row a run of which anything has arrived."""
    return rows.filter("available_time is not null").groupBy("source", "run_time").agg(F.min("available_time").alias("first_seen"))


def run_completeness(rows: DataFrame, days: DataFrame, schedule: DataFrame, members: dict[str, int] | None = None, runs: DataFrame | None = None) -> DataFrame:
    """One row per (source, run_time, day): points and members expected and there, status, complete_at.

    ``complete_at``: when the last needed point arrived (null if one never did). An ensemble's points are those of its
    poorest member. ``runs``: ``runs_of(rows)``, where the caller has it.
    """
    members = MEMBERS if members is None else members
    need = F.lit(None).cast("int")
    for source, n in members.items():
        need = F.when(F.col("source") == source, n).otherwise(need)
    known = rows.filter(F.col("available_time").isNotNull())
    runs = runs_of(rows) if runs is None else runs
    expected = expected_points(runs.select("source", "run_time"), days, schedule)
    totals = expected.groupBy("source", "run_time", "day").agg(F.count("*").cast("int").alias("points_expected"))
    member = F.when(need.isNotNull(), F.col("ensemble_member")) if "ensemble_member" in rows.columns else F.lit(None).cast("string")
    points = in_day(known, days).withColumn("member", member).filter(need.isNull() | F.col("member").isNotNull()).groupBy("source", "run_time", "day", "member", "valid_time").agg(F.min("available_time").alias("at"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    wanted = small(schedule.select("source", "run_hour", (F.col("forecast_hour").cast("long") * HOUR).alias("ahead"), F.lit(True).alias("scheduled")))  # whether a point is scheduled needs no join of points with points
    placed = points.withColumn("run_hour", F.hour("run_time")).withColumn("ahead", micros("valid_time") - micros("run_time"))
    per_member = placed.join(wanted, ["source", "run_hour", "ahead"], "left").groupBy("source", "run_time", "day", "member").agg(F.count("scheduled").cast("int").alias("n"), F.max(F.when(F.col("scheduled"), F.col("at"))).alias("at"))
    per_run = per_member.groupBy("source", "run_time", "day").agg(F.min("n").alias("points"), F.count("*").cast("int").alias("member_count"), F.max("at").alias("at"))
    out = totals.join(per_run, ["source", "run_time", "day"], "full_outer").withColumn("points_expected", F.coalesce("points_expected", F.lit(0))).withColumn("points", F.coalesce("points", F.lit(0)))
    full = (F.col("points_expected") > 0) & (F.col("points") == F.col("points_expected")) & (need.isNull() | (F.col("member_count") == need))
    status = F.when(F.col("points_expected") == 0, NOT_APPLICABLE).when(F.coalesce(full, F.lit(False)), COMPLETE).otherwise(INCOMPLETE)
    return out.select("source", "run_time", "day", "points", "points_expected", F.when(need.isNotNull(), F.coalesce("member_count", F.lit(0))).alias("member_count"), need.alias("members_expected"), status.alias("status"), F.when(status == COMPLETE, F.col("at")).alias("complete_at"))


def choose_runs(states: DataFrame, rows: DataFrame, completeness: DataFrame, look_back_days: int = LOOK_BACK_DAYS, runs: DataFrame | None = None) -> DataFrame:
    """(state_id, source, seen_run, usable_run, previous_run): the newest run with any row, the two newest complete ones.

    ``states``: (state_id, day, query_time). A run is spread over the few dates on which it may still be asked for, so
    this is an equality join on (date) of run rows and states.
    """
    first = runs_of(rows) if runs is None else runs
    spread = F.explode(F.sequence(F.to_date("run_time"), F.date_add(F.to_date("run_time"), look_back_days))).alias("on_date")
    s = states.select("state_id", "day", "query_time", F.to_date("query_time").alias("on_date"))
    within = (F.col("run_time") <= F.col("query_time")) & (F.col("run_time") >= F.col("query_time") - F.expr(f"INTERVAL {look_back_days} DAYS"))
    seen = s.join(first.select("source", "run_time", "first_seen", spread), "on_date").filter(within & (F.col("first_seen") <= F.col("query_time")))
    done = completeness.filter("complete_at is not null").select("source", "run_time", "day", "complete_at")
    met = seen.join(done, ["source", "run_time", "day"], "left").withColumn("usable", F.coalesce(F.col("complete_at") <= F.col("query_time"), F.lit(False)))
    top = F.sort_array(F.collect_set(F.when(F.col("usable"), F.col("run_time"))), asc=False)  # at most the runs of three days
    return met.groupBy("state_id", "source").agg(F.max("run_time").alias("seen_run"), top.alias("r")).select("state_id", "source", "seen_run", F.get("r", F.lit(0)).alias("usable_run"), F.get("r", F.lit(1)).alias("previous_run"))


def chosen_runs(states: DataFrame, rows: DataFrame, days: DataFrame, schedule: DataFrame, members: dict[str, int] | None = None, look_back_days: int = LOOK_BACK_DAYS) -> tuple[DataFrame, DataFrame]:
    """Completeness of the runs, and the states' choice of them, each written once."""
    runs = staged(runs_of(rows))
    full = staged(run_completeness(rows, days, schedule, members, runs))
    return full, staged(choose_runs(states, rows, full, look_back_days, runs))


def run_values(states: DataFrame, rows: DataFrame, chosen: DataFrame, days: DataFrame) -> DataFrame:
    """Per (state, source, role): the chosen run's daily maximum, path and arrival times, from rows known at the state's time."""
    roles = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"{r}_run").alias("run_time")) for r in ("seen", "usable", "previous")])).alias("x")
    picks = chosen.select("state_id", "source", roles).select("state_id", "source", "x.role", "x.run_time").filter("run_time is not null").join(states.select("state_id", "day", "query_time"), "state_id")
    here = in_day(rows.filter("available_time is not null"), days).drop("role")
    both = small(picks).join(here, ["source", "run_time", "day"]).filter(F.col("available_time") <= F.col("query_time"))
    path = F.array_sort(F.collect_list(F.struct("valid_time", "forecast_hour", "value")))
    return both.groupBy("state_id", "source", "role", "run_time").agg(F.max("value").alias("daily_max"), F.min("available_time").alias("first_in_day"), F.max("available_time").alias("usable_since"), F.countDistinct("valid_time").alias("points"), path.alias("path"))


def forecast_states(states: DataFrame, rows: DataFrame, days: DataFrame, schedule: DataFrame, members: dict[str, int] | None = None, look_back_days: int = LOOK_BACK_DAYS, found: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per (state, source that has been seen): runs, daily maxima, revision, age, whether a newer run is arriving.

    ``found``: completeness and chosen runs, where the caller has them. Days, runs, their completeness and the choice of runs are few rows that several steps read; each is written once, so
    the forecast rows are read three times: for the runs, for completeness, and for the chosen runs' values.
    """
    days = staged(days.select("day", "day_start", "day_end").distinct())
    states = staged(states.select("state_id", "day", "query_time"))
    full, chosen = found or chosen_runs(states, rows, days, schedule, members, look_back_days)
    values = run_values(states, rows, chosen, days).groupBy("state_id", "source").agg(*[F.max(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{c}") for r, c in (("usable", "daily_max"), ("previous", "daily_max"), ("usable", "usable_since"), ("seen", "points"))])
    out = chosen.join(values, ["state_id", "source"], "left").join(states.select("state_id", "day", "query_time"), "state_id")
    status = full.select("source", "day", F.col("run_time").alias("seen_run"), F.col("complete_at").alias("seen_complete_at"), (F.col("points_expected") == 0).alias("seen_na"))
    out = out.join(status, ["source", "day", "seen_run"], "left")
    seen = F.when(F.coalesce("seen_na", F.lit(True)), NOT_APPLICABLE).when(F.coalesce(F.col("seen_complete_at") <= F.col("query_time"), F.lit(False)), COMPLETE).otherwise(INCOMPLETE)
    age = (F.unix_micros("query_time") - F.unix_micros("usable_run")) / 3.6e9
    return out.select(
        "state_id", "source", "seen_run", seen.alias("seen_status"), "usable_run", F.col("usable_daily_max").alias("tmax"), F.col("usable_usable_since").alias("usable_since"), age.alias("age_hours"),
        "previous_run", F.col("previous_daily_max").alias("previous_tmax"), (F.col("usable_daily_max") - F.col("previous_daily_max")).alias("revision"), F.col("usable_run").isNotNull().alias("usable_for_daily_max"), (~F.col("usable_run").eqNullSafe(F.col("seen_run"))).alias("newer_run_arriving"),
    )


def usable_since_schedule(rows: DataFrame, days: DataFrame, schedule: DataFrame, members: dict[str, int] | None = None) -> DataFrame:
    """When each run reached its scheduled points, over all rows: what the event timeline shows."""
    return run_completeness(rows, days, schedule, members).filter("complete_at is not null").select("source", "run_time", "day", F.col("complete_at").alias("usable_at"))


def member_maxima(states: DataFrame, rows: DataFrame, chosen: DataFrame, days: DataFrame, role: str = "usable") -> DataFrame:
    """(state_id, source, run_time, ensemble_member, daily_max) of the chosen run."""
    picks = chosen.filter(F.col(f"{role}_run").isNotNull()).select("state_id", "source", F.col(f"{role}_run").alias("run_time")).join(states.select("state_id", "day", "query_time"), "state_id")
    here = in_day(rows.filter("available_time is not null and ensemble_member is not null"), days)
    return picks.join(here, ["source", "run_time", "day"]).filter(F.col("available_time") <= F.col("query_time")).groupBy("state_id", "source", "run_time", "ensemble_member").agg(F.max("value").alias("daily_max"))


def work_plan(days: DataFrame, sources: DataFrame, schedule: DataFrame, lead_days: int = 1) -> DataFrame:
    """(source, run_time, forecast_hour): what has to be fetched for some local days, from runs of these and the days before.

    ``sources``: (source, run_hour). Points are needed if they fall into one of the days.
    """
    near = days.select(F.explode(F.sequence(F.date_sub("day", lead_days), F.col("day"))).alias("run_day")).distinct()
    runs = near.crossJoin(small(sources)).select("source", F.timestamp_add("HOUR", F.col("run_hour"), F.col("run_day").cast("timestamp")).alias("run_time"))
    return expected_points(runs, days, schedule).select("source", "run_time", "forecast_hour").distinct()


def pending(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Work that no finished row covers: a second run after a full one finds nothing."""
    keys = ["source", "run_time", "forecast_hour"]
    return plan.join(done.select(*keys).distinct(), keys, "left_anti")


def coverage(run_times: DataFrame, days: DataFrame, schedule: DataFrame) -> DataFrame:
    """Per (source, run, day): how many of the day's whole hours the run's schedule spans, and if that is all of them."""
    points = expected_points(run_times, days, schedule)
    length = days.select("day", ((F.unix_micros("day_end") - F.unix_micros("day_start")) / 3.6e9).cast("int").alias("day_hours")).distinct()
    agg = points.groupBy("source", "run_time", "day").agg(F.countDistinct("valid_time").alias("hours"), F.min("forecast_hour").alias("first_hour"), F.max("forecast_hour").alias("last_hour"))
    return agg.join(small(length), "day").withColumn("full_coverage", F.col("hours") == F.col("day_hours"))


def local_days(days: DataFrame) -> DataFrame:
    """(day, day_start, day_end)"""
    start, end = local_day_bounds(F.col("day"))
    return days.select("day", start.alias("day_start"), end.alias("day_end"))


def cross_model(states: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Per state: count, mean, median, min, max, range, standard deviation of the sources' daily maxima, and pairwise differences.

    ``states``: (state_id, source, tmax); differences follow ``order``.
    """
    place = F.create_map(*[x for i, s in enumerate(order) for x in (F.lit(s), F.lit(i))])
    known = states.filter(F.col("tmax").isNotNull() & F.col("source").isin(*order)).withColumn("place", place[F.col("source")])
    one = F.array_sort(F.collect_list(F.struct("place", "source", "tmax")))  # at most as many as there are sources
    g = known.groupBy("state_id").agg(F.count("*").alias("forecast_count"), F.avg("tmax").alias("mean"), F.expr("percentile(tmax, 0.5)").alias("median"), F.min("tmax").alias("min"), F.max("tmax").alias("max"), F.stddev_samp("tmax").alias("std"), one.alias("x"))
    pairs = F.flatten(F.transform("x", lambda a: F.transform(F.filter("x", lambda b: b["place"] > a["place"]), lambda b: F.struct(F.concat(a["source"], F.lit("_minus_"), b["source"]).alias("pair"), (a["tmax"] - b["tmax"]).alias("difference")))))
    return g.withColumn("range", F.col("max") - F.col("min")).withColumn("pairs", pairs).drop("x")


def window_maxima(windows: DataFrame, days: DataFrame) -> DataFrame:
    """(source, run_time, day, n_windows, n_straddling, covered_hours, full_day_coverage, reconstructed_max): a day's maximum from
    period maxima of mixed length, (source, run_time, start_time, end_time, value).

    Windows that reach beyond the local day don't count, they are only numbered. Windows may overlap or repeat; hours are
    those of their union. Days in which a run has none but straddling windows have no maximum.
    """
    w = windows.filter(F.col("start_time") < F.col("end_time"))
    near = F.explode(F.sequence(F.date_sub(F.to_date("start_time"), 1), F.to_date("end_time")))
    d = w.withColumn("day", near).join(small(days.select("day", "day_start", "day_end").distinct()), "day").filter((F.col("start_time") < F.col("day_end")) & (F.col("end_time") > F.col("day_start")))
    d = d.withColumn("inside", (F.col("start_time") >= F.col("day_start")) & (F.col("end_time") <= F.col("day_end")))
    spans = d.groupBy("source", "run_time", "day", "start_time", "end_time", "inside", "day_start", "day_end").agg(F.max("value").alias("value"), F.count("*").alias("n"))
    a, b = F.unix_micros("start_time"), F.unix_micros("end_time")
    order = Window.partitionBy("source", "run_time", "day").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)  # a run's windows of a day are few
    known = spans.withColumn("a", F.when(F.col("inside"), a)).withColumn("b", F.when(F.col("inside"), b)).withColumn("reach", F.max("b").over(order))
    new = F.when(F.col("inside"), F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce("reach", "a"))))
    g = known.withColumn("new", new).groupBy("source", "run_time", "day").agg(F.coalesce(F.sum(F.when(F.col("inside"), F.col("n"))), F.lit(0)).alias("n_windows"), F.coalesce(F.sum(F.when(~F.col("inside"), F.col("n"))), F.lit(0)).alias("n_straddling"), (F.coalesce(F.sum("new"), F.lit(0)) / 3.6e9).alias("covered_hours"), F.max(F.when(F.col("inside"), F.col("value"))).alias("reconstructed_max"), F.first((F.unix_micros("day_end") - F.unix_micros("day_start")) / 3.6e9).alias("hours"))
    return g.select("source", "run_time", "day", "n_windows", "n_straddling", "covered_hours", (F.col("covered_hours") == F.col("hours")).alias("full_day_coverage"), "reconstructed_max")


def reconstruction_error(direct: DataFrame, reconstructed: DataFrame) -> DataFrame:
    """Direct daily maxima (source, run_time, day, direct_max) beside those from windows, and by how much these differ; either may be absent."""
    both = direct.join(reconstructed, ["source", "run_time", "day"], "full_outer")
    return both.withColumn("error", F.col("reconstructed_max") - F.col("direct_max"))


def backward_moves(picks: DataFrame, by: list[str], time: str, run: str) -> DataFrame:
    """Places where a later state reads an older run than the state before it; null runs are passed over."""
    w = Window.partitionBy(*by).orderBy(time)
    return picks.filter(F.col(run).isNotNull()).withColumn("before", F.lag(run).over(w)).filter(F.col("before") > F.col(run))
