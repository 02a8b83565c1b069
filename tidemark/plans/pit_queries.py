"""Point-in-time queries. Events stand in for forecasts: source by user, run by day, points every six hours, a member by kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import day_progress, state_grid
from tidemark.operators import pit
from tidemark.operators.asof import asof_join
from tidemark.plans.registry import query
from tidemark.sources.tables import events

SOURCES, HOURS = ("m0", "m1", "m2", "m3"), (6, 10, 14)
MEMBER_COUNT = {s: 5 for s in SOURCES}

DAYS = """d AS (SELECT day, (day::TIMESTAMP AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS day_start, ((day + 1)::TIMESTAMP AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS day_end
 FROM (SELECT DISTINCT ts::DATE AS day FROM events)),
g AS (SELECT d.*, h AS local_hour, mode, ((day + INTERVAL (h) HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS t FROM d, unnest([{hours}]) AS u(h), unnest(['strict', 'proxy']) AS v(mode)),
s AS (SELECT substr(sha256(strftime(day, '%Y-%m-%d') || '|' || strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00|' || mode), 1, 16) AS state_id, * FROM g)"""
THREE, ALL = DAYS.format(hours="6, 10, 14"), DAYS.format(hours="6, 8, 10, 12, 14, 16")
ROWS = """f AS (SELECT 'm' || (user_id % 4) AS source, date_trunc('day', ts) AS run_time, event_type AS member, 24 * k + 6 * (hour(ts) // 6) AS fh, date_trunc('day', ts) + INTERVAL (24 * k + 6 * (hour(ts) // 6)) HOUR AS valid_time, ts AS avail, value FROM events, range(3) AS x(k)),
e AS (SELECT r.source, r.run_time, d.day, r.run_time + INTERVAL (6 * k) HOUR AS valid_time FROM (SELECT DISTINCT source, run_time FROM f) r, range(12) AS x(k), d WHERE r.run_time + INTERVAL (6 * k) HOUR >= d.day_start AND r.run_time + INTERVAL (6 * k) HOUR < d.day_end),
n AS (SELECT source, run_time, day, count(*) AS want FROM e GROUP BY ALL),
fd AS (SELECT f.*, d.day, e.valid_time IS NOT NULL AS wanted FROM f JOIN d ON f.valid_time >= d.day_start AND f.valid_time < d.day_end LEFT JOIN e ON e.source = f.source AND e.run_time = f.run_time AND e.day = d.day AND e.valid_time = f.valid_time)"""


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the forecast of three days, each row with its own arrival time."""
    e = events(spark, sf_dir)
    run, ts = F.date_trunc("day", F.col("ts").cast("timestamp")), F.col("ts").cast("timestamp")
    point = (F.floor(F.hour(ts) / 6) * 6).cast("int")
    rows = e.select(F.concat(F.lit("m"), F.col("user_id") % 4).alias("source"), run.alias("run_time"), F.col("event_type").alias("ensemble_member"), ts.alias("available_time"), "value", F.explode(F.array(F.lit(0), F.lit(24), F.lit(48))).alias("k"), point.alias("p"))
    hour = F.col("k") + F.col("p")
    return rows.select("source", "run_time", "ensemble_member", hour.alias("forecast_hour"), F.timestamp_add("HOUR", hour, F.col("run_time")).alias("valid_time"), "available_time", "value")


def schedule(spark: SparkSession) -> DataFrame:
    hours = F.explode(F.sequence(F.lit(0), F.lit(66), F.lit(6))).alias("forecast_hour")
    return spark.range(24).select(F.explode(F.array(*map(F.lit, SOURCES))).alias("source"), F.col("id").cast("int").alias("run_hour")).select("source", "run_hour", hours)


def days_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.to_date("ts").alias("day")).distinct()


def states(spark: SparkSession, sf_dir: str, hours: tuple = HOURS) -> DataFrame:
    return state_grid(days_of(spark, sf_dir), hours=hours)


@query(f"WITH {ALL} SELECT state_id, strftime(day, '%Y-%m-%d') AS day, local_hour::INT AS local_hour, mode, epoch_us(t) AS query_us, epoch_us(day_start) AS start_us, epoch_us(day_end) AS end_us FROM s")
def pit_state_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = states(spark, sf_dir, (6, 8, 10, 12, 14, 16))
    return s.select("state_id", F.col("day").cast("string").alias("day"), "local_hour", "mode", F.unix_micros("query_time").alias("query_us"), F.unix_micros("day_start").alias("start_us"), F.unix_micros("day_end").alias("end_us"))


@query(f"WITH {THREE} SELECT state_id, (local_hour * 60.0)::DOUBLE AS minutes_since_midnight, (epoch_us(day_end) - epoch_us(t)) / 3600000000.0 AS hours_left FROM s")
def pit_day_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock minutes since midnight, and the absolute hours that the day still has."""
    minutes, left = day_progress(F.col("query_time"), F.col("day"))
    return states(spark, sf_dir).select("state_id", minutes.alias("minutes_since_midnight"), left.alias("hours_left"))


@query(f"""WITH {THREE}, k AS (SELECT ts, CASE WHEN event_type IN ('click', 'view') THEN 's3' WHEN event_type = 'error' THEN 'issue' ELSE 'obs' END AS kind FROM events)
SELECT s.state_id, s.mode, count(k.ts) AS n_known FROM s LEFT JOIN k ON k.ts >= s.day_start AND k.ts <= s.t AND (s.mode = 'proxy' OR k.kind = 's3') GROUP BY ALL""")
def pit_mask_strict_proxy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the day that each state may know, under either policy."""
    ts = F.col("ts").cast("timestamp")
    kind = F.when(F.col("event_type").isin("click", "view"), pit.S3_PROXY).when(F.col("event_type") == "error", pit.ISSUANCE_ONLY).otherwise(pit.OBSERVATION_ONLY)
    e = events(spark, sf_dir).select(ts.alias("ts"), kind.alias("status"), F.explode(F.array(F.date_sub(F.to_date("ts"), 1), F.to_date("ts"))).alias("day"))
    s = states(spark, sf_dir)
    known = pit.eligibility_time(F.col("status"), F.col("mode"), F.col("ts"), F.col("ts"), F.col("ts"))
    counts = s.join(e, "day").filter((F.col("ts") >= F.col("day_start")) & pit.eligible(known, F.col("query_time"))).groupBy("state_id").agg(F.count("*").alias("n"))
    return s.select("state_id", "mode").join(counts, "state_id", "left").select("state_id", "mode", F.coalesce("n", F.lit(0)).cast("long").alias("n_known"))


@query(f"""WITH {THREE}, {ROWS}, p AS (SELECT source, run_time, day, valid_time, wanted, min(avail) AS tm FROM fd GROUP BY ALL),
r AS (SELECT source, run_time, day, count(*) FILTER (wanted) AS points, max(tm) FILTER (wanted) AS tm FROM p GROUP BY ALL)
SELECT n.source, epoch_us(n.run_time) AS run_us, strftime(n.day, '%Y-%m-%d') AS day, coalesce(points, 0)::INT AS points, want::INT AS points_expected, CASE WHEN points = want THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status, CASE WHEN points = want THEN epoch_us(tm) END AS complete_us
FROM n LEFT JOIN r USING (source, run_time, day)""")
def run_completeness_det(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = pit.local_days(days_of(spark, sf_dir))
    c = pit.run_completeness(forecasts(spark, sf_dir), days, schedule(spark), {})
    return c.select("source", F.unix_micros("run_time").alias("run_us"), F.col("day").cast("string").alias("day"), "points", "points_expected", "status", F.unix_micros("complete_at").alias("complete_us"))


@query(f"""WITH {THREE}, {ROWS}, p AS (SELECT source, run_time, day, member, valid_time, wanted, min(avail) AS tm FROM fd GROUP BY ALL),
m AS (SELECT source, run_time, day, member, count(*) FILTER (wanted) AS k, max(tm) FILTER (wanted) AS tm FROM p GROUP BY ALL),
r AS (SELECT source, run_time, day, min(k) AS points, count(*) AS members, max(tm) AS tm FROM m GROUP BY ALL)
SELECT n.source, epoch_us(n.run_time) AS run_us, strftime(n.day, '%Y-%m-%d') AS day, coalesce(points, 0)::INT AS points, want::INT AS points_expected, coalesce(members, 0)::INT AS member_count, CASE WHEN points = want AND members = 5 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status, CASE WHEN points = want AND members = 5 THEN epoch_us(tm) END AS complete_us
FROM n LEFT JOIN r USING (source, run_time, day)""")
def run_completeness_ens(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = pit.local_days(days_of(spark, sf_dir))
    c = pit.run_completeness(forecasts(spark, sf_dir), days, schedule(spark), MEMBER_COUNT)
    return c.select("source", F.unix_micros("run_time").alias("run_us"), F.col("day").cast("string").alias("day"), "points", "points_expected", "member_count", "status", F.unix_micros("complete_at").alias("complete_us"))


STATE = f"""WITH {THREE}, {ROWS},
k AS (SELECT s.state_id, s.day, s.t, f.source, f.run_time FROM s JOIN f ON f.avail <= s.t AND f.run_time <= s.t AND f.run_time >= s.t - INTERVAL 3 DAY GROUP BY ALL),
m AS (SELECT k.state_id, k.source, k.run_time, count(DISTINCT fd.valid_time) FILTER (fd.wanted) AS points, max(fd.value) AS mx, max(fd.avail) AS since FROM k LEFT JOIN fd ON fd.source = k.source AND fd.run_time = k.run_time AND fd.day = k.day AND fd.avail <= k.t GROUP BY ALL),
q AS (SELECT k.*, m.points, m.mx, m.since, coalesce(n.want, 0) AS want, coalesce(m.points = n.want, false) AS ok FROM k JOIN m USING (state_id, source, run_time) LEFT JOIN n ON n.source = k.source AND n.run_time = k.run_time AND n.day = k.day),
z AS (SELECT *, row_number() OVER (PARTITION BY state_id, source ORDER BY run_time DESC) AS rs, row_number() OVER (PARTITION BY state_id, source, ok ORDER BY run_time DESC) AS ru FROM q),
o AS (SELECT state_id, source, any_value(t) AS t, max(run_time) AS seen, max(CASE WHEN rs = 1 THEN CASE WHEN want = 0 THEN 'NOT_APPLICABLE' WHEN ok THEN 'COMPLETE' ELSE 'INCOMPLETE' END END) AS seen_status,
 max(CASE WHEN ok AND ru = 1 THEN run_time END) AS usable, max(CASE WHEN ok AND ru = 1 THEN mx END) AS tmax, max(CASE WHEN ok AND ru = 1 THEN since END) AS since, max(CASE WHEN ok AND ru = 2 THEN run_time END) AS previous, max(CASE WHEN ok AND ru = 2 THEN mx END) AS ptmax FROM z GROUP BY ALL)"""


@query(STATE + """ SELECT state_id, source, epoch_us(seen) AS seen_us, seen_status, epoch_us(usable) AS usable_us, tmax, epoch_us(since) AS since_us, (epoch_us(t) - epoch_us(usable)) / 3600000000.0 AS age_hours, epoch_us(previous) AS previous_us, round(tmax - ptmax, 6) AS revision,
 usable IS NOT NULL AS usable_for_daily_max, usable IS DISTINCT FROM seen AS newer_run_arriving FROM o""")
def latest_seen_usable_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, days = states(spark, sf_dir), pit.local_days(days_of(spark, sf_dir))
    x = pit.forecast_states(s, forecasts(spark, sf_dir), days, schedule(spark), {})
    return x.select("state_id", "source", F.unix_micros("seen_run").alias("seen_us"), "seen_status", F.unix_micros("usable_run").alias("usable_us"), "tmax", F.unix_micros("usable_since").alias("since_us"), "age_hours", F.unix_micros("previous_run").alias("previous_us"), F.round("revision", 6).alias("revision"), "usable_for_daily_max", "newer_run_arriving")


@query(STATE + """, a AS (SELECT o.source, d.day, d.local_hour, o.usable, lag(o.usable) OVER (PARTITION BY o.source, d.day ORDER BY d.t) AS b FROM o JOIN s d USING (state_id) WHERE o.usable IS NOT NULL AND d.mode = 'strict')
SELECT source, strftime(day, '%Y-%m-%d') AS day, local_hour::INT AS local_hour FROM a WHERE b > usable""")
def pit_backward_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations: within a day a later state never reads an older run. Expected empty."""
    s, days = states(spark, sf_dir), pit.local_days(days_of(spark, sf_dir))
    x = pit.forecast_states(s, forecasts(spark, sf_dir), days, schedule(spark), {}).join(s.filter("mode = 'strict'").select("state_id", "day", "local_hour", F.col("query_time").alias("t")), "state_id")
    return pit.backward_moves(x, ["source", "day"], "t", "usable_run").select("source", F.col("day").cast("string").alias("day"), "local_hour")


@query(STATE + """, dist AS (SELECT state_id, count(tmax) AS n, avg(tmax) AS me, quantile_cont(tmax, 0.5) AS md, max(tmax) - min(tmax) AS rg, stddev_samp(tmax) AS sd, max(tmax) FILTER (source = 'm0') - max(tmax) FILTER (source = 'm1') AS d01 FROM o WHERE tmax IS NOT NULL GROUP BY ALL),
ob AS (SELECT s.state_id, e.value AS v, epoch_us(s.t) - epoch_us(e.ts) AS age FROM s ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') e ON s.t >= e.ts)
SELECT s.state_id, s.mode, coalesce(n, 0) AS forecast_count, round(me, 6) AS mean_tmax, round(md, 6) AS median_tmax, round(rg, 6) AS range_tmax, round(sd, 6) AS std_tmax, round(d01, 6) AS m0_minus_m1, CASE WHEN s.mode = 'proxy' AND age <= 21600000000 THEN v END AS current_value, CASE WHEN s.mode = 'proxy' THEN age / 60000000.0 END AS observation_age_minutes
FROM s LEFT JOIN dist USING (state_id) LEFT JOIN ob USING (state_id)""")
def flagship_point_in_time_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a state: the models' usable daily maxima compared, and the current observation under the proxy policy."""
    s, days = states(spark, sf_dir), pit.local_days(days_of(spark, sf_dir))
    x = pit.forecast_states(s, forecasts(spark, sf_dir), days, schedule(spark), {})
    c = pit.cross_model(x, SOURCES)
    one = F.filter("pairs", lambda p: p["pair"] == "m0_minus_m1")
    c = c.select("state_id", "forecast_count", "mean", "median", "range", "std", F.get(one, F.lit(0))["difference"].alias("d01"))
    views = events(spark, sf_dir).filter("event_type = 'view'").select(F.lit(1).alias("all"), F.col("us").alias("at"), "value")
    seen = asof_join(s.select("state_id", "mode", F.unix_micros("query_time").alias("t"), F.lit(1).alias("all")), views, ["all"], "t", "at", bucket_us=24 * 3_600_000_000)
    age = F.when(F.col("mode") == "proxy", F.col("t") - F.col("match.at"))
    out = seen.select("state_id", "mode", F.when(age <= 6 * 3_600_000_000, F.col("match.value")).alias("current_value"), (age / 6e7).alias("observation_age_minutes")).join(c, "state_id", "left")
    return out.select("state_id", "mode", F.coalesce("forecast_count", F.lit(0)).cast("long").alias("forecast_count"), *[F.round(a, 6).alias(b) for a, b in (("mean", "mean_tmax"), ("median", "median_tmax"), ("range", "range_tmax"), ("std", "std_tmax"), ("d01", "m0_minus_m1"))], "current_value", "observation_age_minutes")


@query(f"""WITH {THREE}, {ROWS},
k AS (SELECT s.state_id, s.day, s.t, f.source, f.run_time FROM s JOIN f ON f.avail <= s.t AND f.run_time <= s.t AND f.run_time >= s.t - INTERVAL 3 DAY GROUP BY ALL),
pm AS (SELECT k.state_id, k.source, k.run_time, fd.member, count(DISTINCT fd.valid_time) FILTER (fd.wanted) AS points, max(fd.value) AS mx FROM k JOIN fd ON fd.source = k.source AND fd.run_time = k.run_time AND fd.day = k.day AND fd.avail <= k.t GROUP BY ALL),
ok AS (SELECT pm.state_id, pm.source, pm.run_time FROM pm JOIN s USING (state_id) JOIN n ON n.source = pm.source AND n.run_time = pm.run_time AND n.day = s.day GROUP BY ALL HAVING min(points) = any_value(n.want) AND count(*) = 5),
top AS (SELECT state_id, source, max(run_time) AS run_time FROM ok GROUP BY ALL)
SELECT state_id, source, round(avg(mx), 6) AS mean_f, round(quantile_cont(mx, 0.5), 6) AS p50_f, round(stddev_samp(mx), 6) AS std_f, min(mx) AS min_f, max(mx) AS max_f, round(quantile_cont(mx, 0.1), 6) AS p10_f, round(quantile_cont(mx, 0.9), 6) AS p90_f, count(*) AS member_count FROM top JOIN pm USING (state_id, source, run_time) GROUP BY ALL""")
def pit_ensemble_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of the members' daily maxima in the newest complete ensemble run of each state and source."""
    s, days, rows = states(spark, sf_dir), pit.local_days(days_of(spark, sf_dir)), forecasts(spark, sf_dir)
    full = pit.run_completeness(rows, days, schedule(spark), MEMBER_COUNT)
    m = pit.member_maxima(s, rows, pit.choose_runs(s, rows, full), days)
    q = F.expr("percentile(daily_max, array(0.1, 0.5, 0.9))")
    g = m.groupBy("state_id", "source").agg(F.round(F.avg("daily_max"), 6).alias("mean_f"), F.round(F.stddev_samp("daily_max"), 6).alias("std_f"), F.min("daily_max").alias("min_f"), F.max("daily_max").alias("max_f"), q.alias("q"), F.count("*").alias("member_count"))
    return g.select("state_id", "source", "mean_f", F.round(F.col("q")[1], 6).alias("p50_f"), "std_f", "min_f", "max_f", F.round(F.col("q")[0], 6).alias("p10_f"), F.round(F.col("q")[2], 6).alias("p90_f"), "member_count")


@query(f"""WITH {THREE}, {ROWS}, p AS (SELECT source, run_time, day, valid_time, wanted, min(avail) AS tm FROM fd GROUP BY ALL),
r AS (SELECT source, run_time, day, count(*) FILTER (wanted) AS points, max(tm) FILTER (wanted) AS tm FROM p GROUP BY ALL),
c AS (SELECT r.* FROM r JOIN n USING (source, run_time, day) WHERE points = want AND r.day = r.run_time::DATE),
v AS (SELECT c.source, c.run_time, max(fd.value) AS mx FROM c JOIN fd USING (source, run_time, day) GROUP BY ALL)
SELECT source, epoch_us(run_time) AS run_us, mx AS daily_max, round(mx - lag(mx) OVER (PARTITION BY source ORDER BY run_time), 6) AS revision FROM v""")
def revision_between_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of the predicted maximum from one complete run to the next, of the same source."""
    from tidemark.operators.windows import change

    days, rows = pit.local_days(days_of(spark, sf_dir)), forecasts(spark, sf_dir)
    done = pit.run_completeness(rows, days, schedule(spark), {}).filter((F.col("status") == pit.COMPLETE) & (F.col("day") == F.to_date("run_time"))).select("source", "run_time", "day")
    v = pit.in_day(rows, days).join(done, ["source", "run_time", "day"]).groupBy("source", "run_time").agg(F.max("value").alias("daily_max"))
    return change(v, ["source"], ["run_time"], "daily_max", "revision").select("source", F.unix_micros("run_time").alias("run_us"), "daily_max", F.round("revision", 6).alias("revision"))


@query(f"""WITH {THREE}, r AS (SELECT DISTINCT day - k::INT AS run_day FROM d, range(2) AS x(k)), w AS (SELECT DISTINCT run_day + INTERVAL 12 HOUR AS run_time, 6 * k AS fh FROM r, range(12) AS y(k), d WHERE run_day + INTERVAL (12 + 6 * k) HOUR >= d.day_start AND run_day + INTERVAL (12 + 6 * k) HOUR < d.day_end),
done AS (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 12 HOUR AS run_time, 6 * (hour(ts) // 6) AS fh FROM events WHERE event_type = 'click')
SELECT epoch_us(w.run_time) AS run_us, w.fh::INT AS forecast_hour FROM w ANTI JOIN done USING (run_time, fh)""")
def anti_pending_work_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetches still to be made for noon runs: the plan without what is done."""
    days = pit.local_days(days_of(spark, sf_dir))
    sources = spark.range(1).select(F.lit("m0").alias("source"), F.lit(12).alias("run_hour"))
    plan = pit.work_plan(days, sources, schedule(spark))
    ts = F.col("ts").cast("timestamp")
    done = events(spark, sf_dir).filter("event_type = 'click'").select(F.lit("m0").alias("source"), F.timestamp_add("HOUR", F.lit(12), F.date_trunc("day", ts)).alias("run_time"), (F.floor(F.hour(ts) / 6) * 6).cast("int").alias("forecast_hour"))
    return pit.pending(plan, done).select(F.unix_micros("run_time").alias("run_us"), "forecast_hour")


@query("""WITH h AS (SELECT h AS run_hour, CASE WHEN h % 6 = 0 THEN 48 ELSE 18 END AS hr FROM range(24) AS x(h))
SELECT 'hrrr' AS source, run_hour::INT AS run_hour, (hr + 1)::BIGINT AS n, hr::INT AS last_hour FROM h UNION ALL SELECT 'gfs', run_hour::INT, 121, 120 FROM h UNION ALL SELECT 'gefs', run_hour::INT, 81, 240 FROM h
UNION ALL SELECT s, run_hour::INT, 49 + 36, 360 FROM h, unnest(['ecmwf_deterministic', 'ecmwf_ensemble']) AS u(s)
UNION ALL SELECT 'nbm', run_hour::INT, CASE WHEN run_hour % 6 <= 1 THEN 36 + 52 + 12 WHEN run_hour % 6 = 3 THEN 36 + 51 ELSE 36 END, CASE WHEN run_hour % 6 <= 1 THEN 264 WHEN run_hour % 6 = 3 THEN 189 ELSE 36 END FROM h""")
def pit_native_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit.schedules(spark).groupBy("source", "run_hour").agg(F.count("*").alias("n"), F.max("forecast_hour").alias("last_hour"))


@query(f"""WITH {THREE}, r AS (SELECT DISTINCT date_trunc('day', ts) AS run_time FROM events), p AS (SELECT r.run_time, d.day, h FROM r, range(121) AS x(h), d WHERE r.run_time + INTERVAL (h) HOUR >= d.day_start AND r.run_time + INTERVAL (h) HOUR < d.day_end)
SELECT epoch_us(p.run_time) AS run_us, strftime(p.day, '%Y-%m-%d') AS day, count(*) AS hours, min(h)::INT AS first_hour, max(h)::INT AS last_hour, count(*) = any_value(epoch_us(day_end) - epoch_us(day_start)) // 3600000000 AS full_coverage FROM p JOIN d USING (day) GROUP BY ALL""")
def pit_day_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which hours of which local days an hourly five-day run covers; days of 23 and 25 hours included."""
    runs = events(spark, sf_dir).select(F.lit("gfs").alias("source"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("run_time")).distinct()
    c = pit.coverage(runs, pit.local_days(days_of(spark, sf_dir)), pit.schedules(spark))
    return c.select(F.unix_micros("run_time").alias("run_us"), F.col("day").cast("string").alias("day"), "hours", "first_hour", "last_hour", "full_coverage")


@query(f"""WITH {THREE}, {ROWS}, p AS (SELECT source, run_time, day, valid_time, wanted, min(avail) AS tm FROM fd GROUP BY ALL),
r AS (SELECT source, run_time, day, count(*) FILTER (wanted) AS points, max(tm) FILTER (wanted) AS tm FROM p GROUP BY ALL),
u AS (SELECT r.source, r.run_time, r.tm FROM r JOIN n USING (source, run_time, day) WHERE points = want AND r.day = r.run_time::DATE)
SELECT source || ':' || strftime(run_time, '%Y-%m-%d') AS event_id, 'UPDATE' AS event_type, epoch_us(min(avail)) AS event_us FROM f GROUP BY source, run_time
UNION ALL SELECT source || ':' || strftime(run_time, '%Y-%m-%d') || ':usable', 'USABLE_UPDATE', epoch_us(tm) FROM u
UNION ALL SELECT 'obs:' || event_id, 'OBSERVATION', epoch_us(ts) FROM events WHERE event_type = 'view'""")
def event_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals, moments of completeness and observations on one time line."""
    rows, days, e = forecasts(spark, sf_dir), pit.local_days(days_of(spark, sf_dir)), events(spark, sf_dir)
    name = F.concat_ws(":", "source", F.date_format("run_time", "yyyy-MM-dd"))
    first = rows.groupBy("source", "run_time").agg(F.min("available_time").alias("at")).select(name.alias("event_id"), F.lit("UPDATE").alias("event_type"), F.unix_micros("at").alias("event_us"))
    usable = pit.usable_since_schedule(rows, days, schedule(spark), {}).filter(F.col("day") == F.to_date("run_time")).select(F.concat(name, F.lit(":usable")).alias("event_id"), F.lit("USABLE_UPDATE").alias("event_type"), F.unix_micros("usable_at").alias("event_us"))
    seen = e.filter("event_type = 'view'").select(F.concat(F.lit("obs:"), F.col("event_id").cast("string")).alias("event_id"), F.lit("OBSERVATION").alias("event_type"), F.col("us").alias("event_us"))
    return first.unionByName(usable).unionByName(seen)
