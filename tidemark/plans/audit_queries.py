"""Audits of tables in which faults were planted, so that what they find is known and not empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import state_grid
from tidemark.operators import audit, joins, pit, states, windows
from tidemark.plans import pit_queries, state_queries
from tidemark.plans.registry import query
from tidemark.sources.tables import events

#: Planted: by local hour, (source, role and field, how it is spoilt).
PLANTED = """SELECT state_id, 'hrrr_latest_usable_available_time_le_t' AS check_name FROM o JOIN s USING (state_id) WHERE source = 'hrrr' AND usable IS NOT NULL AND local_hour = 6
UNION ALL SELECT state_id, 'ecmwf_deterministic_previous_usable_run_time_le_t' FROM o JOIN s USING (state_id) WHERE source = 'ecmwf_deterministic' AND previous IS NOT NULL AND local_hour = 6
UNION ALL SELECT state_id, 'gfs_latest_seen_run_time_le_t' FROM o JOIN s USING (state_id) WHERE source = 'gfs' AND local_hour = 10
UNION ALL SELECT state_id, 'nbm_latest_usable_was_actually_complete' FROM o JOIN s USING (state_id) WHERE source = 'nbm' AND usable IS NOT NULL AND local_hour = 14
UNION ALL SELECT state_id, 'observation_KNYC_time_le_t' FROM so JOIN s USING (state_id) WHERE st = 'KNYC' AND age <= 21600000000 AND local_hour = 14
UNION ALL SELECT state_id, 'afd_issuance_time_le_t' FROM b JOIN s USING (state_id) WHERE local_hour = 14"""


@query(state_queries.PARTS + " " + PLANTED)
def dq_named_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 47 named checks of a state in one pass; six of them find what was planted at 6, 10 and 14 o'clock, the others nothing."""
    f = states.audit_facts(state_queries.parts(spark, sf_dir))
    t, hour = F.col("query_time"), F.col("local_hour")
    spoilt = {
        "hrrr": ("latest_usable_available_time", 6, t + F.expr("INTERVAL 1 HOUR")), "ecmwf_deterministic": ("previous_usable_run_time", 6, t + F.expr("INTERVAL 1 SECOND")),
        "gfs": ("latest_seen_run_time", 10, t + F.expr("INTERVAL 1 SECOND")), "nbm": ("complete", 14, F.lit(False)),
    }
    for source, (field, at, value) in spoilt.items():
        f = f.withColumn(source, F.when((hour == at) & F.col(f"{source}.{field}").isNotNull(), F.col(source).withField(field, value)).otherwise(F.col(source)))
    for c in ("KNYC_time", "afd_time"):
        f = f.withColumn(c, F.when((hour == 14) & F.col(c).isNotNull(), t + F.expr("INTERVAL 1 MINUTE")).otherwise(F.col(c)))
    return audit.violations(f, ["state_id"], audit.state_rules(list(states.STATIONS.values())))


@query("SELECT strftime(day, '%Y-%m-%d') AS day, 11 AS n, 5 AS n_strict, 6 AS n_proxy FROM (SELECT DISTINCT ts::DATE AS day FROM events) WHERE day(day) % 5 = 0")
def dq_state_counts_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that lack a state: each fifth has none at 6 o'clock under the strict policy."""
    s = state_grid(events(spark, sf_dir).select(F.to_date("ts").alias("day")).distinct())
    return audit.wrong_counts(s.filter(~((F.col("mode") == "strict") & (F.col("local_hour") == 6) & (F.dayofmonth("day") % 5 == 0))), "day", "mode", 6).select(F.col("day").cast("string").alias("day"), "n", "n_strict", "n_proxy")


@query(pit_queries.STATE + """, a AS (SELECT o.source, d.day, d.local_hour, d.t, o.usable + CASE WHEN d.local_hour = 10 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS run FROM o JOIN s d USING (state_id) WHERE o.usable IS NOT NULL AND d.mode = 'strict'),
b AS (SELECT *, lag(run) OVER (PARTITION BY source, day ORDER BY t) AS before FROM a) SELECT source, strftime(day, '%Y-%m-%d') AS day, local_hour::INT AS local_hour FROM b WHERE before > run""")  # fmt: skip
def pit_backward_moves_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States that read an older run than the one before: runs of 10 o'clock were made two days younger."""
    s, days = pit_queries.states(spark, sf_dir), pit.local_days(pit_queries.days_of(spark, sf_dir))
    x = pit.forecast_states(s, pit_queries.forecasts(spark, sf_dir), days, pit_queries.schedule(spark), {}).join(s.filter("mode = 'strict'").select("state_id", "day", "local_hour", F.col("query_time").alias("t")), "state_id")
    x = x.withColumn("usable_run", F.when(F.col("local_hour") == 10, F.col("usable_run") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("usable_run")))
    return pit.backward_moves(x, ["source", "day"], "t", "usable_run").select("source", F.col("day").cast("string").alias("day"), "local_hour")


@query("WITH e AS (SELECT event_id, user_id, epoch_us(ts) + CASE WHEN event_id % 50 = 0 THEN 259200000000 ELSE 0 END AS us FROM events), b AS (SELECT *, max(us) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e) SELECT event_id FROM b WHERE us < before")
def monotonicity_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrived after a later one of their user: the clock of one in fifty is three days fast."""
    e = events(spark, sf_dir).withColumn("us", F.col("us") + F.when(F.col("event_id") % 50 == 0, 259_200_000_000).otherwise(0))
    return windows.unsorted_rows(e, ["user_id"], "event_id", "us").select("event_id")


GRID = """WITH p AS (SELECT DISTINCT event_type AS source, user_id, 40 + (user_id % 40) / 16.0 AS y, -75 + (user_id // 40) / 16.0 AS x FROM events),
q AS (SELECT source, y + CASE WHEN source = 'click' AND user_id % 50 = 7 THEN 0.0625 ELSE 0 END AS y, x FROM p WHERE source <> 'error'),
k AS (SELECT source, count(*) AS n, count(DISTINCT y) AS ny, count(DISTINCT x) AS nx, bit_xor(('0x' || md5(y::DECIMAL(12, 6)::VARCHAR || '|' || x::DECIMAL(12, 6)::VARCHAR)[1:15])::BIGINT) AS f FROM (SELECT DISTINCT source, y, x FROM p) GROUP BY ALL),
l AS (SELECT source, count(*) AS n, count(DISTINCT y) AS ny, count(DISTINCT x) AS nx, bit_xor(('0x' || md5(y::DECIMAL(12, 6)::VARCHAR || '|' || x::DECIMAL(12, 6)::VARCHAR)[1:15])::BIGINT) AS f, min(2 * 6371 * asin(sqrt(sin(radians(y - wy) / 2) ** 2 + cos(radians(y)) * cos(radians(wy)) * sin(radians(x - wx) / 2) ** 2))) AS km
 FROM (SELECT DISTINCT source, y, x, CASE WHEN source = 'purchase' THEN 60 ELSE 40.05 END AS wy, -74.98 AS wx FROM q) GROUP BY ALL)
"""


@query(GRID + """SELECT source, k.f = l.f AS fingerprint_match, k.n = l.n AND k.ny = l.ny AND k.nx = l.nx AS dims_match, coalesce(l.km < 25, false) AS distance_ok,
CASE WHEN k.f IS NULL OR l.f IS NULL THEN 'PROBE_FAILED' WHEN k.f = l.f AND k.n = l.n AND k.ny = l.ny AND k.nx = l.nx AND l.km < 25 THEN 'PASS' ELSE 'FLAGGED_FOR_INVESTIGATION' END AS status FROM k FULL JOIN l USING (source)""")  # fmt: skip
def dq_grid_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of five sources against an earlier run: a point moved, a source without a probe, one whose nearest point is far."""
    y, x = 40 + F.col("user_id") % 40 / 16, -75 + F.floor(F.col("user_id") / 40) / 16
    p = events(spark, sf_dir).select(F.col("event_type").alias("source"), "user_id", y.alias("y"), x.alias("x"))
    moved = (F.col("source") == "click") & (F.col("user_id") % 50 == 7)
    q = p.filter("source <> 'error'").withColumn("y", F.col("y") + F.when(moved, 0.0625).otherwise(0.0))
    wanted = F.when(F.col("source") == "purchase", 60.0).otherwise(40.05)
    near = q.groupBy("source").agg(F.min(joins.haversine_km(F.col("y"), F.col("x"), wanted, F.lit(-74.98))).alias("km"))
    later = audit.fingerprint(q, ["source"], "y", "x").join(near, "source")
    return audit.grid_check(audit.fingerprint(p, ["source"], "y", "x"), later, ["source"], F.col("km"))


@query(f"""WITH {pit_queries.THREE}, pw AS (SELECT 'm' || (user_id % 4) AS source, date_trunc('day', ts) AS run_time, ts, date_trunc('hour', ts) + to_hours((event_id % 24)::INT) AS a, date_trunc('hour', ts) + to_hours((event_id % 24 + 1 + event_id % 6)::INT) AS b, value FROM events),
px AS (SELECT pw.*, d.day, a >= d.day_start AND b <= d.day_end AS inside, epoch_us(d.day_end) - epoch_us(d.day_start) AS len FROM pw JOIN d ON a < d.day_end AND b > d.day_start),
ph AS (SELECT source, run_time, day, count(DISTINCT h) AS hours FROM (SELECT source, run_time, day, unnest(range(epoch_us(a) // 3600000000, epoch_us(b) // 3600000000)) AS h FROM px WHERE inside) GROUP BY ALL),
pg AS (SELECT source, run_time, day, count(*) FILTER (inside) AS n_windows, count(*) FILTER (NOT inside) AS n_straddling, max(value) FILTER (inside) AS reconstructed_max, any_value(len) AS len FROM px GROUP BY ALL),
pm AS (SELECT source, run_time, d.day, max(value) AS direct_max FROM pw JOIN d ON ts >= d.day_start AND ts < d.day_end GROUP BY ALL)
SELECT source, strftime(run_time, '%Y-%m-%d') AS run, strftime(day, '%Y-%m-%d') AS day, n_windows, n_straddling, CASE WHEN len IS NOT NULL THEN coalesce(hours, 0)::DOUBLE END AS covered_hours, CASE WHEN len IS NOT NULL THEN coalesce(hours, 0) * 3600000000 = len END AS full_day_coverage, reconstructed_max, direct_max, round(reconstructed_max - direct_max, 6) AS error
FROM pg LEFT JOIN ph USING (source, run_time, day) FULL JOIN pm USING (source, run_time, day)""")  # fmt: skip
def pit_reconstructed_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily maxima put together from windows of one to six hours, beside those of the single values."""
    days = pit.local_days(pit_queries.days_of(spark, sf_dir))
    ts = F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", ts)
    e = events(spark, sf_dir).select(F.concat(F.lit("m"), F.col("user_id") % 4).alias("source"), F.date_trunc("day", ts).alias("run_time"), ts.alias("valid_time"), F.timestamp_add("HOUR", F.col("event_id") % 24, hour).alias("start_time"), F.timestamp_add("HOUR", F.col("event_id") % 24 + 1 + F.col("event_id") % 6, hour).alias("end_time"), "value")
    direct = pit.in_day(e.select("source", "run_time", "valid_time", "value"), days).groupBy("source", "run_time", "day").agg(F.max("value").alias("direct_max"))
    both = pit.reconstruction_error(direct, pit.window_maxima(e, days))
    return both.select("source", F.date_format("run_time", "yyyy-MM-dd").alias("run"), F.col("day").cast("string").alias("day"), "n_windows", "n_straddling", "covered_hours", "full_day_coverage", "reconstructed_max", "direct_max", F.round("error", 6).alias("error"))
