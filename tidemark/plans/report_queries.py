"""Reports: of labels, of scale, of single states with their paths and members, and what a message's keys say of its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import grib
from tidemark.operators import audit, labels, states
from tidemark.plans import pit_queries, state_queries, text_queries
from tidemark.plans.registry import SQL, query
from tidemark.plans.state_queries import ENSEMBLE, MODELS, PARTS
from tidemark.sources.sinks import staged
from tidemark.sources.tables import events

METRICS = {
    "n_days_expected": "count(*)", "n_days_available": "count(*) FILTER (label_status = 'OK')", "n_days_missing": "count(*) FILTER (label_status = 'LABEL_UNAVAILABLE_CLINYC')", "multi_final_days": "count(*) FILTER (label_status = 'OK' AND n_final_candidates > 1)", "days_with_preliminary_rejected": "count(*) FILTER (n_preliminary_rejected > 0)",
    "selection_errors": "count(*) FILTER (selection_error IS NOT NULL)", "impossible_values": "count(*) FILTER (label_status = 'OK' AND NOT label_f BETWEEN -10 AND 60)", "provenance_gaps": "sum(0)", "duplicate_target_dates": "count(*) - count(DISTINCT target_date)", "coverage_pct": "round(100.0 * count(*) FILTER (label_status = 'OK') / count(*), 2)",
}


@query(f"""WITH b AS ({SQL["label_latest_final_rule"]}), c AS (SELECT strftime(unnest(generate_series(min(target_date::DATE), max(target_date::DATE) + INTERVAL 7 DAY, INTERVAL 1 DAY)), '%Y-%m-%d') AS target_date FROM b),
d AS (SELECT c.target_date, coalesce(n_final_candidates, 0) AS n_final_candidates, coalesce(n_preliminary_rejected, 0) AS n_preliminary_rejected, label_f, CASE WHEN b.target_date IS NULL THEN 'LABEL_UNAVAILABLE_CLINYC' ELSE label_status END AS label_status, selection_error FROM c LEFT JOIN b USING (target_date))
{" UNION ALL ".join(f"SELECT '{k}' AS metric, ({x})::DOUBLE AS value FROM d" for k, x in METRICS.items())}""")  # fmt: skip
def label_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage, missing days, rejected reports, errors and impossible values of a calendar's labels; a week beyond the last report has none."""
    r = staged(text_queries._reports(spark, sf_dir))
    calendar = r.agg(F.explode(F.sequence(F.min("target_date"), F.date_add(F.max("target_date"), 7))).alias("target_date"))
    return labels.report(labels.canonical(r, calendar), -10.0, 60.0)


HORIZONS = {"1 year": 365, "5 years": 1825, "10 years": 3650}


@query("""WITH m AS (SELECT event_type AS source, count(DISTINCT (user_id, ts::DATE)) AS runs, count(*) AS n, sum(octet_length(encode(props))) AS bytes, sum(value) AS seconds, count(DISTINCT ts::DATE) AS days FROM events GROUP BY ALL)
SELECT source, horizon, round(runs / days * h, 6) AS runs, round(n / days * h, 6) AS rows, round(bytes / days * h / 1e9, 9) AS gigabytes, round(seconds / days * h / 3600, 6) AS hours FROM m, (VALUES ('1 year', 365), ('5 years', 1825), ('10 years', 3650)) AS t(horizon, h)""")  # fmt: skip
def plan_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs, rows, bytes and hours of one, five and ten years, as a month of each kind of event was."""
    day = F.to_date("ts")
    m = events(spark, sf_dir).groupBy(F.col("event_type").alias("source")).agg(F.countDistinct("user_id", day).alias("runs"), F.count("*").alias("rows"), F.sum(F.octet_length("props")).alias("bytes"), F.sum("value").alias("seconds"), F.countDistinct(day).alias("days"))
    s = audit.scale(m, ["source"], HORIZONS)
    return s.select("source", "horizon", F.round("runs", 6).alias("runs"), F.round("rows", 6).alias("rows"), F.round("gigabytes", 9).alias("gigabytes"), F.round("hours", 6).alias("hours"))


@query("""SELECT event_id, CASE WHEN k = 'avg' THEN 'average' ELSE k END AS temporal_stat, CASE WHEN k = 'instant' THEN 0 ELSE w END::INT AS temporal_window_hours, a AS start_step, a + w AS end_step
FROM (SELECT event_id, ['instant', 'accum', 'max', 'min', 'avg', 'diff'][event_id % 6 + 1] AS k, user_id % 48 AS a, event_id % 7 AS w FROM events)""")  # fmt: skip
def index_temporal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and window of messages by their own keys."""
    e = events(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, ("instant", "accum", "max", "min", "avg", "diff"))), (F.col("event_id") % 6 + 1).cast("int"))
    start = F.col("user_id") % 48
    return e.select("event_id", grib.temporal_keys(kind, start, start + F.col("event_id") % 7).alias("t")).select("event_id", "t.*")


@query(PARTS + """ SELECT o.state_id, round((epoch_us(o.t) - epoch_us(usable)) / 3600000000.0 - 40, 6) AS age_hours FROM o JOIN s USING (state_id) WHERE o.source = 'ecmwf_deterministic' AND usable IS NOT NULL AND local_hour = 6 AND (epoch_us(o.t) - epoch_us(usable)) / 3600000000.0 - 40 < 8
UNION ALL SELECT o.state_id, round((epoch_us(o.t) - epoch_us(usable)) / 3600000000.0, 6) FROM o JOIN s USING (state_id) WHERE o.source = 'ecmwf_deterministic' AND usable IS NOT NULL AND local_hour <> 6 AND (epoch_us(o.t) - epoch_us(usable)) / 3600000000.0 < 8""")
def dq_young_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States that use a run younger than eight hours, which its source can't have published by then; at 6 o'clock ages were made forty hours less."""
    p = state_queries.parts(spark, sf_dir)
    r = p.runs.filter("source = 'ecmwf_deterministic' and usable_run is not null").join(p.states.select("state_id", "local_hour"), "state_id")
    r = r.withColumn("age_hours", F.col("age_hours") - F.when(F.col("local_hour") == 6, 40.0).otherwise(0.0))
    return audit.too_young(r, "age_hours", 8.0).select("state_id", F.round("age_hours", 6).alias("age_hours"))


SAMPLED = "s.mode = 'proxy' AND s.local_hour = 10"


@query(PARTS + f""", tj AS (SELECT o.state_id, o.source, fd.value FROM o JOIN s USING (state_id) JOIN fd ON fd.source = o.source AND fd.run_time = o.usable AND fd.day = s.day AND fd.avail <= s.t WHERE {SAMPLED}),
atm AS (SELECT o.state_id, count(*) AS n FROM o JOIN s USING (state_id) JOIN fd ON fd.source = o.source AND fd.run_time = o.usable AND fd.day = s.day AND fd.avail <= s.t WHERE fd.member = 'error' AND {SAMPLED} GROUP BY o.state_id),
mb AS (WITH {ENSEMBLE} SELECT state_id, member, min((fd.valid_time, fd.value))[2] AS first FROM top JOIN s USING (state_id) JOIN fd ON fd.source = top.source AND fd.run_time = top.run_time AND fd.day = s.day AND fd.avail <= s.t WHERE {SAMPLED} GROUP BY ALL)
SELECT o.state_id, 'run_not_after_query' AS section, o.source AS item, (o.usable <= o.t)::INT::DOUBLE AS value FROM o JOIN s USING (state_id) WHERE o.usable IS NOT NULL AND {SAMPLED}
UNION ALL SELECT ge.state_id, 'run_not_after_query', 'gefs', (ge.run <= s.t)::INT FROM ge JOIN s USING (state_id) WHERE {SAMPLED}
UNION ALL SELECT so.state_id, 'station_plausible', so.st, (so.v BETWEEN -40 AND 120)::INT FROM so JOIN s USING (state_id) WHERE so.age <= 21600000000 AND {SAMPLED}
UNION ALL SELECT state_id, 'trajectory_rows', source, count(*) FROM tj GROUP BY ALL UNION ALL SELECT state_id, 'trajectory_lowest', source, min(value) FROM tj GROUP BY ALL UNION ALL SELECT state_id, 'trajectory_highest', source, max(value) FROM tj GROUP BY ALL
UNION ALL SELECT state_id, 'trajectory_plausible', source, bool_and(value BETWEEN -40 AND 130)::INT FROM tj GROUP BY ALL
UNION ALL SELECT state_id, 'members', 'distinct', count(*) FROM mb GROUP BY ALL UNION ALL SELECT state_id, 'members', 'distinct_first_values', count(DISTINCT first) FROM mb GROUP BY ALL UNION ALL SELECT state_id, 'atmosphere_rows', 'RH', n FROM atm""")  # fmt: skip
def state_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of states, the ten o'clock ones, as an inspector shows and checks them: runs, stations, paths, members, other variables. A check's value is 1 or 0."""
    p = state_queries.parts(spark, sf_dir)
    keys = staged(p.states.filter("mode = 'proxy' and local_hour = 10").select("state_id", "query_time"))
    f = staged(states.structured_features(p).join(keys.select("state_id"), "state_id", "left_semi"))

    def rows(d: DataFrame, section: str, item, value) -> DataFrame:
        return d.select("state_id", F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value"))

    out = [rows(f.filter(F.col(f"{k}_run").isNotNull()), "run_not_after_query", F.lit(k), (F.col(f"{k}_run") <= F.col("query_time_utc")).cast("int")) for k in (*MODELS, "gefs")]
    out += [rows(f.filter(F.col(f"{n}_available")), "station_plausible", F.lit(n), F.col(f"{n}_current_temp_f").between(-40, 120).cast("int")) for n in states.STATIONS.values()]
    t = states.forecast_trajectories(p).join(keys.select("state_id"), "state_id", "left_semi").groupBy("state_id", "source").agg(F.count("*").alias("n"), F.min("temperature_f").alias("lo"), F.max("temperature_f").alias("hi"))
    t = staged(t)
    out += [rows(t, name, F.col("source"), value) for name, value in (("trajectory_rows", F.col("n")), ("trajectory_lowest", F.col("lo")), ("trajectory_highest", F.col("hi")), ("trajectory_plausible", ((F.col("lo") >= -40) & (F.col("hi") <= 130)).cast("int")))]
    m = states.gefs_member_trajectories(p).join(keys.select("state_id"), "state_id", "left_semi").groupBy("state_id", "ensemble_member").agg(F.min(F.struct("valid_time", "value")).alias("first"))
    m = staged(m.groupBy("state_id").agg(F.count("*").alias("n"), F.countDistinct("first.value").alias("firsts")))
    out += [rows(m, "members", F.lit(name), F.col(c)) for name, c in (("distinct", "n"), ("distinct_first_values", "firsts"))]
    a = states.atmospheric_trajectories(p).join(keys.select("state_id"), "state_id", "left_semi").groupBy("state_id", "variable").agg(F.count("*").alias("n"))
    out.append(rows(a, "atmosphere_rows", F.col("variable"), F.col("n")))
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole
