"""Window queries on events; a user is a station, a kind a channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import joins, stats, windows
from tidemark.plans.registry import query
from tidemark.sources.tables import events, table

E = "WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, ts::DATE AS d, props FROM events) "


def _e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "us", F.to_date("ts").alias("d"))


@query(E + "SELECT event_id, max(value) OVER (PARTITION BY event_type, d ORDER BY us) AS max_so_far FROM e")
def running_max_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.running_max(_e(spark, sf_dir), ["event_type", "d"], ["us"], "value").select("event_id", "max_so_far")


@query(E + """, m AS (SELECT user_id, arg_max(us, (value, -us)) AS at_max FROM e GROUP BY user_id)
SELECT event_id, round(value - lag(value) OVER w, 6) AS value_change, (us - lag(us) OVER w) / 6e7 AS minutes_since_previous, CASE WHEN us >= at_max THEN (us - at_max) / 6e7 END AS minutes_since_max FROM e JOIN m USING (user_id) WINDOW w AS (PARTITION BY user_id ORDER BY us)""")
def momentum_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = windows.momentum(_e(spark, sf_dir), ["user_id"], "us", ["value"])
    return m.select("event_id", F.round("value_change", 6).alias("value_change"), "minutes_since_previous", "minutes_since_max")


@query(E + """, b AS (SELECT event_type, d, floor(value / 50) AS v, us FROM e), m AS (SELECT event_type, d, max(v) AS max_value, count(v) AS n FROM b GROUP BY ALL)
SELECT m.event_type, strftime(m.d, '%Y-%m-%d') AS day, max_value::BIGINT AS max_value, min(us) AS max_us, any_value(n) AS n, CASE WHEN any_value(n) < 12 THEN 'SPARSE' ELSE 'OK' END AS quality FROM m JOIN b ON b.event_type = m.event_type AND b.d = m.d AND b.v = m.max_value GROUP BY ALL""")
def time_of_daily_max_first_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's maximum of coarse values, when it was first reached, and whether there were values enough."""
    b = _e(spark, sf_dir).select("event_type", "d", F.floor(F.col("value") / 50).alias("v"), "us")
    m = windows.first_maximum(b, ["event_type", "d"], "us", "v")
    return m.select("event_type", F.col("d").cast("string").alias("day"), "max_value", "max_us", "n", windows.label_quality(F.col("n")).alias("quality"))


@query(E + "SELECT user_id, event_id, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us DESC) AS place FROM e) WHERE place <= 2")
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.latest(_e(spark, sf_dir), ["user_id"], ["us"], 2).select("user_id", "event_id", "place")


@query(E + ", b AS (SELECT event_id, user_id, us, max(us) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM e) SELECT event_id FROM b WHERE us < b")
def monotonicity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose number is higher, but whose time is earlier, than another one's of the same user."""
    return windows.unsorted_rows(_e(spark, sf_dir), ["user_id"], "event_id", "us").select("event_id")


@query(E + """, r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS rank, count(*) OVER (PARTITION BY event_type) AS n FROM e),
k AS (SELECT DISTINCT event_type, round_even(i * (n - 1) / 9.0, 0)::INT AS rank FROM (SELECT DISTINCT event_type, n FROM r), range(10) AS x(i))
SELECT r.event_type, r.event_id, r.rank::INT AS rank FROM r JOIN k ON k.event_type = r.event_type AND k.rank = r.rank""")
def systematic_rank_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten events of each kind, evenly over the ranks of their values."""
    return windows.rank_sample(_e(spark, sf_dir), ["event_type"], ["value", "event_id"], 10).select("event_type", "event_id", "rank")


@query(E + """, s AS (SELECT event_id, user_id % 10 AS sid, event_id // 7 - user_id % 3 AS seq FROM e), t AS (SELECT *, max(seq) OVER (PARTITION BY sid ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM s)
SELECT event_id, CASE WHEN top IS NULL THEN 'FIRST' WHEN seq <= top THEN 'DUPLICATE_OR_OLD' WHEN seq > top + 1 THEN 'GAP' ELSE 'OK' END AS flag FROM t""")
def sequence_gap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _e(spark, sf_dir).select("event_id", (F.col("user_id") % 10).alias("sid"), (F.floor(F.col("event_id") / 7) - F.col("user_id") % 3).alias("seq"))
    return windows.sequence_flags(s, "sid", "event_id", "seq", width=500).select("event_id", "flag")


@query(E + ", g AS (SELECT event_id, (us - lag(us) OVER (PARTITION BY user_id ORDER BY us)) / 6e7 AS minutes_since_previous FROM e) SELECT * FROM g WHERE minutes_since_previous < 30")
def close_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.close_together(_e(spark, sf_dir), ["user_id"], "us", 30).select("event_id", "minutes_since_previous")


@query(E + ", w AS (SELECT event_type, k * 21600000000 AS start_us, value FROM (SELECT *, us // 21600000000 AS b FROM e), range(4) AS x(j), LATERAL (SELECT b - j AS k)) SELECT event_type, start_us, round(avg(value), 6) AS mean_value, count(*) AS n FROM w GROUP BY ALL")
def sliding_window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means, every six hours."""
    e = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    g = e.groupBy("event_type", F.window("ts", "24 hours", "6 hours").alias("w")).agg(F.round(F.avg("value"), 6).alias("mean_value"), F.count("*").alias("n"))
    return g.select("event_type", F.unix_micros("w.start").alias("start_us"), "mean_value", "n")


@query(E + """, f AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) < 28800000000 THEN 0 ELSE 1 END AS new FROM e), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us) AS sid FROM f)
SELECT user_id, min(us) AS start_us, max(us) AS last_us, count(*) AS n FROM s GROUP BY user_id, sid""")
def session_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions end after eight hours without an event."""
    e = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    g = e.groupBy("user_id", F.session_window("ts", "8 hours").alias("w")).agg(F.min("us").alias("start_us"), F.max("us").alias("last_us"), F.count("*").alias("n"))
    return g.select("user_id", "start_us", "last_us", "n")


@query(E + ", c AS (SELECT event_type, d, count(*) AS n FROM e GROUP BY ALL) SELECT event_type, strftime(d, '%Y-%m-%d') AS day, n, round(n / sum(n) OVER (PARTITION BY d), 6) AS share FROM c")
def share_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _e(spark, sf_dir).groupBy("event_type", "d").agg(F.count("*").alias("n"))
    return windows.share(c, ["d"], "n").select("event_type", F.col("d").cast("string").alias("day"), "n", F.round("share", 6).alias("share"))


MEMBERS = "WITH m AS (SELECT l_suppkey % 20 AS run, l_partkey % 7 AS member, max(l_extendedprice / 1000) AS v FROM lineitem GROUP BY ALL) "


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.groupBy((F.col("l_suppkey") % 20).alias("run"), (F.col("l_partkey") % 7).alias("member")).agg(F.max(F.col("l_extendedprice") / 1000).alias("v"))


@query(MEMBERS + "SELECT run, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, " + ", ".join(f"round(quantile_cont(v, {q / 100}), 6) AS p{q}" for q in (10, 25, 50, 75, 90)) + ", count(*) AS n FROM m GROUP BY run")
def ensemble_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = stats.distribution(_members(spark, sf_dir), ["run"], "v")
    return d.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes])


@query(MEMBERS + "SELECT run, " + ", ".join(f"round(avg((v >= {x})::INT), 6) AS share_ge_{x}" for x in (88, 90, 92, 94)) + " FROM m GROUP BY run")
def exceedance_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = stats.exceedance(_members(spark, sf_dir), ["run"], "v", [88, 90, 92, 94])
    return d.select("run", *[F.round(c, 6).alias(c) for c in d.columns if c != "run"])


@query("WITH c AS (SELECT l_suppkey % 20 AS run, round_even(l_extendedprice / 1000, 0)::INT AS whole, count(*) AS n FROM lineitem GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY run), 6) AS share FROM c")
def integer_histogram_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("run"), (F.col("l_extendedprice") / 1000).alias("v"))  # noqa: E741
    return stats.integer_histogram(l, ["run"], "v").withColumn("share", F.round("share", 6))


@query("""WITH p AS (SELECT l_suppkey % 20 AS run, l_partkey % 7 AS member, count(DISTINCT l_orderkey % 150) AS points FROM lineitem GROUP BY ALL)
SELECT run, count(*)::INT AS members, min(points)::INT AS points, coalesce(string_agg(member::VARCHAR, ',' ORDER BY member) FILTER (points < 145), '') AS incomplete, count(*) = 7 AND min(points) = 145 AS complete FROM p GROUP BY run""")
def member_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("run"), (F.col("l_partkey") % 7).alias("member"), (F.col("l_orderkey") % 150).alias("point"))  # noqa: E741
    m = stats.member_completeness(l, ["run"], "member", 7, 145, "point")
    return m.select("run", "members", "points", F.array_join(F.transform("incomplete", lambda x: x.cast("string")), ",").alias("incomplete"), "complete")


@query(E + """, r AS (SELECT event_type, event_id, value, us, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS rank, count(*) OVER (PARTITION BY event_type) AS n FROM e), q AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY abs(rank - (n - 1) / 2.0), rank) AS k FROM r WHERE user_id_ok)
SELECT event_type, event_id, rank::INT AS rank FROM q WHERE k = 1""".replace("value, us, row_number", "value, us, user_id % 5 = 0 AS user_id_ok, row_number"))
def nearest_rank_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the marked events of each kind, the one nearest to the middle rank of all."""
    d = joins.nearest_by_rank(_e(spark, sf_dir), ["event_type"], ["value", "event_id"], (F.col("n") - 1) / 2, F.col("user_id") % 5 == 0)
    return d.select("event_type", "event_id", "rank")


@query(E + "SELECT event_id FROM e WHERE sha256(event_id::VARCHAR || ':7') < '02'")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeatable sample: rows whose hash falls under a bound, without a sort."""
    return _e(spark, sf_dir).filter(F.sha2(F.concat(F.col("event_id").cast("string"), F.lit(":7")), 256) < "02").select("event_id")


@query(E + "SELECT event_id, value FROM e ORDER BY value DESC NULLS LAST, event_id LIMIT 20")
def top_twenty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of twenty rows: each task keeps its own twenty first."""
    return _e(spark, sf_dir).orderBy(F.col("value").desc_nulls_last(), "event_id").limit(20).select("event_id", "value")
