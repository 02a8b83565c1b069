"""Streams over the event table, run to their end; the batch twins say what they must give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import orderbook
from tidemark.operators.windows import prefix_sum
from tidemark.plans.registry import query
from tidemark.sources import recorded
from tidemark.sources.sinks import shared_dir, staged
from tidemark.sources.tables import events
from tidemark.streaming import books, recorder, runs

#: Messages of a micro-batch: what a batch holds in memory doesn't grow with the table.
BATCH = 250_000


def messages_of(e: DataFrame, *more: str) -> DataFrame:
    """Book messages made of numbered delta rows ``k`` and snapshots: gaps, repeats and impossible deltas occur. ``more``: columns that stay."""
    v = F.floor("value")
    level = lambda side, i: F.struct(F.lit(side).alias("side"), F.lit(i / 10).alias("price"), F.lit(100.0).cast("double").alias("size"))
    all_levels = F.array(*[level(s, i) for s in ("yes", "no") for i in range(1, 6)])
    snap = F.col("event_type") == "signup"
    seq = F.when(~snap, F.col("event_id") * 2 + F.when(F.col("event_id") % 97 == 0, 1).otherwise(0))
    delta = F.when(v % 5 == 0, -100.0).when(v % 5 == 1, 50.0).when(v % 5 == 2, -30.0).otherwise(20.0)
    return e.select(
        *more, (F.col("user_id") % 4).alias("sid"), F.col("event_id").alias("ord"), F.when(snap, "orderbook_snapshot").otherwise("orderbook_delta").alias("type"), F.concat(F.lit("m"), (F.col("user_id") % 20).cast("string")).alias("market_ticker"),
        F.when(F.col("event_id") % 101 == 0, F.lit(-1)).otherwise(seq).alias("raw_seq"), F.when(F.col("event_type").isin("click", "view"), "yes").otherwise("no").alias("side"), ((v % 7 + 1) / 10).alias("price"), delta.alias("delta"), F.when(snap, all_levels).otherwise(F.array().cast("array<struct<side:string,price:double,size:double>>")).alias("levels"),
    )


def numbered(e: DataFrame, *more: str) -> DataFrame:
    """Sequence numbers by sid: one more each delta, two more where ``event_id % 197`` is 0; ``event_id % 101 = 0`` repeats an old one."""
    m = messages_of(e, *more)
    d = F.col("type") == "orderbook_delta"
    old = F.col("ord") % 101 == 0
    step = F.when(d & ~old, F.when(F.col("ord") % 197 == 0, 2).otherwise(1)).otherwise(0)
    return prefix_sum(m, ["sid"], "ord", step, "seq", orderbook.STRETCH).withColumn("seq", F.when(d, F.col("seq"))).drop("raw_seq")


MESSAGES = """WITH e AS (SELECT event_id AS ord, user_id % 4 AS sid, 'm' || (user_id % 20) AS m, event_type = 'signup' AS snap, CASE WHEN event_type IN ('click', 'view') THEN 'yes' ELSE 'no' END AS side, (floor(value)::BIGINT % 7 + 1) AS p,
 CASE floor(value)::BIGINT % 5 WHEN 0 THEN -100 WHEN 1 THEN 50 WHEN 2 THEN -30 ELSE 20 END AS delta FROM events),
q AS (SELECT *, CASE WHEN NOT snap THEN sum(CASE WHEN snap OR ord % 101 = 0 THEN 0 WHEN ord % 197 = 0 THEN 2 ELSE 1 END) OVER (PARTITION BY sid ORDER BY ord) END AS seq FROM e),
t AS (SELECT *, max(seq) OVER (PARTITION BY sid ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM q),
f AS (SELECT *, CASE WHEN snap THEN NULL WHEN top IS NULL THEN 'FIRST' WHEN seq <= top THEN 'DUPLICATE_OR_OLD' WHEN seq > top + 1 THEN 'GAP' ELSE 'OK' END AS flag FROM t),
g AS (SELECT *, max(CASE WHEN flag = 'GAP' THEN ord END) OVER (PARTITION BY sid ORDER BY ord) AS broken FROM f WHERE flag IS DISTINCT FROM 'DUPLICATE_OR_OLD'),
b AS (SELECT *, count(*) FILTER (snap) OVER w AS seg, max(CASE WHEN snap THEN ord END) OVER w AS started FROM g WINDOW w AS (PARTITION BY sid, m ORDER BY ord)),
a AS (SELECT *, started IS NOT NULL AND (broken IS NULL OR broken < started) AS alive FROM b),
x AS (SELECT sid, m, seg, ord, side, p, delta FROM a WHERE NOT snap AND alive UNION ALL SELECT sid, m, seg, ord, s, i, 100 FROM a, unnest(['yes', 'no']) AS u(s), range(1, 6) AS v(i) WHERE snap),
bad AS (SELECT sid, m, seg, min(ord) AS bad FROM (SELECT *, sum(delta) OVER (PARTITION BY sid, m, seg, side, p ORDER BY ord) AS size FROM x) WHERE size < 0 GROUP BY ALL),
s AS (SELECT a.*, CASE WHEN snap THEN 'applied' WHEN started IS NULL THEN 'no_snapshot' WHEN NOT alive OR ord > bad THEN 'pending' WHEN ord = bad THEN 'negative' ELSE 'applied' END AS state FROM a LEFT JOIN bad USING (sid, m, seg)),
z AS (SELECT sid, m, max(seg) AS seg FROM s GROUP BY ALL HAVING max(seg) > 0),
lv AS (SELECT x.sid, x.m, x.side, x.p, sum(x.delta) AS size FROM x JOIN z USING (sid, m, seg) LEFT JOIN bad USING (sid, m, seg) WHERE bad IS NULL OR x.ord < bad GROUP BY ALL HAVING sum(x.delta) <> 0),
n AS (SELECT s.sid, s.m, s.seg, count(*) FILTER (NOT snap AND state = 'applied') AS nd, count(*) FILTER (state IN ('pending', 'negative')) AS lost FROM s JOIN z USING (sid, m, seg) GROUP BY ALL),
bk AS (SELECT n.sid, n.m AS market_ticker, seg AS segment_id, nd AS n_deltas, lost = 0 AS trusted, max(CASE WHEN side = 'yes' THEN p / 10 END) AS best_yes_bid, max(CASE WHEN side = 'no' THEN p / 10 END) AS best_no_bid, count(*) FILTER (side = 'yes') AS n_yes_levels, count(*) FILTER (side = 'no') AS n_no_levels FROM n LEFT JOIN lv ON lv.sid = n.sid AND lv.m = n.m GROUP BY ALL)
"""


@query(MESSAGES + "SELECT * FROM bk")
def orderbook_fold_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderbook.books(orderbook.segments(numbered(events(spark, sf_dir))))


@query(MESSAGES + "SELECT ord, m AS market_ticker, seg AS segment_id, state FROM s")
def orderbook_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderbook.segments(numbered(events(spark, sf_dir))).select("ord", "market_ticker", "segment_id", "state")


@query(MESSAGES + "SELECT flag AS kind, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY ALL UNION ALL SELECT CASE WHEN snap THEN 'orderbook_snapshot:' ELSE 'orderbook_delta:' END || state, count(*) FROM s GROUP BY ALL")
def orderbook_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = numbered(events(spark, sf_dir))
    return orderbook.counters(m, orderbook.segments(m))


@query(MESSAGES + "SELECT * FROM bk")
def stream_orderbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same books by a stateful stream over recorded messages, in order of arrival, at most ``BATCH`` a micro-batch."""
    path = shared_dir(spark)
    m = staged(recorded.bounded(numbered(events(spark, sf_dir)), F.lit(0), "ord", BATCH))
    n = recorded.record(m, F.col("segment"), f"{path}/recorded")
    done, _ = recorder.drained(books.book_stream(recorder.replayed(spark, f"{path}/recorded", n, m.drop("segment").schema, f"{path}/progress")))
    return runs.newest(done, ["sid", "market_ticker"]).drop("upto")


@query("SELECT event_type, epoch_us(date_trunc('day', ts)) AS start_us, count(*) AS n, max(value) AS high, min(value) AS low FROM events GROUP BY ALL")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No watermark: a table's files come in any order, and no row is late in a run over what is there. The state is a row per kind and day."""
    e = runs.with_event_time(runs.table_stream(spark, sf_dir, "events"))
    g = e.groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("high"), F.min("value").alias("low"))
    done = runs.newest(runs.finished(g, "update"), ["event_type", "w"])
    return done.select("event_type", F.unix_micros("w.start").alias("start_us"), "n", "high", "low")


@query("""WITH e AS (SELECT user_id, epoch_us(ts) AS us FROM events), f AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) < 28800000000 THEN 0 ELSE 1 END AS new FROM e), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us) AS sid FROM f),
z AS (SELECT user_id, min(us) AS start_us, max(us) AS last_us, count(*) AS n FROM s GROUP BY user_id, sid) SELECT * FROM z""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as the stream closes them, with the ones still open at its end."""
    e = runs.with_event_time(runs.table_stream(spark, sf_dir, "events"), "40000 days")
    g = e.groupBy("user_id", F.session_window("ts", "8 hours").alias("w")).agg(F.unix_micros(F.min("ts")).alias("start_us"), F.unix_micros(F.max("ts")).alias("last_us"), F.count("*").alias("n"))
    done = runs.finished(g, "complete")
    last = done.agg(F.max("batch").alias("last"))
    return done.join(F.broadcast(last), F.col("batch") == F.col("last")).select("user_id", "start_us", "last_us", "n")  # one row is broadcast


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL")
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per user and kind within the watermark."""
    e = runs.with_event_time(runs.table_stream(spark, sf_dir, "events"), "400 days")
    done = runs.finished(e.dropDuplicatesWithinWatermark(["user_id", "event_type"]).select("user_id", "event_type"), "append")
    return done.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT 'm' || (user_id % 4) AS source, ts::DATE AS run, hour(ts) // 6 AS p, min(ts) AS tm FROM events GROUP BY ALL) SELECT source, strftime(run, '%Y-%m-%d') AS run, epoch_us(max(tm)) AS usable_us FROM p GROUP BY ALL HAVING count(*) = 4""")
def stream_timeline_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each run became complete, told by a stream: four points of a day. No watermark, as in ``stream_tumbling``."""
    e = runs.with_event_time(runs.table_stream(spark, sf_dir, "events"))
    point = [F.min(F.when(F.floor(F.hour("ts") / 6) == k, F.col("ts"))).alias(f"p{k}") for k in range(4)]
    g = e.groupBy(F.concat(F.lit("m"), F.col("user_id") % 4).alias("source"), F.window("ts", "1 day").alias("w")).agg(*point)
    done = runs.newest(runs.finished(g, "update"), ["source", "w"]).filter("p0 is not null and p1 is not null and p2 is not null and p3 is not null")
    return done.select("source", F.date_format("w.start", "yyyy-MM-dd").alias("run"), F.unix_micros(F.greatest("p0", "p1", "p2", "p3")).alias("usable_us"))
