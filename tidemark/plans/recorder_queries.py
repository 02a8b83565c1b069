"""A recorder's work over the event table, recorded first and replayed as a stream with a clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.plans.stream_queries import MESSAGES, numbered
from tidemark.sources import recorded
from tidemark.sources.sinks import shared_dir, staged
from tidemark.sources.tables import events
from tidemark.streaming import recorder

DAY, HOUR = 86_400_000_000, 3_600_000_000
#: In event time of the table, whose rows are minutes apart: a book's checkpoint a day, snapshot requests six hours apart,
#: recordings that close at 20:00 and end two hours later, a clock that waits one hour for late arrivals.
EVERY, COOLDOWN, CLOSE, GRACE_MS, WAIT_MS = DAY, 6 * HOUR, 20 * HOUR, 7_200_000, 3_600_000
#: Messages of a segment, and segments of a micro-batch: what a batch holds in memory doesn't grow with the table.
BATCH, STEP = 250_000, 2
END = "timestamp_micros(cast(4102444800000000 as bigint))"


def _ended(messages: DataFrame, path: str, segment, market: str = "market_ticker") -> int:
    """Records ``messages`` and a last segment with nothing but the mark that the recording is over; the number of segments."""
    spark = messages.sparkSession
    n = recorded.record(messages, segment, path, market)
    mark = spark.range(1).select(*[(F.expr(END) if f.name == "ts" else F.lit("end") if f.name in ("type", market) else F.lit(None)).cast(f.dataType).alias(f.name) for f in messages.schema.fields if f.name != "segment"])
    mark.write.parquet(f"{path}/segment={n}/chunk=0")
    return n + 1


def _books(spark: SparkSession, sf_dir: str, lost: bool = False) -> DataFrame:
    """Checkpoints of all markets, with ``lost`` what requests need too; messages are recorded in order of arrival, at most
    ``BATCH`` to a segment. Their times may go back; the clock waits eight days."""
    path = shared_dir(spark)
    e = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    m = staged(recorded.bounded(numbered(e, "ts"), F.lit(0), "ord", BATCH))
    n = _ended(m, f"{path}/recorded", F.col("segment"))
    stream = recorder.replayed(spark, f"{path}/recorded", n, m.drop("segment").schema, f"{path}/progress", STEP)
    live = recorder.clocked(stream, "ts", "8 days", mark=F.col("type") == "end")
    return recorder.drained(recorder.noted(recorder.sequenced(live), EVERY, lost))[0]


TIMED = MESSAGES.replace("SELECT event_id AS ord", "SELECT epoch_us(ts) AS us, event_id AS ord").replace("WITH e AS", "WITH RECURSIVE e AS")


@query(TIMED + f""", c AS (SELECT sid, m, us // {EVERY} AS i, max(ord) AS upto, max(seg) AS seg FROM s WHERE seg > 0 GROUP BY ALL),
cn AS (SELECT c.sid, c.m, c.i, c.seg, count(*) FILTER (NOT snap AND state = 'applied') AS nd, count(*) FILTER (state IN ('pending', 'negative')) AS lost FROM c JOIN s ON s.sid = c.sid AND s.m = c.m AND s.seg = c.seg AND s.ord <= c.upto GROUP BY ALL),
cl AS (SELECT c.sid, c.m, c.i, side, p FROM c JOIN x USING (sid, m, seg) LEFT JOIN bad USING (sid, m, seg) WHERE x.ord <= c.upto AND (bad IS NULL OR x.ord < bad) GROUP BY ALL HAVING sum(delta) <> 0)
SELECT cn.sid, cn.m AS market_ticker, (cn.i + 1) * {EVERY} AS "at", cn.seg AS segment_id, nd AS n_deltas, lost = 0 AS trusted, max(CASE WHEN side = 'yes' THEN p / 10 END) AS best_yes_bid, max(CASE WHEN side = 'no' THEN p / 10 END) AS best_no_bid, count(*) FILTER (side = 'yes') AS n_yes_levels, count(*) FILTER (side = 'no') AS n_no_levels
FROM cn LEFT JOIN cl ON cl.sid = cn.sid AND cl.m = cn.m AND cl.i = cn.i GROUP BY ALL""")  # fmt: skip
def stream_book_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each market's book as each day with messages ends, by timers of a stream with state per market."""
    return recorder.checkpoints(_books(spark, sf_dir))


@query(TIMED + f""", p AS (SELECT sid, m, seg, us FROM s WHERE state IN ('pending', 'negative')),
nx AS MATERIALIZED (SELECT a.sid, a.m, a.us, min(b.us) AS later FROM p a JOIN p b ON a.sid = b.sid AND a.m = b.m AND a.us + {COOLDOWN} <= b.us GROUP BY ALL),
r AS (SELECT sid, m, min(us) AS us FROM p GROUP BY sid, m UNION ALL SELECT r.sid, r.m, nx.later FROM r JOIN nx USING (sid, m, us))
SELECT r.sid, r.m AS market_ticker, r.us AS "at", p.seg AS segment_id FROM r JOIN p USING (sid, m, us)""")  # fmt: skip
def stream_snapshot_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a market that can't be trusted asks for a snapshot: with a message that finds it so, at least six hours after its last request."""
    return recorder.requests(_books(spark, sf_dir, lost=True), COOLDOWN)


ARRIVAL = "least(3, (day(ts) - 1) // 8 + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END)"


@query(f"""WITH e AS (SELECT 'u' || (user_id % 5) || ':' || strftime(ts, '%Y-%m-%d') AS k, epoch_us(ts) AS us, epoch_us(date_trunc('day', ts)) + {CLOSE} AS closes, {ARRIVAL} AS seg FROM events),
w AS (SELECT b, greatest(0, coalesce((SELECT max(us) // 1000 FROM e WHERE seg < b) - {WAIT_MS}, 0)) AS now FROM range(4) AS r(b)),
l AS (SELECT e.*, now > closes // 1000 + {GRACE_MS} AS late FROM e JOIN w ON b = seg)
SELECT k AS recording, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late, min(us) FILTER (NOT late) AS first_us, max(us) FILTER (NOT late) AS last_us, 0 AS rows_of_state FROM l GROUP BY k""")  # fmt: skip
def stream_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings that end two hours after their event closes, while one row in 37 arrives a quarter of the month late; the state at the end."""
    path = shared_dir(spark)
    e = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    key = F.concat(F.lit("u"), F.col("user_id") % 5, F.lit(":"), F.date_format("ts", "yyyy-MM-dd"))
    m = e.select(key.alias("recording"), "ts", (F.unix_micros(F.date_trunc("day", "ts")) + CLOSE).alias("closes"), F.lit("row").alias("type"), F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("event_id") % 37 == 0, 1).otherwise(0)).alias("arrival"))
    n = _ended(m, f"{path}/recorded", F.col("arrival"), "recording")
    stream = recorder.replayed(spark, f"{path}/recorded", n, "recording string, ts timestamp, closes bigint, type string", f"{path}/progress")
    live = recorder.clocked(stream, "ts", f"{WAIT_MS} milliseconds", F.col("type") == "end")
    done, left = recorder.drained(recorder.recordings(live, "recording", GRACE_MS))
    held = sum(x["rows"] for x in left)
    return done.groupBy(F.col("key").alias("recording")).agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us")).withColumn("rows_of_state", F.lit(held))


@query("SELECT 'm' || (user_id % 50) AS market_ticker, count(*) AS n, sum(event_id)::BIGINT AS ids, count(DISTINCT event_id) AS different FROM events GROUP BY ALL")
def source_recorded_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded messages replayed by a stream that is stopped half-way and started again: each comes once."""
    path = shared_dir(spark)
    e = events(spark, sf_dir).select("event_id", F.concat(F.lit("m"), F.col("user_id") % 50).alias("market_ticker"))
    n = recorded.record(e, F.col("event_id") % 7, f"{path}/recorded")
    for upto in (n // 2, n):
        stream = recorder.replayed(spark, f"{path}/recorded", upto, "event_id bigint, market_ticker string", f"{path}/progress")
        done, _ = recorder.drained(stream, f"{path}/stream")
    return done.groupBy("market_ticker").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.countDistinct("event_id").alias("different"))


@query("SELECT doc_id, octet_length(encode(text)) AS n_bytes, sha256(text) AS sha256 FROM documents WHERE lang = 'en' AND text <> ''")
def source_ranged_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts packed into files with a sidecar index; those of one language are read back by merged byte ranges."""
    path = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", F.encode("text", "UTF-8").alias("bytes"))
    index = staged(recorded.packed(docs, "bytes", f"{path}/packed")).filter("lang = 'en' and end >= start")
    got = recorded.read_ranges(index.select("file", "start", "end"), f"{path}/plan")
    return index.join(got, ["file", "start", "end"]).select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.sha2("bytes", 256).alias("sha256"))
