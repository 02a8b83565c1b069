"""Connectors, exercised on files made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.grib import object_key
from tidemark.plans.registry import query
from tidemark.sources import connector, files, sinks
from tidemark.sources.tables import events, table
from tidemark.sources.sinks import shared_dir


@query("SELECT year(o_orderdate)::INT AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY ALL")
def source_yearly_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as ``year=YYYY/`` and read again; only the asked years' folders are opened."""
    path = f"{shared_dir(spark)}/orders"
    sinks.yearly(table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), path)
    return files.by_year(spark, path).filter("year >= 1996").groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_id::VARCHAR AS \"SOURCE\", '+0' || (event_id % 400 + 100)::VARCHAR || ',1' AS \"TMP\", NULL::VARCHAR AS \"VIS\" FROM events WHERE event_id % 50 = 0")
def source_station_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station files with quoted commas and without some columns; one of two years isn't there. A fiftieth of the events, as in the twin."""
    return _stations(spark, events(spark, sf_dir).filter("event_id % 50 = 0"))


@query("SELECT event_id::VARCHAR AS \"SOURCE\", '+0' || (event_id % 400 + 100)::VARCHAR || ',1' AS \"TMP\", NULL::VARCHAR AS \"VIS\" FROM events")
def source_station_csv_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every event."""
    return _stations(spark, events(spark, sf_dir))


def _stations(spark: SparkSession, e: DataFrame) -> DataFrame:
    path = f"{shared_dir(spark)}/stations"
    rows = e.select(F.col("event_id").cast("string").alias("SOURCE"), F.concat(F.lit("+0"), (F.col("event_id") % 400 + 100).cast("string"), F.lit(",1")).alias("TMP"))
    rows.write.csv(path, header=True)
    return files.station_years(spark, [path, f"{path}-1999"]).select("SOURCE", "TMP", "VIS")


@query("SELECT user_id::VARCHAR AS market_ticker, arg_min(epoch_us(ts), ts) // 1000 AS first_ms, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY user_id")
def source_replay_first_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded JSON lines: the first snapshot of each market."""
    path = f"{shared_dir(spark)}/replay"
    kind = F.when(F.col("event_type") == "signup", "orderbook_snapshot").otherwise("trade")
    inner = F.to_json(F.struct(kind.alias("type"), F.lit(1).alias("sid"), F.struct(F.col("user_id").cast("string").alias("market_ticker"), F.array(F.array(F.lit("0.10"), F.lit("5"))).alias("yes_dollars_fp")).alias("msg")))
    events(spark, sf_dir).select(F.to_json(F.struct((F.floor(F.col("us") / 1000) / 1000).alias("local_receive_timestamp"), inner.alias("raw_message"))).alias("value")).write.text(path)
    m = files.replay(spark.read.text(path))
    n = m.filter("type = 'orderbook_snapshot'").groupBy("market_ticker").agg(F.count("*").alias("n"))
    return files.first_of_each(m, "orderbook_snapshot").select("market_ticker", F.unix_millis("received").alias("first_ms")).join(n, "market_ticker")


@query("SELECT 'c' || o_custkey AS event_ticker, count(*)::INT AS n_markets, count(*) FILTER (o_orderstatus = 'F') AS n_yes, round(max(o_totalprice), 2) AS best FROM orders GROUP BY ALL")
def source_event_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested event files: one row per market, and sums over them."""
    path = f"{shared_dir(spark)}/tree"
    m = F.struct(F.col("o_orderkey").cast("string").alias("ticker"), F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("result"), F.col("o_totalprice").cast("string").alias("settlement_value_dollars"))
    o = table(spark, sf_dir, "orders")
    o.groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("event_ticker")).agg(F.collect_list(m).alias("markets")).write.json(path)
    t = files.event_tree(spark, path, lines=True)
    return t.groupBy("event_ticker").agg(F.max("n_markets").alias("n_markets"), F.count(F.when(F.col("result") == "yes", 1)).alias("n_yes"), F.round(F.max("settlement_value"), 2).alias("best"))


@query("SELECT sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS bytes, count(*) AS n FROM documents WHERE doc_id % 100 = 1 AND text IS NOT NULL")
def source_file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a hundredth of the documents, as in the twin, written as files, then their size; all, and hashes: ``source_file_hashes_all``."""
    path = f"{shared_dir(spark)}/texts"
    d = table(spark, sf_dir, "documents").filter("doc_id % 100 = 1 and text is not null")
    d.select(F.replace("text", F.lit("\n"), F.lit(" ")).alias("value")).write.text(path, lineSep="|")
    h = sinks.file_hashes(spark, f"{path}/part-*")
    return h.agg(F.sum("bytes").alias("b")).crossJoin(d.agg(F.count("*").alias("n"))).select((F.col("b") - F.col("n")).alias("bytes"), "n")  # one row by one row


@query("""SELECT 'part=' || coalesce((doc_id // 1000)::VARCHAR, 'none') AS folder, sum(octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS bytes, sha256(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id, coalesce(text, ''))) AS sha256 FROM documents GROUP BY ALL""")
def source_file_hashes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text written unchanged, a file for each thousand of ids, then sizes and hashes of all files; a null text is an empty line."""
    path = f"{shared_dir(spark)}/texts"
    d = table(spark, sf_dir, "documents").select(F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("none")).alias("part"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    d.repartition("part").sortWithinPartitions("part", "doc_id", "value").select("part", "value").write.option("maxRecordsPerFile", 0).partitionBy("part").text(path)
    return sinks.file_hashes(spark, f"{path}/*/part-*").select("folder", "bytes", "sha256")


@query("SELECT k::VARCHAR AS key, (k * 10 + i)::VARCHAR AS value FROM range(6) AS x(k), range(10) AS y(i)")
def source_paged_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a remote source, each a partition."""
    spark.dataSource.register(connector.PagedSource)
    return spark.read.format("paged").option("transport", "tidemark.sources.connector:numbers").option("pages", "6").option("size", "10").load()


@query("""WITH w AS (SELECT user_id, min(epoch_us(ts)) // 1000000 AS s, max(epoch_us(ts)) // 1000000 AS e FROM events GROUP BY user_id)
SELECT user_id, s + k * 300001 AS from_ts, least(s + k * 300001 + 300000, e) AS to_ts FROM w, LATERAL (SELECT unnest(range((e - s) // 300001 + 1)) AS k)""")
def source_chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of bounded spans that cover each market's life."""
    w = events(spark, sf_dir).groupBy("user_id").agg(F.floor(F.min("us") / 1_000_000).alias("s"), F.floor(F.max("us") / 1_000_000).alias("e"))
    return connector.chunk_plan(w, "s", "e", 300_000).select("user_id", "from_ts", "to_ts")


@query("""SELECT event_id, 'gefs.' || strftime(ts, '%Y%m%d') || '/' || strftime(ts, '%H') || '/atmos/pgrb2sp25/gep01.t' || strftime(ts, '%H') || 'z.pgrb2s.0p25.f' || lpad((event_id % 200)::VARCHAR, 3, '0') AS key FROM events""")
def source_object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", object_key("gefs", F.col("ts"), F.col("event_id") % 200, F.lit("gep01")).alias("key"))


@query("""SELECT strftime(ts::DATE, '%Y-%m-%d') AS day, count(*) AS files, sum(floor(value)::BIGINT)::BIGINT AS bytes, CASE WHEN count(*) >= 333 THEN 'COMPLETE' ELSE 'PARTIAL' END AS completeness FROM events GROUP BY ALL""")
def sink_day_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = events(spark, sf_dir).select(F.to_date("ts").cast("string").alias("day"), F.floor("value").alias("bytes"))
    return sinks.day_manifest(f, "day", 333)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderstatus = 'F'")
def sink_resumed_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run still has to do: orders without a finished row."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = f"{shared_dir(spark)}/done"
    sinks.append(o.filter("o_orderkey % 3 = 0").withColumn("status", F.when(F.col("o_orderstatus") == "F", "failed").otherwise("ok")), path)
    done = sinks.done_table(spark.read.parquet(path), ["o_orderkey"])
    return o.join(done, "o_orderkey", "left_anti").select("o_orderkey")
