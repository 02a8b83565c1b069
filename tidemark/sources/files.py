"""Readers of the raw files: station years, quote trees, replay lines, bulletins, sidecar indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import empty

STATION_COLUMNS = ("STATION", "DATE", "SOURCE", "REPORT_TYPE", "QUALITY_CONTROL", "TMP", "DEW", "WND", "SLP", "MA1", "OC1", "AA1", "VIS", "GA1", "AW1", "MW1")
STATION = ", ".join(f"{c} string" for c in STATION_COLUMNS)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system that it belongs to."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def station_years(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw station reports. A year that isn't there is an absence, not an error; other failures stay failures.

    Files differ in their columns: each is read by its own header and brought to one schema, all as text.
    """
    found = [p for p in paths if exists(spark, p)]
    out = empty(spark, STATION)
    for p in found:  # a handful of years; the rows themselves are read by tasks
        raw = spark.read.csv(p, header=True, quote='"', escape='"', inferSchema=False)
        out = out.unionByName(raw.select(*[c for c in STATION_COLUMNS if c in raw.columns]), allowMissingColumns=True)
    return out


def parquet_parts(spark: SparkSession, path: str, schema: str, primary: str | None = None) -> DataFrame:
    """A folder of parts under one schema: absent columns are null, an absent folder is empty, and the predicate on the
    primary grid point is pushed into the scan."""
    if not exists(spark, path):
        return empty(spark, schema)
    df = spark.read.option("mergeSchema", "false").schema(empty(spark, schema).schema).parquet(path)
    return df.filter(F.col(primary)) if primary else df


def by_year(spark: SparkSession, path: str) -> DataFrame:
    """A table laid out as ``year=YYYY/``; the year is a whole number and prunes folders."""
    return spark.read.parquet(path).withColumn("year", F.col("year").cast("int"))


MARKET = "struct<ticker:string,status:string,result:string,open_time:string,close_time:string,settlement_ts:string,floor_strike:double,cap_strike:double,strike_type:string,settlement_value_dollars:string,expiration_value:string>"
EVENT = f"event_ticker string, title string, sub_title string, settlement_sources array<struct<name:string>>, markets array<{MARKET}>"


def event_tree(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per market from a tree of event files, with the file it came from. A file is one JSON document; ``lines``: one a line."""
    e = spark.read.schema(EVENT).json(path, multiLine=not lines).withColumn("file", F.col("_metadata.file_name"))
    m = e.select("file", "event_ticker", "title", F.get(F.transform("settlement_sources", lambda s: s["name"]), F.lit(0)).alias("settlement_source"), F.size("markets").alias("n_markets"), F.explode_outer("markets").alias("m"))
    number = lambda c: F.col(f"m.{c}").try_cast("double")
    return m.select("file", "event_ticker", "title", "settlement_source", "n_markets", F.col("m.ticker").alias("market_ticker"), *[F.col(f"m.{c}").alias(c) for c in ("status", "result", "open_time", "close_time", "floor_strike", "cap_strike", "strike_type")], number("settlement_value_dollars").alias("settlement_value"), number("expiration_value").alias("expiration_value"))


RECORD = "local_receive_timestamp double, local_receive_timestamp_iso string, raw_message string"
LEVELS = "array<array<string>>"
MESSAGE = f"type string, sid long, seq long, msg struct<market_ticker:string,side:string,price_dollars:string,delta_fp:string,yes_dollars_fp:{LEVELS},no_dollars_fp:{LEVELS},channel:string,code:int>"


def replay(lines: DataFrame, line: str = "value") -> DataFrame:
    """Recorded lines as book messages; a line that is no JSON has type null."""
    r = lines.select(F.from_json(line, RECORD).alias("r")).select("r.*")
    m = r.withColumn("m", F.from_json("raw_message", MESSAGE))
    side = lambda s: F.transform(F.coalesce(F.col(f"m.msg.{s}_dollars_fp"), F.array().cast(LEVELS)), lambda x: F.struct(F.lit(s).alias("side"), F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("size")))
    return m.select(F.timestamp_micros((F.col("local_receive_timestamp") * 1e6).cast("long")).alias("received"), F.col("m.type").alias("type"), F.col("m.sid").alias("sid"), F.col("m.seq").alias("seq"), F.col("m.msg.market_ticker").alias("market_ticker"), F.col("m.msg.side").alias("side"), F.col("m.msg.price_dollars").try_cast("double").alias("price"), F.col("m.msg.delta_fp").try_cast("double").alias("delta"), F.concat(side("yes"), side("no")).alias("levels"), F.col("m.msg.code").alias("code"))


def first_of_each(messages: DataFrame, kind: str, key: str = "market_ticker", time: str = "received") -> DataFrame:
    """The first message of a kind for each market: a minimum, not a sort."""
    rest = [c for c in messages.columns if c != key]
    return messages.filter(F.col("type") == kind).groupBy(key).agg(F.min_by(F.struct(*rest), time).alias("x")).select(key, "x.*")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(product_id, raw_text): one row per file, named by it."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw_text"))
    return t.select(F.regexp_replace("file", r"\.[A-Za-z]+$", "").alias("product_id"), "raw_text")


def json_index(spark: SparkSession, path: str) -> DataFrame:
    """A sidecar of JSON lines: which parameter of which member lies at which bytes."""
    i = spark.read.schema("param string, levtype string, number string, step string, _offset long, _length long").json(path)
    return i.select("param", "levtype", F.col("number").try_cast("int").alias("number"), F.col("step").try_cast("int").alias("step"), F.col("_offset").alias("byte_start"), (F.col("_offset") + F.col("_length") - 1).alias("byte_end"), F.col("_metadata.file_name").alias("file"))


def listing(xml: DataFrame, column: str) -> DataFrame:
    """(key, size) of each object in pages of a store's XML listing."""
    keys, sizes = F.regexp_extract_all(F.col(column), F.lit("<Key>([^<]+)</Key>"), F.lit(1)), F.regexp_extract_all(F.col(column), F.lit(r"<Size>(\d+)</Size>"), F.lit(1))
    return xml.select(F.explode(F.arrays_zip(keys.alias("key"), sizes.alias("size"))).alias("x")).select("x.key", F.col("x.size").cast("long").alias("size"))
