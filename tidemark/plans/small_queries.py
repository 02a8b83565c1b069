"""Conversions, alignment, versions and reports, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import grib, observations, text, times
from tidemark.operators import audit, joins, market
from tidemark.plans.registry import query
from tidemark.sources import sinks, tables
from tidemark.sources.sinks import shared_dir
from tidemark.sources.tables import events, table


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN round((value + 250 - 273.15) * 9 / 5 + 32, 6) END AS fahrenheit, CASE WHEN user_id * 7 % 360 > 180 THEN user_id * 7 % 360 - 360 ELSE user_id * 7 % 360 END AS lon, regexp_replace(event_type || ':' || user_id || ' §', '[^A-Za-z0-9._-]', '_', 'g') AS name,
CASE WHEN month(ts + to_days((event_id % 240)::INT)) <= 2 THEN 'winter_jan_feb' WHEN month(ts + to_days((event_id % 240)::INT)) <= 5 THEN 'spring' WHEN month(ts + to_days((event_id % 240)::INT)) = 6 THEN 'early_summer' WHEN month(ts + to_days((event_id % 240)::INT)) = 7 THEN 'midsummer' ELSE 'august' END AS season,
CASE user_id % 3 WHEN 0 THEN 'control' WHEN 1 THEN 'perturbed' END AS member, round((epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts)) / 3600000000.0, 6) AS age_hours FROM events""")
def small_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kelvin, longitudes, safe names, seasons, kinds of members and ages of every event."""
    ts = F.col("ts").cast("timestamp")
    units = F.when(F.col("event_id") % 3 == 0, "K").otherwise("%")
    member = F.concat(F.element_at(F.array(*map(F.lit, ("gec", "gep", "avg"))), (F.col("user_id") % 3 + 1).cast("int")), F.lit("00"))
    return events(spark, sf_dir).select("event_id", F.round(observations.kelvin_to_f(F.col("value") + 250, units), 6).alias("fahrenheit"), joins.lon_180(F.col("user_id") * 7 % 360).alias("lon"), text.safe_name(F.concat_ws("", "event_type", F.lit(":"), "user_id", F.lit(" §"))).alias("name"), observations.season_bucket(F.month(F.date_add(F.to_date(ts), (F.col("event_id") % 240).cast("int")))).alias("season"), grib.member_type(member).alias("member"), F.round(times.age_hours(F.lit("2024-03-01").cast("timestamp"), ts), 6).alias("age_hours"))


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part")
def source_aligned_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables of unlike columns as one: the first decides, absent columns are null, others go."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit(1).alias("more"))
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("key"))
    return tables.union_aligned(c, s, tables.aligned(p, "key bigint, name string, balance double"))


@query("SELECT 'u' || user_id AS market_ticker, epoch_us(ts) // 86400000000 AS timestamp, arg_max(value, event_id) AS value, max(event_id) AS fetched FROM events GROUP BY ALL")
def market_last_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all candles of a market and period the one fetched last."""
    c = events(spark, sf_dir).select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("market_ticker"), F.floor(F.col("us") / 86_400_000_000).alias("timestamp"), "value", F.col("event_id").alias("fetched"))
    return market.last_version(c, "fetched")


@query("""WITH m AS (SELECT o_custkey, count(*) AS n, bool_and(o_orderpriority <> '1-URGENT') AS named FROM orders GROUP BY ALL)
SELECT c_custkey, CASE WHEN n IS NULL THEN 'unknown' WHEN n = 1 THEN 'single_threshold' WHEN named THEN 'bucketed' ELSE 'unknown' END AS structure FROM customer LEFT JOIN m ON o_custkey = c_custkey""")
def market_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events by their markets: a customer is an event, an order a market, which has a strike type unless it is urgent."""
    m = F.when(F.col("o_orderpriority") != "1-URGENT", F.to_json(F.struct(F.col("o_orderkey").alias("ticker"), F.lit("between").alias("strike_type")))).otherwise(F.to_json(F.struct(F.col("o_orderkey").alias("ticker"))))
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(m).alias("markets"))  # a customer's orders are few
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", market.structure(F.col("markets")).alias("structure"))


@query("""SELECT 'csv' AS kind, l_returnflag AS flag, l_linestatus AS status, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ALL UNION ALL SELECT 'json', l_returnflag, l_linestatus, count(*), round(sum(l_quantity), 2) FROM lineitem GROUP BY ALL
UNION ALL SELECT 'lines', l_returnflag, l_linestatus, 2 * count(*), round(2 * sum(l_quantity), 2) FROM lineitem GROUP BY ALL UNION ALL SELECT 'layer', l_returnflag, l_linestatus, count(*), round(sum(l_quantity), 2) FROM lineitem GROUP BY ALL""")
def sink_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary written as a CSV report, a JSON report, lines that are appended twice, and a layer; read back."""
    path = shared_dir(spark)
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    sinks.report_csv(s, f"{path}/csv")
    sinks.report_json(s, f"{path}/json")
    for _ in range(2):
        sinks.json_lines(s, f"{path}/lines")
    sinks.layers({"layer": s}, path)
    kind = "flag string, status string, n bigint, quantity double"
    read = [spark.read.csv(f"{path}/csv", schema=kind, header=True), spark.read.schema(kind).json(f"{path}/json"), spark.read.schema(kind).json(f"{path}/lines"), spark.read.parquet(f"{path}/layer")]
    out = None
    for name, d in zip(("csv", "json", "lines", "layer"), read, strict=True):
        d = d.groupBy(F.lit(name).alias("kind"), "flag", "status").agg(F.sum("n").alias("n"), F.round(F.sum("quantity"), 2).alias("quantity"))
        out = d if out is None else out.unionByName(d)
    return out


@query("WITH p AS (SELECT event_type AS source, user_id AS point, min(value) AS lat, max(value) AS lon FROM events GROUP BY ALL) SELECT source, point FROM p WHERE point % 11 = 0 OR point % 13 = 5")
def dq_moved_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid points that a later run has elsewhere or not at all: one in eleven is gone, one in thirteen moved."""
    p = events(spark, sf_dir).groupBy(F.col("event_type").alias("source"), F.col("user_id").alias("point")).agg(F.min("value").alias("lat"), F.max("value").alias("lon"))
    later = p.filter("point % 11 <> 0").withColumn("lat", F.col("lat") + F.when(F.col("point") % 13 == 5, 0.5).otherwise(0.001))
    return audit.moved_points(p, later, ["source", "point"], "lat", "lon", 0.01).select("source", "point")


@query("WITH e AS (SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT event_id FROM e WHERE value < before")
def dq_unsorted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is below that of the one before."""
    return audit.unsorted_within(events(spark, sf_dir), ["user_id"], ["us", "event_id"], "value").select("event_id")
