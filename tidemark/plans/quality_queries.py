"""Data-quality queries. Most look for violations that the data has; those that should be empty say so."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import state_grid
from tidemark.operators import audit, market
from tidemark.plans import market_queries
from tidemark.plans.registry import query
from tidemark.sources.tables import events, inspect, table


@query("WITH p AS (SELECT o_orderpriority AS k, count(*) AS n, count(*) FILTER (o_totalprice > 300000) AS a, count(*) FILTER (year(o_orderdate) > 1996) AS b FROM orders GROUP BY ALL) SELECT k, 'high_price' AS \"column\", round(100.0 * a / n, 6) AS missing_pct FROM p UNION ALL SELECT k, 'late', round(100.0 * b / n, 6) FROM p")
def dq_missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("k"), F.when(F.col("o_totalprice") <= 300000, 1).alias("high_price"), F.when(F.year("o_orderdate") <= 1996, 1).alias("late"))
    return audit.missingness(o, ["k"], ["high_price", "late"]).withColumn("missing_pct", F.round("missing_pct", 6))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("WITH m AS (SELECT DISTINCT o_custkey AS ev, o_orderkey AS t, o_orderstatus = 'F' AS y FROM orders) SELECT ev, count(*) FILTER (y) AS n_yes, count(*) AS n_markets FROM m GROUP BY ev HAVING count(*) FILTER (y) <> 1")
def dq_exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ev"), F.col("o_orderkey").alias("market_ticker"), F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("result"))
    return market.not_exactly_one_yes(m, "ev")


@query("""WITH m AS (SELECT p_size AS ev, p_partkey AS id, CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_partkey % 40 END AS f, p_partkey % 40 + 1 + (p_partkey % 3 = 0)::INT AS c, CASE WHEN p_partkey % 2 = 0 THEN 'between' ELSE 'less' END AS t FROM part),
u AS (SELECT ev, f, min(c) AS c, min(t) AS t FROM m GROUP BY ALL),
w AS (SELECT *, lag(c) OVER (PARTITION BY ev ORDER BY f NULLS FIRST) AS b, lag(t) OVER (PARTITION BY ev ORDER BY f NULLS FIRST) AS bt FROM u), x AS (SELECT *, b + (t = 'between' AND bt = 'between')::INT AS want FROM w)
SELECT ev, f AS floor_strike, CASE WHEN f > want THEN 'gap' ELSE 'overlap' END AS fault FROM x WHERE f <> want""")
def dq_bucket_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 40
    m = table(spark, sf_dir, "part").select(F.col("p_size").alias("ev"), F.when(k != 0, k).alias("floor_strike"), (k + 1 + (F.col("p_partkey") % 3 == 0).cast("int")).alias("cap_strike"), F.when(F.col("p_partkey") % 2 == 0, "between").otherwise("less").alias("strike_type"))
    u = m.groupBy("ev", "floor_strike").agg(F.min("cap_strike").alias("cap_strike"), F.min("strike_type").alias("strike_type"))
    return market.tiling_faults(u, "ev").select("ev", "floor_strike", "fault")


@query("WITH d AS (SELECT ts::DATE AS d, bool_or(value > 380) AS has FROM events GROUP BY ALL), f AS (SELECT min(d) AS first FROM d WHERE NOT has) SELECT strftime(d.d, '%Y-%m-%d') AS day FROM d, f WHERE has AND d.d > f.first")
def dq_prefix_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = events(spark, sf_dir).groupBy(F.to_date("ts").alias("d")).agg(F.max((F.col("value") > 380).cast("int")).alias("has"))
    return audit.not_a_prefix(d, "d", F.col("has") == 1).select(F.col("d").cast("string").alias("day"))


@query("SELECT \"column\" FROM (VALUES ('o_final_high'), ('settlement_value')) AS t(\"column\")")
def dq_leakage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumnsRenamed({"o_totalprice": "o_final_high", "o_orderpriority": "settlement_value"})
    return audit.leakage_columns(spark, o)


@query("SELECT strftime(day, '%Y-%m-%d') AS day FROM (SELECT ts::DATE AS day FROM events) GROUP BY day HAVING false")
def dq_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected empty: every day has six states under each policy."""
    s = state_grid(events(spark, sf_dir).select(F.to_date("ts").alias("day")).distinct())
    return audit.wrong_counts(s, "day", "mode", 6).select(F.col("day").cast("string").alias("day"))


@query("SELECT o_orderkey, count(*) AS n_late FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate + INTERVAL 1000 DAY GROUP BY ALL")
def dq_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that were shipped after an order's state was read, a thousand days on."""
    o, l = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 1000 DAYS")).alias("t")), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")  # noqa: E741
    late = audit.lookahead(o.join(l, o.o_orderkey == l.l_orderkey), "t", ["l_shipdate"])
    return late.groupBy("o_orderkey").agg(F.count("*").alias("n_late"))


@query("SELECT user_id % 10 AS grp, strftime(ts::DATE, '%Y-%m-%d') AS day, count(DISTINCT event_type) AS n_values FROM events GROUP BY ALL HAVING count(DISTINCT event_type) > 1")
def dq_label_varies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select((F.col("user_id") % 10).alias("grp"), F.to_date("ts").cast("string").alias("day"), "event_type")
    return audit.varying(e, ["grp", "day"], "event_type")


@query("SELECT event_type, round(avg((value < 100)::INT), 6) AS rate FROM events GROUP BY event_type HAVING avg((value < 100)::INT) <= 0.9")
def dq_low_usable_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("usable", F.col("value") < 100)
    return audit.low_rates(e, ["event_type"], "usable", 0.9).withColumn("rate", F.round("rate", 6))


@query("""WITH m AS (SELECT user_id, strftime(ts::DATE, '%Y-%m-%d') AS day, max(value) FILTER (event_id % 2 = 0) AS s, max(value) FILTER (event_id % 2 = 1) AS p FROM events GROUP BY ALL) SELECT user_id, day FROM m WHERE s IS DISTINCT FROM p""")
def dq_policies_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("user_id", F.to_date("ts").cast("string").alias("day"), F.when(F.col("event_id") % 2 == 0, "strict").otherwise("proxy").alias("mode"), "value")
    return audit.policies_differ(e, ["user_id", "day"], "mode", "value").select("user_id", "day")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def dq_usable_without_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("usable"))
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return audit.without_detail(o, "usable", d, ["o_orderkey"]).select("o_orderkey")


@query("WITH n AS (SELECT l_orderkey AS o_orderkey, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY ALL) SELECT o.o_orderkey, n FROM orders o LEFT JOIN n USING (o_orderkey) WHERE coalesce(n, 0) <> 4")
def dq_member_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return audit.wrong_member_counts(table(spark, sf_dir, "orders").select("o_orderkey"), d, ["o_orderkey"], "l_linenumber", 4)


@query("""SELECT event_type, CASE WHEN value > 200 THEN 'PRESENT' WHEN event_type = 'error' THEN 'STRUCTURALLY_NOT_APPLICABLE' WHEN hour(ts) < 12 THEN 'NOT_YET_AVAILABLE' ELSE 'MISSING_UNEXPECTEDLY' END AS kind, count(*) AS n FROM events GROUP BY ALL""")
def dq_missing_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = audit.missing_kind(F.col("value") > 200, F.col("event_type") != "error", F.hour("ts") >= 12)
    return events(spark, sf_dir).groupBy("event_type", kind.alias("kind")).agg(F.count("*").alias("n"))


@query(market_queries.CANDLES + "SELECT count(*) AS n, bool_and(abs(missing - (el / 3600.0 - 1)) < 1e-9) AS identity_holds FROM g0")
def dq_gap_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing periods are elapsed periods less one, for every gap."""
    g = market.gaps(market.pairs(market_queries.candles(spark, sf_dir), None, 3600.0), 3600.0, True)
    return g.agg(F.count("*").alias("n"), F.bool_and(F.abs(F.col("missing") - (F.col("elapsed_seconds") / 3600 - 1)) < 1e-9).alias("identity_holds"))


@query("""WITH a AS (SELECT l_suppkey AS k, count(*) AS n_before FROM lineitem GROUP BY ALL), b AS (SELECT l_suppkey AS k, count(*) AS n_after FROM lineitem WHERE l_quantity > 1 GROUP BY ALL) SELECT k, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after FROM a FULL JOIN b USING (k) WHERE coalesce(n_before, 0) <> coalesce(n_after, 0)""")
def dq_changed_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), "l_quantity")  # noqa: E741
    return audit.changed_row_counts(l, l.filter("l_quantity > 1"), ["k"])


@query("""SELECT t."column", t.kind, t.p AS non_null_percent, (SELECT count(*) FROM events) AS n_rows FROM (VALUES ('event_id', 'bigint', 100.0::DOUBLE), ('ts', 'timestamp_ntz', 100.0), ('user_id', 'bigint', 100.0), ('event_type', 'string', 100.0), ('value', 'double', 100.0), ('props', 'string', 100.0)) AS t("column", kind, p)""")
def dq_inspect_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect(table(spark, sf_dir, "events"))


@query("SELECT 'big' AS \"column\", count(*) FILTER (value > 300) AS n_known, count(*) FILTER (value > 300) > 0 AS available FROM events UNION ALL SELECT 'never', 0, false UNION ALL SELECT 'value', count(value), true FROM events")
def dq_field_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("value", F.when(F.col("value") > 300, 1).alias("big"), F.lit(None).cast("int").alias("never"))
    return audit.availability(e, ["value", "big", "never"])


@query("SELECT user_id, arg_min(value, ts) FILTER (value > 200) AS first_big, arg_min(event_type, ts) AS first_kind FROM events GROUP BY user_id")
def dq_first_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("user_id", "us", F.when(F.col("value") > 200, F.col("value")).alias("first_big"), F.col("event_type").alias("first_kind"))
    return audit.first_known(e, ["user_id"], "us", ["first_big", "first_kind"])


@query("SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS status, epoch(min(o_orderdate))::BIGINT AS opens, epoch(max(o_orderdate))::BIGINT AS closes, bool_and(o_orderstatus = 'F') AS all_settled, CASE WHEN o_custkey % 3 = 1 THEN 'other ticker' WHEN o_custkey % 3 = 2 THEN 'other title' END AS refusal FROM orders GROUP BY o_custkey")
def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with nested markets: status, first opening, last close, whether all is settled, and if it is one of the series."""
    from tidemark.functions import events as ev

    t = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    m = F.struct("o_orderkey", F.when(F.col("o_orderstatus") == "F", "settled").otherwise(F.col("o_orderstatus")).alias("status"), t.alias("open_time"), t.alias("close_time"))
    d = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(m)).alias("m"))
    k = F.col("o_custkey") % 3
    ticker, title = F.when(k == 1, "X-1").otherwise("KXHIGHNY-25JUL01"), F.when(k == 2, "Rain in Boston").otherwise("Highest temperature in New York")
    status = F.when(ev.status(F.col("m")) == "settled", "F").otherwise(ev.status(F.col("m")))
    return d.select("o_custkey", status.alias("status"), ev.earliest_open(F.col("m")).alias("opens"), ev.latest_close(F.col("m")).alias("closes"), ev.all_settled(F.col("m")).alias("all_settled"), ev.refusal(F.lit("KXHIGHNY"), ticker, title, F.col("m")).alias("refusal"))


@query("SELECT event_id, 3 + (event_id % 2) AS n_numbers FROM events")
def json_numeric_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions import events as ev

    doc = F.to_json(F.struct("event_id", "value", F.array(F.col("user_id")).alias("users"), F.lit('a "1" 2').alias("text"), F.when(F.col("event_id") % 2 == 1, F.col("us")).alias("odd"), F.lit(True).alias("flag")))
    return events(spark, sf_dir).select("event_id", ev.numeric_fields(doc).cast("long").alias("n_numbers"))
