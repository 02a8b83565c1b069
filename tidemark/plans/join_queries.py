"""Joins, set operations and groupings on the business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans.registry import query
from tidemark.sources.tables import events, table

DAY = 86_400_000_000


@query("""SELECT c.c_custkey, n.n_name, r.r_name, count(o.o_orderkey) AS n_orders, round(coalesce(sum(o.o_totalprice), 0), 2) AS total FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY ALL""")
def broadcast_dim_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are summed before they meet customers, so the wide sides never multiply; dimensions are broadcast if small."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = joins.small(n.join(joins.small(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    out = c.join(dim, c.c_nationkey == F.col("n_nationkey"), "left").join(o, c.c_custkey == o.o_custkey, "left")
    return out.select("c_custkey", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("total", F.lit(0.0)).alias("total"))


@query("SELECT s.s_suppkey, s.s_name, n.n_name FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey")
def left_lookup_validated_m2o(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return joins.lookup(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), n, ["s_nationkey"], ["n_name"]).drop("s_nationkey")


@query("""WITH a AS (SELECT year(o_orderdate) AS yr, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY ALL), b AS (SELECT year(l_shipdate) AS yr, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)
SELECT yr::INT AS yr, orders, revenue, lines, quantity FROM a FULL JOIN b USING (yr)""")
def full_outer_year_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("yr")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("yr")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    return a.join(b, "yr", "full_outer").select("yr", "orders", "revenue", "lines", "quantity")


@query("""WITH d AS (SELECT l_suppkey % 50 AS grp, l_returnflag AS k, avg(l_extendedprice) AS v FROM lineitem GROUP BY ALL)
SELECT a.grp, a.k AS first, b.k AS second, round(a.v - b.v, 4) AS difference FROM d a JOIN d b ON a.grp = b.grp AND a.k < b.k""")
def self_theta_pairwise_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("grp"), "l_returnflag").agg(F.avg("l_extendedprice").alias("v"))
    return joins.pairwise(d, ["grp"], "l_returnflag", "v", ["A", "N", "R"]).select("grp", "first", "second", F.round("difference", 4).alias("difference"))


@query("""SELECT o.o_orderkey, count(*) AS n, round(sum(l.l_extendedprice), 2) AS total FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate >= o.o_orderdate AND l.l_shipdate < o.o_orderdate + INTERVAL 90 DAY GROUP BY ALL""")
def target_day_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped within 90 days of their order: equality on the key, the interval as a filter."""
    o, l = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")  # noqa: E741
    near = (F.col("l_shipdate") >= F.col("o_orderdate")) & (F.col("l_shipdate") < F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS"))
    return o.join(l, (o.o_orderkey == l.l_orderkey) & near).groupBy("o_orderkey").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("""WITH p AS (SELECT event_id AS pid, epoch_us(ts) AS s, epoch_us(ts) + 21600000000 AS e FROM events WHERE event_type = 'signup'), q AS (SELECT event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'click')
SELECT pid AS signup_id, count(*) AS n_clicks FROM p JOIN q ON us >= s AND us < e GROUP BY ALL""")
def interval_join_six_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of anyone within six hours of a signup: counted along time, without pairs."""
    e = events(spark, sf_dir)
    spans = e.filter("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), F.col("us").alias("s"), (F.col("us") + DAY // 4).alias("e"))
    clicks = e.filter("event_type = 'click'").select("us")
    return joins.interval_counts(clicks, spans, "us", "s", "e", "signup_id").withColumnRenamed("n", "n_clicks")


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY ALL")
def semi_expected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")  # noqa: E741
    return l.join(urgent, l.l_orderkey == urgent.o_orderkey, "left_semi").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders), l AS (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem)
SELECT strftime(d, '%Y-%m-%d') AS day, 'missing' AS side FROM (SELECT d FROM o EXCEPT SELECT d FROM l) UNION ALL SELECT strftime(d, '%Y-%m-%d'), 'unexpected' FROM (SELECT d FROM l EXCEPT SELECT d FROM o)""")
def set_difference_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, l = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")), table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))  # noqa: E741
    return joins.differences(o, l, ["d"]).select(F.col("d").cast("string").alias("day"), "side")


@query("SELECT day FROM (SELECT strftime(o_orderdate, '%m-%d') AS day FROM orders WHERE o_orderpriority = '1-URGENT' INTERSECT SELECT strftime(ts, '%m-%d') FROM events)")
def intersect_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return o.select(F.date_format("o_orderdate", "MM-dd").alias("day")).intersect(events(spark, sf_dir).select(F.date_format("ts", "MM-dd")))


@query("""WITH a AS (SELECT ts::DATE AS d FROM events), u AS (SELECT DISTINCT d + k::INT AS d FROM a, range(2) AS x(k)) SELECT strftime(d, '%Y-%m-%d') AS day FROM u""")
def union_days_with_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = events(spark, sf_dir).select(F.to_date("ts").alias("d"))
    return d.union(d.select(F.date_add("d", 1))).distinct().select(F.col("d").cast("string").alias("day"))


@query("""WITH d AS (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM events)::TIMESTAMP, (SELECT max(ts)::DATE FROM events)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day), k AS (SELECT DISTINCT event_type FROM events), c AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events WHERE value > 150 GROUP BY ALL)
SELECT k.event_type, strftime(d.day, '%Y-%m-%d') AS day, coalesce(n, 0) AS n FROM k CROSS JOIN d LEFT JOIN c USING (event_type, day)""")
def calendar_left_join_zero_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("event_type", "value", F.to_date("ts").alias("day"))
    cal = e.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    daily = e.filter("value > 150").groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return joins.with_zero_days(daily, cal, e.select("event_type").distinct(), "day", ["n"]).withColumn("day", F.col("day").cast("string"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube_status_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_region_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = joins.small(n.join(joins.small(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    return c.join(dim, c.c_nationkey == F.col("n_nationkey")).rollup("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())""")
def grouping_sets_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.groupingSets([["l_returnflag"], ["l_linestatus"], []], "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")).select("l_returnflag", "l_linestatus", "n", "quantity")


@query()
def approx_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches instead of exact counts: bounded state per group, whatever the number of users."""
    e = events(spark, sf_dir)
    return e.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("users"), F.percentile_approx("value", 0.5, 1000).alias("median_value"))


@query("""WITH q AS (SELECT vec_id, 35.0 + 20 * embedding[1]::DOUBLE AS lat, -75.0 + 20 * embedding[2]::DOUBLE AS lon FROM embeddings), g AS (SELECT vec_id AS gid, 35.0 + 20 * embedding[3]::DOUBLE AS glat, -75.0 + 20 * embedding[4]::DOUBLE AS glon FROM embeddings),
x AS (SELECT vec_id, gid, 2 * 6371.0 * asin(sqrt(pow(sin(radians(glat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(glat)) * pow(sin(radians(glon - lon) / 2), 2))) AS km FROM q, g)
SELECT vec_id, arg_min(gid, km) AS gid, round(min(km), 4) AS distance_km FROM x WHERE km <= 150 GROUP BY vec_id""")
def haversine_nearest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest grid point within 150 km of every point, by cells; its SQL compares all with all."""
    v = table(spark, sf_dir, "embeddings")
    at = lambda i, base: base + 20 * F.col("embedding")[i].cast("double")
    points, grid = v.select("vec_id", at(0, 35.0).alias("lat"), at(1, -75.0).alias("lon")), v.select(F.col("vec_id").alias("gid"), at(2, 35.0).alias("glat"), at(3, -75.0).alias("glon"))
    out = joins.nearest_points(points, grid, "vec_id", "lat", "lon", "glat", "glon", 1.0, 150.0)
    return out.select("vec_id", "gid", F.round("distance_km", 4).alias("distance_km"))


@query("""WITH q AS (SELECT vec_id, 35.0 + 20 * embedding[1]::DOUBLE AS lat, -75.0 + 20 * embedding[2]::DOUBLE AS lon FROM embeddings), g AS (SELECT vec_id AS gid, 35.0 + 20 * embedding[3]::DOUBLE AS glat, -75.0 + 20 * embedding[4]::DOUBLE AS glon FROM embeddings),
x AS (SELECT vec_id, gid, 2 * 6371.0 * asin(sqrt(pow(sin(radians(glat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(glat)) * pow(sin(radians(glon - lon) / 2), 2))) AS km FROM q, g WHERE abs(glat - lat) <= 1.5)
SELECT vec_id, arg_min(gid, km) AS gid, round(min(km), 4) AS distance_km FROM x WHERE km <= 150 GROUP BY vec_id""")
def haversine_nearest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest grid point within 150 km of every point, by cells."""
    v = table(spark, sf_dir, "embeddings")
    at = lambda i, base: base + 20 * F.col("embedding")[i].cast("double")
    points, grid = v.select("vec_id", at(0, 35.0).alias("lat"), at(1, -75.0).alias("lon")), v.select(F.col("vec_id").alias("gid"), at(2, 35.0).alias("glat"), at(3, -75.0).alias("glon"))
    return joins.nearest_points(points, grid, "vec_id", "lat", "lon", "glat", "glon", 1.0, 150.0).select("vec_id", "gid", F.round("distance_km", 4).alias("distance_km"))


@query("""SELECT o_custkey % 20 AS grp, count(*) AS n, min(abs(epoch_us(o_orderdate) - 820454400000000)) AS nearest_us FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL""")
def nearest_event_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each group's order nearest to the start of 1996 is."""
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    gap = F.abs(F.unix_micros(F.col("o_orderdate").cast("timestamp")) - 820454400000000)
    return o.groupBy((F.col("o_custkey") % 20).alias("grp")).agg(F.count("*").alias("n"), F.min_by(gap, F.struct(gap, "o_orderkey")).alias("nearest_us"))


@query("""WITH r AS (SELECT event_id, user_id, epoch_us(ts) AS avail, epoch_us(date_trunc('day', ts)) + 43200000000 AS due FROM events) SELECT user_id % 4 AS source, count(*) AS n_late, max(avail - due) AS worst_us FROM r WHERE avail > due GROUP BY ALL""")
def late_available_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrived after noon of their run's day."""
    due = F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp"))) + DAY // 2
    late = events(spark, sf_dir).withColumn("late", F.col("us") - due).filter("late > 0")
    return late.groupBy((F.col("user_id") % 4).alias("source")).agg(F.count("*").alias("n_late"), F.max("late").alias("worst_us"))


@query("""WITH r AS (SELECT 'm' || (user_id % 4) AS source, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS lag_us FROM events)
SELECT source, count(*) AS n, round(min(lag_us) / 6e7, 6) AS min_minutes, round(quantile_cont(lag_us, 0.5) / 6e7, 6) AS median_minutes, round(max(lag_us) / 6e7, 6) AS max_minutes FROM r GROUP BY source""")
def publication_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag = (F.col("us") - F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp")))).cast("double")
    e = events(spark, sf_dir).select(F.concat(F.lit("m"), F.col("user_id") % 4).alias("source"), lag.alias("x"))
    return e.groupBy("source").agg(F.count("*").alias("n"), F.round(F.min("x") / 6e7, 6).alias("min_minutes"), F.round(F.expr("percentile(x, 0.5)") / 6e7, 6).alias("median_minutes"), F.round(F.max("x") / 6e7, 6).alias("max_minutes"))


@query("""WITH a AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'S3' ELSE 'OTHER' END AS kind, ts, event_id FROM events) SELECT kind, count(*) AS n, max(event_id) AS last_id FROM a GROUP BY kind""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("click", "view"), "S3").otherwise("OTHER")
    return events(spark, sf_dir).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


