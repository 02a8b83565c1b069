"""As-of queries on the event stream: purchases look back at clicks of the same user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import HOUR, asof_join, fresh, last_two
from tidemark.plans.registry import query
from tidemark.sources.tables import events

SIDES = """WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events),
l AS (SELECT event_id, user_id, us, value FROM e WHERE event_type = 'purchase'),
r AS (SELECT event_id AS click_id, user_id, us AS click_us, value AS click_value FROM e WHERE event_type = 'click')
"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "us")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "us", "value")
    right = e.filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("us").alias("click_us"), F.col("value").alias("click_value"))
    return left, right


@query(SIDES + """SELECT l.event_id, l.user_id, r.click_id, (l.us - r.click_us) / 3600000000.0 AS age_hours
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.us >= r.click_us""")
def asof_latest_click_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _sides(spark, sf_dir)
    out = asof_join(left, right, ["user_id"], "us", "click_us", tie=["click_id"])
    return out.select("event_id", "user_id", "match.click_id", ((F.col("us") - F.col("match.click_us")) / HOUR).alias("age_hours"))


@query(SIDES + """, p AS (SELECT *, lag(click_id) OVER w AS before_id FROM r WINDOW w AS (PARTITION BY user_id ORDER BY click_us, click_id))
SELECT l.event_id, p.click_id AS latest_id, p.before_id AS previous_id FROM l ASOF LEFT JOIN p ON l.user_id = p.user_id AND l.us >= p.click_us""")
def asof_two_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _sides(spark, sf_dir)
    out = last_two(left, right, ["user_id"], "us", "click_us", ["click_id"])
    return out.select("event_id", F.col("latest.click_id").alias("latest_id"), F.col("previous.click_id").alias("previous_id"))


@query(SIDES + """, a AS (SELECT l.event_id, l.user_id, r.click_us, r.click_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.us >= r.click_us),
b AS (SELECT *, click_us - 3600000000 AS back_us FROM a)
SELECT b.event_id, round(b.click_value - r.click_value, 6) AS change_1h FROM b ASOF LEFT JOIN r ON b.user_id = r.user_id AND b.back_us >= r.click_us""")
def asof_one_hour_ago(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change between the latest click and the last one at least an hour older than it."""
    left, right = _sides(spark, sf_dir)
    first = asof_join(left, right, ["user_id"], "us", "click_us", tie=["click_id"]).select("event_id", "user_id", F.col("match.click_value").alias("now"), (F.col("match.click_us") - HOUR).alias("back_us"))
    out = asof_join(first, right, ["user_id"], "back_us", "click_us", tie=["click_id"])
    return out.select("event_id", F.round(F.col("now") - F.col("match.click_value"), 6).alias("change_1h"))


@query(SIDES + """, a AS (SELECT l.event_id, r.click_id, r.click_value, l.us - r.click_us AS age FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.us >= r.click_us)
SELECT event_id, CASE WHEN age <= 21600000000 THEN click_value END AS current_value, coalesce(age <= 21600000000, false) AS available, age > 21600000000 AS stale, age / 60000000.0 AS age_minutes FROM a""")
def asof_with_freshness_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading older than six hours is no current value, but its age stays."""
    left, right = _sides(spark, sf_dir)
    age = F.col("us") - F.col("match.click_us")
    out = asof_join(left, right, ["user_id"], "us", "click_us", tie=["click_id"])
    return out.select("event_id", fresh(F.col("match.click_value"), age).alias("current_value"), F.coalesce(age <= 6 * HOUR, F.lit(False)).alias("available"), (age > 6 * HOUR).alias("stale"), (age / 6e7).alias("age_minutes"))


@query(SIDES + """, b AS (SELECT l.*, r.click_id AS b_id, r.click_us AS b_us FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.us >= r.click_us),
f AS (SELECT b.*, r.click_id AS f_id, r.click_us AS f_us FROM b ASOF LEFT JOIN r ON b.user_id = r.user_id AND b.us < r.click_us),
n AS (SELECT event_id, CASE WHEN f_id IS NOT NULL AND (b_id IS NULL OR f_us - us < us - b_us) THEN f_id ELSE b_id END AS click_id,
 CASE WHEN f_id IS NOT NULL AND (b_id IS NULL OR f_us - us < us - b_us) THEN f_us - us ELSE us - b_us END AS gap FROM f)
SELECT event_id, CASE WHEN gap <= 86400000000 THEN click_id END AS click_id FROM n""")
def asof_nearest_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click nearest in time, within a day."""
    left, right = _sides(spark, sf_dir)
    out = asof_join(left, right, ["user_id"], "us", "click_us", "nearest", tie=["click_id"], tolerance_us=24 * HOUR)
    return out.select("event_id", "match.click_id")


@query("""WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us FROM events), l AS (SELECT event_id, us FROM e WHERE event_type = 'signup'),
v AS (SELECT us AS v_us, event_id AS v FROM e WHERE event_type = 'view'), c AS (SELECT us AS c_us, event_id AS c FROM e WHERE event_type = 'click'), x AS (SELECT us AS x_us, event_id AS x FROM e WHERE event_type = 'error'),
a AS (SELECT l.*, v FROM l ASOF LEFT JOIN v ON l.us >= v.v_us), b AS (SELECT a.*, c FROM a ASOF LEFT JOIN c ON a.us >= c.c_us)
SELECT b.event_id, v AS latest_view, c AS latest_click, x AS latest_error FROM b ASOF LEFT JOIN x ON b.us >= x.x_us""")
def asof_across_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the latest event of each other kind was, whoever made it: one pass for all kinds, in day buckets."""
    e = events(spark, sf_dir).select("event_id", "event_type", "us")
    out = e.filter("event_type = 'signup'").select("event_id", "us").withColumn("all", F.lit(1))
    for kind, name in (("view", "latest_view"), ("click", "latest_click"), ("error", "latest_error")):
        right = e.filter(F.col("event_type") == kind).select(F.lit(1).alias("all"), F.col("us").alias("at"), F.col("event_id").alias(name))
        out = asof_join(out, right, ["all"], "us", "at", tie=[name], bucket_us=24 * HOUR, to="m").withColumn(name, F.col(f"m.{name}")).drop("m")
    return out.select("event_id", "latest_view", "latest_click", "latest_error")
