"""The canonical label of a day: the latest final report, or a reason why there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical(reports: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """One row per target_date: label, status, candidates, or ``selection_error``.

    Preliminary reports never count and nothing fills a missing label. In order: two latest finals that differ, a latest
    final that takes a known value back, and a final issued on or before its own day are errors, not guesses. A day has
    few reports, so its finals fit one row.
    """
    finals = F.sort_array(F.collect_list(F.when(~F.col("is_preliminary"), F.struct("issuance_time", "product_id", "max_temp_f", "max_temp_flag"))), asc=False)
    g = reports.filter("target_date is not null").groupBy("target_date").agg(finals.alias("f"), F.count(F.when(F.col("is_preliminary"), 1)).alias("n_preliminary_rejected"))
    if dates is not None:
        g = dates.select("target_date").distinct().join(g, "target_date", "left").withColumn("f", F.coalesce("f", F.array().cast(g.schema["f"].dataType)))
    n = F.size("f")
    values = lambda a: F.size(F.array_distinct(F.transform(a, lambda x: F.coalesce(x["max_temp_f"].cast("string"), F.lit("MM")))))
    tied = F.filter("f", lambda x: x["issuance_time"] == F.get(F.col("f"), F.lit(0))["issuance_time"])
    # of several rows of the last instant the first product counts; their values agree or it is an error
    latest = F.array_min(tied)
    error = F.when(values(tied) > 1, "irreducible tie").when(latest["max_temp_f"].isNull() & F.exists("f", lambda x: x["max_temp_f"].isNotNull()), "retracted value").when(F.to_date(latest["issuance_time"]) <= F.col("target_date"), "issued on or before its own day")
    ok = (n > 0) & error.isNull()
    status = F.when(n == 1, "FINAL").when(values(F.col("f")) == 1, "FINAL_REISSUED").otherwise("FINAL_CORRECTED")
    return g.select(
        "target_date", n.alias("n_final_candidates"), F.coalesce("n_preliminary_rejected", F.lit(0)).alias("n_preliminary_rejected"), F.when(ok, latest["max_temp_f"]).alias("label_f"),
        F.when(n == 0, "LABEL_UNAVAILABLE_CLINYC").when(ok, "OK").alias("label_status"), F.when(ok, latest["issuance_time"]).alias("issuance_time"), F.when(ok, latest["product_id"]).alias("product_id"),
        F.when(ok, status).alias("report_status"), F.when(ok, latest["max_temp_flag"]).alias("max_temp_flag"), F.when(n > 0, error).alias("selection_error"),
    )


def report(labels: DataFrame, least: float = -40.0, most: float = 120.0) -> DataFrame:
    """(metric, value) of ``canonical`` labels with their calendar: how many days have one, why others have none, and what is odd."""
    ok, missing = F.col("label_status") == "OK", F.col("label_status") == "LABEL_UNAVAILABLE_CLINYC"
    counts = {
        "n_days_expected": F.lit(True), "n_days_available": ok, "n_days_missing": missing, "multi_final_days": ok & (F.col("n_final_candidates") > 1), "days_with_preliminary_rejected": F.col("n_preliminary_rejected") > 0,
        "selection_errors": F.col("selection_error").isNotNull(), "impossible_values": ok & ~F.col("label_f").between(least, most), "provenance_gaps": ok & (F.col("product_id").isNull() | F.col("issuance_time").isNull()),
    }
    one = labels.agg(*[F.count(F.when(c, 1)).cast("double").alias(k) for k, c in counts.items()], (F.count("*") - F.countDistinct("target_date")).cast("double").alias("duplicate_target_dates"))
    one = one.withColumn("coverage_pct", F.round(100 * F.col("n_days_available") / F.nullif(F.col("n_days_expected"), F.lit(0.0)), 2))
    return one.unpivot([], [*counts, "duplicate_target_dates", "coverage_pct"], "metric", "value")


def attach(features: DataFrame, labels: DataFrame, columns: list[str], on: str = "target_date") -> DataFrame:
    """``features`` with the label columns, replacing those of an earlier run; two labels for one day stop the job."""
    from tidemark.operators.joins import lookup

    return lookup(features.drop(*columns), labels, [on], columns)
