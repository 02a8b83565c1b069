"""Readers of the tables, and typed empty relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event table with ``us``, its time in microseconds since the epoch (UTC)."""
    return table(spark, folder, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A relation without rows: what an absent file or an unpublished year reads as."""
    return spark.createDataFrame([], schema)


def aligned(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with the columns of ``schema`` only: missing ones are null, kinds are cast."""
    want = empty(df.sparkSession, schema).schema
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all; the first one's columns and order decide."""
    for o in others:
        first = first.unionByName(o.select(*[c for c in first.columns if c in o.columns]), allowMissingColumns=True)
    return first


def primary_points(df: DataFrame, flag: str) -> DataFrame:
    """Rows at the primary grid point; the predicate reaches the scan."""
    return df.filter(F.col(flag))


def inspect(df: DataFrame) -> DataFrame:
    """(column, kind, non_null_percent, n_rows) for each column, in one pass."""
    counts = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col(f"`{c}`").alias("n")) for c, k in df.dtypes])
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *counts)
    return one.select("__rows", F.explode(pairs).alias("x")).select("x.column", "x.kind", F.round(100 * F.col("x.n") / F.nullif(F.col("__rows"), F.lit(0)), 6).alias("non_null_percent"), F.col("__rows").alias("n_rows"))


def http_last_modified(text):
    """``Tue, 01 Jul 2025 04:05:06 GMT`` as a timestamp; anything else is null."""
    return F.try_to_timestamp(F.substring(text, 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))
