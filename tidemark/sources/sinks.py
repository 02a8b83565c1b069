"""Writers: appended parts, yearly layouts, layers, reports, done-tables, file hashes, manifests."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder that all executors share; where none is set, a local one, but only if driver and executors are one process (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tidemark-")
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: what reads it twice computes it once, and lineage ends there."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """More parts in a folder; they appear when the whole write has been committed."""
    df.write.mode("append").parquet(path)


def yearly(df: DataFrame, path: str, year: str = "year", files_per_year: int = 8) -> None:
    """A rebuilt ``year=YYYY/`` layout. A year is dealt to a few tasks by hash, so a large one isn't one task's."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != year]), F.lit(files_per_year))
    df.withColumn("__s", spread).repartition(year, "__s").drop("__s").write.mode("overwrite").partitionBy(year).parquet(path)


def layers(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def report_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file; aggregate first."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def report_json(df: DataFrame, path: str) -> None:
    """A small report, a JSON object a line."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def replaced(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Rewrites a table that ``df`` may read itself: written beside it, counted, then moved into its place.

    The old table is renamed, not deleted, until the new one has its name: a job that dies in between leaves both whole,
    and the next call moves the old one back before it starts.
    """
    aside = f"{path}.__new"
    jvm = spark.sparkContext._jvm
    new, old, before = (jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path, f"{path}.__old"))
    fs = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    restored(fs, old, before)
    n = df.count()
    df.write.mode("overwrite").parquet(aside)
    if (m := spark.read.parquet(aside).count()) != n:
        raise RuntimeError(f"{path}: {m} rows written, {n} expected; the table is unchanged")
    if fs.exists(old) and not fs.rename(old, before):
        raise RuntimeError(f"{path}: could not be moved aside; the table is unchanged")
    if not fs.rename(new, old):
        fs.rename(before, old)
        raise RuntimeError(f"{path}: the table is unchanged, the new one is in {aside}")
    fs.delete(before, True)


def restored(fs, table, before) -> None:
    """Ends what a rewrite that died left: without a table the old one is moved back, beside a new one it goes."""
    if fs.exists(before):
        if fs.exists(table):
            fs.delete(before, True)
        else:
            fs.rename(before, table)


def done_table(results: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed job may skip: keys that have a row that isn't failed."""
    return results.filter("status <> 'failed'").select(*keys).distinct()


def file_hashes(spark: SparkSession, path: str, whole_bytes: int = 64 << 20) -> DataFrame:
    """(folder, file, bytes, sha256); the folder is the one that the file is in.

    Files of up to ``whole_bytes`` are hashed as they are read; larger ones only give their path, and a task reads each in
    pieces, so no row ever holds a large file. Their store must be one that Arrow can open too. Spark lists no empty files.
    """
    f = spark.read.format("binaryFile").load(path)
    small = f.filter(F.col("length") <= whole_bytes).select("path", "length", F.sha2("content", 256).alias("sha256"))

    def pieces(it):
        for b in it:
            found = []
            for uri in b.column(0).to_pylist():
                fs, at = pyarrow.fs.FileSystem.from_uri(uri)
                h = hashlib.sha256()
                with fs.open_input_stream(at) as stream:
                    while part := stream.read(8 << 20):
                        h.update(part)
                found.append(h.hexdigest())
            yield pa.record_batch([b.column(0), b.column(1), pa.array(found, pa.string())], names=["path", "length", "sha256"])

    large = f.filter(F.col("length") > whole_bytes).select("path", "length").mapInArrow(pieces, "path string, length bigint, sha256 string")
    name = F.split("path", "/")
    return small.unionByName(large).select(F.element_at(name, -2).alias("folder"), F.element_at(name, -1).alias("file"), F.col("length").alias("bytes"), "sha256")


def day_manifest(files: DataFrame, day: str, expected: int) -> DataFrame:
    """One row a day: files, bytes, and whether that is all."""
    n = F.count("*")
    return files.groupBy(day).agg(n.alias("files"), F.sum("bytes").alias("bytes"), F.when(n >= expected, "COMPLETE").when(n == 0, "INVALID").otherwise("PARTIAL").alias("completeness"))
