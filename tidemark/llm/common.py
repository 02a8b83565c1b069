"""Shared pieces of the training-data operators: shared-folder tables, size-checked joins, Arrow text buffers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts that count anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast up to this many rows (narrow rows: an id or a key and a few numbers).
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, a local one, but only if driver and executors are one process (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tidemark-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there, and a lost executor costs no recompute.

    Unlike ``checkpoint()`` this runs the plan once and keeps columns compressed.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, whatever the optimizer later merges."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: A round of a running sum adds so many values; six rounds reach 2**30 matches of one text.
FAN, ROUNDS = 32, 6


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """At each place the result of ``step`` (associative, in any order) over all values up to it.

    Each round unites ``FAN`` neighbouring stretches, so the work is in proportion to the values, times the rounds they need.
    """

    def round_of(d: int) -> Callable[[Column], Column]:
        def united(v: Column) -> Column:
            def at(x: Column, i: Column) -> Column:
                back = F.sequence(F.lit(1), F.least(F.lit(FAN - 1), F.floor(i / d).cast("int")))
                return F.when(i < d, x).otherwise(F.aggregate(back, x, lambda a, k: step(a, F.get(v, i - k * d))))

            return F.when(F.size(v) > d, F.transform(v, at)).otherwise(v)

        return united

    for r in range(ROUNDS):
        values = let(values, round_of(FAN**r))
    return values


def join_small(left: DataFrame, right: DataFrame, key: str, how: str = "left", rows: int | None = None) -> DataFrame:
    """Join on ``key`` where ``right`` has one row a key and ``left`` may have hot keys; nulls in ``key`` match.

    ``right`` is broadcast when it has at most ``BROADCAST_ROWS`` rows (counted here), so no key is shuffled. Beyond that
    both sides are dealt by key, and the rows of a hot key are split among tasks by adaptive execution: nothing that needs
    a key's rows together follows the join.
    """
    rows = right.count() if rows is None else rows
    r = right.withColumnRenamed(key, "__k")
    on = F.col(key).eqNullSafe(F.col("__k"))
    return left.join(F.broadcast(r) if rows <= BROADCAST_ROWS else r, on, how).drop("__k")


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", anti: bool = False) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (or is not: ``anti``); ``ids`` is broadcast only if counted small."""
    ids = ids.select(F.col(id_col).alias("__k")).distinct()
    small = ids.count() <= BROADCAST_ROWS * 5
    return docs.join(F.broadcast(ids) if small else ids, docs[id_col] == F.col("__k"), "left_anti" if anti else "left_semi")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row starts (one more: the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int):
    """Ranges of rows that hold about ``limit`` bytes together (one row may be larger)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def ranges_of(docs: DataFrame, size: int) -> int:
    """How many ranges of hashes: about one for ``size`` bytes of text (summed here), so that a range does not grow with the input."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(16, -(-total // size))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def batches(it, limit: int = 4 << 20):
    """Slices of Arrow batches of about ``limit`` text bytes each, the text being the column ``text``."""
    for b in it:
        col = b.column(b.schema.get_field_index("text"))
        if not len(col):
            continue
        _, at = utf8(col)
        for i, j in pieces(at, limit):
            yield b.slice(i, j - i)
