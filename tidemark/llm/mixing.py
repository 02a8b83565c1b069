"""Mixing sources to target weights with hash-threshold histograms.

A source takes whole passes over its documents and, for what is then left of its target, the documents whose hash is
below a threshold. The threshold is found without sorting: words are summed by source and the top bits of the hash,
running sums over the buckets find the one bucket that the target falls into, and only that bucket's documents are
summed again by the next bits. Thresholds are nested: a larger budget takes a superset.

Targets: sources by code point, null last, weigh 5, 2, 1 and so on, and share ``percent`` of all words; a target stops
at ``most`` times its source's size and the excess is shared again by weight.

Cases: null text has no words; a null source is a source; rows with one id share a hash and are taken together;
a null id hashes like an empty one; an empty table gives no row. The document on the threshold is taken when that comes nearer to
the target than leaving it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, join_small, written

#: Fixed by the task: the weights, in turn.
WEIGHTS = (5, 2, 1)
PERCENT, MOST = 150, 2
#: Bits of the hash, and bits resolved by one histogram.
BITS, STEP = 40, 10


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(id_col: Column) -> Column:
    """40 bits of MD5, as SQL elsewhere can compute them too; documents that agree in them are taken together."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def ranked(df: DataFrame, col: str) -> DataFrame:
    """``df`` with ``n``: the place of the row by ``col`` ascending, null last, from 0. Only the partitions' row counts reach the driver."""
    s = written(df.repartitionByRange(F.col(col).asc_nulls_last()).sortWithinPartitions(F.col(col).asc_nulls_last()).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranked")
    before, at = {}, 0
    for p, n in sorted((r[0], r[1]) for r in s.groupBy("__p").count().collect()):
        before[p], at = at, at + n
    if not before:
        return s.withColumn("n", F.lit(0).cast("long")).drop("__p", "__i")
    start = F.create_map(*[x for p, b in before.items() for x in (F.lit(p), F.lit(b).cast("long"))])
    return s.withColumn("n", start[F.col("__p")] + F.col("__i")).drop("__p", "__i")


def targets(sizes: DataFrame, percent: int = PERCENT, most: int = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """``sizes``: (source, source_size), one row each -> with ``target`` (double).

    Rounds of filling: sources whose share by weight reaches their limit are held at it and the rest is shared among
    the others, until none is above. A round is one sum over the sources; few are needed and they end after as many as
    there are sources at most.
    """
    s = written(ranked(sizes, "source").withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))), "sizes")
    cap = most * F.col("source_size")
    total, weight = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * percent / 100, F.coalesce(F.sum("w"), F.lit(0))).first()
    full, n = 0, 0
    while weight:
        held = F.col("w") * F.lit(float(total - full)) / F.lit(float(weight)) >= cap
        m, full, weight = s.agg(F.count(F.when(held, 1)), F.coalesce(F.sum(F.when(held, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~held, F.col("w"))), F.lit(0))).first()
        if m == n:
            break
        n = m
    share = F.col("w") * F.lit(float(total - full)) / F.lit(float(weight or 1))
    return s.select("source", "source_size", F.when((share >= cap) | F.lit(not weight), cap.cast("double")).otherwise(share).alias("target"))


def thresholds(docs: DataFrame, wanted: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """Per source the hash below which documents are taken once more, so that their words come nearest to ``rest``.

    ``docs``: (source, h, size); ``wanted``: (source, rest), rest >= 0. Returns (source, cut).
    """
    open_ = wanted.select("source", F.col("rest").cast("double"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    level = 0
    while level * step < bits:
        shift = bits - (level + 1) * step
        inside = join_small(docs, open_.select("source", "prefix"), "source", "inner")
        if level:
            inside = inside.filter(F.shiftright("h", shift + step) == F.col("prefix"))
        hist = inside.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("size"))
        hist = join_small(hist, open_.select("source", "rest", "below"), "source", "inner")
        w = Window.partitionBy("source").orderBy("b")
        run = hist.withColumn("upto", F.col("below") + F.sum("size").over(w))
        # the boundary bucket: the first whose running sum exceeds what is wanted
        edge = run.filter(F.col("upto") > F.col("rest")).groupBy("source").agg(F.min(F.struct("b", "size", "upto", "rest")).alias("e"))
        found = edge.select("source", F.col("e.rest").alias("rest"), F.col("e.b").alias("prefix"), (F.col("e.upto") - F.col("e.size")).alias("below"), F.col("e.size").alias("size"))
        open_ = written(found, f"level{level}")
        level += 1
    nearer = F.col("below") + F.col("size") - F.col("rest") < F.col("rest") - F.col("below")
    return open_.select("source", F.when(nearer, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("cut"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", percent: int = PERCENT, most: int = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies): ``copies`` says how often the mix holds the document."""
    d = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), hash_of(F.col(id_col)).alias("h")), "sized")
    t = written(targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), percent, most, weights), "targets")
    n = t.count()
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    t = t.withColumn("passes", whole).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    cut = thresholds(d.select("source", "h", "size").filter("size > 0"), t.filter("rest > 0").select("source", "rest"))
    plan = join_small(t.drop("rest"), cut, "source", rows=n)
    copies = F.col("passes") + F.coalesce((F.col("h") < F.col("cut")).cast("long"), F.lit(0))
    return join_small(d, plan, "source", rows=n).select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))
