"""Merkle manifest of a table: a digest of every row, a root for every source, one root for the whole, and a proof per row.

Leaves are digests that the JVM computes in one pass over the texts; after that only digests move. Leaves are dealt by
range of (source, id, digest), so a hot source is split by id, and numbered. Then vertices work in supersteps over RDDs,
as in Pregel. A vertex stands for a node with the ``STRIDE`` levels below it, so that an exchange climbs several levels:
each node sends its digest to the vertex above; by the end of the step a vertex has all its children, hashes them level by
level and sends on. Trees of sources run side by side; the subroots of complete ones are the leaves of the tree of sources.
All vertices of the way up are written as a table. The reverse supersteps begin at the root: a vertex sends each child the
digests beside it on each level, followed by what the vertex itself has got, so every leaf ends up with its whole path and
folds its digest up to the root.

A step deals its messages by (tree, place), at most ``NODES`` nodes to a task on average, and a key never has more than
27 messages. The driver learns how many levels there are, how many leaves lie in each range, and the root, nothing else.

Cases: nulls in any column have a digest of their own (``-``), whose order is before all values; rows with equal ids are
ordered by digest, and equal rows are leaves of their own; empty and very long texts are digested whole; extra columns take
no part; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import join_small, shared_dir, written

#: Children of a node, levels of a vertex, children of a vertex.
FAN, STRIDE = 3, 3
WIDE = FAN**STRIDE
#: Nodes of a task: at most so many on average, and no more tasks than cores while there are fewer than ``FEW`` each.
NODES, FEW = 50_000, 2000
#: The tree above the sources has this number; the sources are numbered from 0.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(columns: dict[str, Column]) -> Column:
    """Digest of a row: each value as ``-`` or its length in bytes, a colon, and itself."""
    texts = [c.cast("string") for c in columns.values()]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def up(digests: list[bytes]) -> bytes:
    """The node above: digests are joined as hexadecimal text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def fold(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a digest and what stands left and right of it, level by level, lead to."""
    for left, right in path:
        digest = up([left, digest, right])
    return digest


def proof(path: list[tuple[bytes, bytes]]) -> str:
    return up([x for pair in path for x in pair]).hex()


def numbered(leaves: DataFrame) -> tuple[DataFrame, int, int]:
    """Leaves with tree (number of their source), place in it, and leaves of the tree; the largest tree; how many trees.

    ``leaves`` is a written table. Equal rows may change places, which changes nothing.
    """
    spark = leaves.sparkSession
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("at")]
    ranges = max(spark.sparkContext.defaultParallelism, -(-leaves.count() // NODES))
    ordered = leaves.repartitionByRange(ranges, *order).sortWithinPartitions(*order[:3]).drop("at")
    placed = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), StructType([*ordered.schema.fields, StructField("g", LongType())]))
    sizes = leaves.groupBy("source").agg(F.count("*").alias("n")).repartitionByRange(F.col("source").asc_nulls_first()).sortWithinPartitions(F.col("source").asc_nulls_first())
    sizes = written(_started(sizes), "sources")
    top = sizes.agg(F.count("*"), F.max("n")).first()
    return join_small(placed, sizes, "source", "inner", rows=top[0]).withColumn("place", F.col("g") - F.col("start")), top[1] or 0, top[0]


def _started(sizes: DataFrame) -> DataFrame:
    """(source, tree, n, start): sources in order, each with the leaves before it; the driver gets two sums a partition."""
    spark, rdd = sizes.sparkSession, sizes.rdd
    sums = dict(rdd.mapPartitionsWithIndex(lambda i, it: [(i, _sums(it))]).collect())
    before, tree, start = {}, 0, 0
    for i in sorted(sums):
        before[i] = (tree, start)
        tree, start = tree + sums[i][0], start + sums[i][1]

    def run(i, it):
        tree, start = before[i]
        for source, n in it:
            yield source, tree, n, start
            tree, start = tree + 1, start + n

    return spark.createDataFrame(rdd.mapPartitionsWithIndex(run), "source string, tree long, n long, start long")


def _sums(it) -> tuple[int, int]:
    rows = leaves = 0
    for _, n in it:
        rows, leaves = rows + 1, leaves + n
    return rows, leaves


def levels(n: int) -> int:
    """Levels above ``n`` nodes."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def steps(n: int) -> int:
    """Supersteps that a tree of ``n`` leaves needs."""
    return -(-levels(n) // STRIDE)


def climbed(n: int, digests: list[bytes]) -> tuple[int, list[list[bytes]]]:
    """A vertex's nodes level by level, from its children up to itself; ``n``: nodes of the tree at the children's level."""
    rows = [digests]
    for _ in range(min(STRIDE, levels(n))):
        rows.append([up(rows[-1][i : i + FAN]) for i in range(0, len(rows[-1]), FAN)])
        n = -(-n // FAN)
    return n, rows


def risen(nodes: RDD, height: int, parts: Callable[[int], int]) -> list[RDD]:
    """The supersteps upward: for each step its vertices, ((tree, place), (n, digests of the children)).

    ``nodes``: ((tree, place), (nodes of the tree at this level, digest)).
    """
    vertices = []
    for step in range(height):
        sent = nodes.filter(lambda x: x[1][0] > 1).map(lambda x: ((x[0][0], x[0][1] // WIDE), (x[0][1] % WIDE, x[1][1], x[1][0])))
        vertices.append(sent.groupByKey(parts(step + 1)).mapValues(_complete))
        nodes = vertices[-1].mapValues(_itself)
    return vertices


def _complete(messages) -> tuple[int, list[bytes]]:
    """How many nodes the children's level has, and the children in order."""
    got = sorted(messages)
    return got[0][2], [d for _, d, _ in got]


def _itself(vertex: tuple[int, list[bytes]]) -> tuple[int, bytes]:
    n, rows = climbed(*vertex)
    return n, rows[-1][0]


def told(vertex: tuple) -> list[tuple]:
    """What a vertex tells its children: the digests beside each on every level, then its own path."""
    (tree, place), ((n, digests), path) = vertex
    _, rows = climbed(n, digests)
    out = []
    for i in range(len(digests)):
        own, at = [], i
        for row in rows[:-1]:
            first = at // FAN * FAN
            own.append((b"".join(row[first:at]), b"".join(row[at + 1 : first + FAN])))
            at //= FAN
        out.append(((tree, WIDE * place + i), own + path))
    return out


def fallen(vertices: list[RDD], entered: list[RDD], parts: Callable[[int], int]) -> RDD:
    """The supersteps downward: ((tree, place), path) of every leaf. ``entered``: by step, the paths of the trees that end there."""
    paths = entered[-1]
    for step in range(len(vertices) - 1, -1, -1):
        paths = vertices[step].join(paths, parts(step + 1)).flatMap(told).union(entered[step])
    return paths


VERTEX = "step int, tree long, place long, n long, digests array<binary>"


def kept(spark: SparkSession, vertices: list[RDD]) -> list[RDD]:
    """The vertices of each step, written as a table and read again: the way down does not climb once more."""
    if not vertices:
        return []
    table = f"{shared_dir(spark)}/vertices"
    every = [v.map(lambda x, k=k: (k, *x[0], *x[1])) for k, v in enumerate(vertices)]
    spark.createDataFrame(spark.sparkContext.union(every), VERTEX, verifySchema=False).write.partitionBy("step").parquet(table)
    rows = spark.read.schema(VERTEX).parquet(table).select("step", "tree", "place", "n", "digests")
    return [rows.filter(F.col("step") == k).rdd.map(lambda r: ((r[1], r[2]), (r[3], [bytes(d) for d in r[4]]))) for k in range(len(vertices))]


def last(vertices: list[RDD]) -> RDD:
    """(tree, root) of every tree with a vertex."""
    nodes = [v.filter(lambda x: steps(x[1][0]) == 1).map(lambda x: (x[0][0], _itself(x[1])[1])) for v in vertices]
    return nodes[0].context.union(nodes)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, source, place, leaf, subroot, root, n_siblings, proof_sha256, folded_root, verified of every row of ``docs``.

    ``tampered``: another text to verify a row with, null where the row is as it was; the proofs are those of the table.
    """
    spark = docs.sparkSession
    own = leaf({c: F.col(c) for c in COLUMNS})
    shown = F.when(tampered.isNotNull(), leaf({c: tampered if c == "text" else F.col(c) for c in COLUMNS})) if tampered is not None else F.lit(None).cast("string")
    leaves = written(docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"), shown.alias("shown"), F.monotonically_increasing_id().alias("at")), "leaves")
    placed, largest, trees = numbered(leaves)
    placed = written(placed.select("tree", "place", "n", "doc_id", "source", F.unhex("leaf").alias("leaf"), F.unhex("shown").alias("shown")), "placed")
    n, below = placed.count(), spark.sparkContext.defaultParallelism
    schema = "doc_id long, source string, place long, leaf string, subroot string, root string, n_siblings long, proof_sha256 string, folded_root string, verified boolean"
    if not n:
        return spark.createDataFrame([], schema)

    def spread(nodes: int) -> int:
        return max(1, min(below, nodes // FEW), nodes // NODES)

    def parts(step: int) -> int:
        return spread(n // WIDE**step + trees)

    def parts_top(step: int) -> int:
        return spread(trees // WIDE**step)

    # upward: the sources side by side, then the tree of sources
    start = placed.select("tree", "place", "n", "leaf").rdd.map(lambda r: ((r[0], r[1]), (r[2], bytes(r[3]))))
    vertices = kept(spark, risen(start, steps(largest), parts))
    single = placed.filter("n = 1").select("tree", "leaf").rdd.map(lambda r: (r[0], bytes(r[1])))
    subroots = single.union(last(vertices)) if vertices else single
    above = kept(spark, risen(subroots.map(lambda x: ((TOP, x[0]), (trees, x[1]))), steps(trees), parts_top))
    whole = (last(above) if above else subroots).first()[1]
    # downward
    nothing = spark.sparkContext.emptyRDD()
    of_trees = fallen(above, [*[nothing] * len(above), spark.sparkContext.parallelize([((TOP, 0), [])], 1)], parts_top)
    heights = placed.filter("place = 0").select("tree", "n").rdd.map(lambda r: (r[0], steps(r[1])))
    ends = of_trees.map(lambda x: (x[0][1], x[1])).join(heights, parts_top(0))
    entered = [ends.filter(lambda x, k=k: x[1][1] == k).map(lambda x: ((x[0], 0), x[1][0])) for k in range(len(vertices) + 1)]
    paths = fallen(vertices, entered, parts)
    leaf_rows = placed.rdd.map(lambda r: ((r[0], r[1]), (r[3], r[4], bytes(r[5]), r[6] and bytes(r[6]), levels(r[2]))))

    def seen(x):
        (_, place), ((doc_id, source, own, other, high), path) = x
        ends_at = fold(other or own, path)
        return doc_id, source, place, own.hex(), fold(own, path[:high]).hex(), whole.hex(), sum(len(a) + len(b) for a, b in path) // len(own), proof(path), ends_at.hex(), ends_at == whole

    return spark.createDataFrame(leaf_rows.join(paths, parts(0)).map(seen), schema, verifySchema=False)


def digest(docs: DataFrame) -> DataFrame:
    """The manifest, verified against texts whose line feeds are gone where the checksum of the id is even."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    m = manifest(docs, F.when(even & F.col("text").isNotNull(), F.translate("text", "\n", "")))
    return m.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
