"""Exact top-k by inner product with M-trees: paged metric nodes, covering radii, parent distances, best-first search.

Inner products become distances: with M2 the largest squared length, a row x gets one more coordinate sqrt(M2 - |x|^2) and a
query q a zero, so that d(q, x)^2 = |q|^2 + M2 - 2 q.x. The nearest rows are then those of the highest products, and d obeys
the triangle inequality.

Building. Equal vectors become one, with as many of their smallest ids as a query can ever return; no result needs more.
A bounded sample gives at most ``REGIONS`` routing objects; each vector goes to the nearest, and a region is dealt by hash
into trees of about ``TREE`` vectors. One task builds one tree: routing objects far from each other, members to the nearest,
until a page holds at most ``LEAF``. A page keeps its entries' distances to its routing object (parent distances), and inner
pages the covering radii. Every vector is indexed, the pages are a table, and the index serves any number of searches.

Searching. A query first meets the tree it would lie in; that gives a bound, the k-th best product so far. With it, it is
sent to each tree whose region the triangle inequality can't exclude, in blocks of ``BLOCK_VALUES`` numbers. Within a tree
pages wait in a heap, the nearest first; a page is opened once for all queries that still need it. Stored distances
exclude entries before any product is computed; the rest are products of matrices. All comparisons leave a margin wider
than rounding, and the products are whole numbers, so results are exact.

Cases: null vectors and those with null or non-finite components take no part; an empty vector is a zero; where lengths
differ the shorter one counts as filled up with zeros; components beyond 1e150 after scaling take no part either; repeated rows (equal id and vector) are one row; a row is known by
its id and vector, so another vector under the query's id is a partner; null ids come last among ties and are no queries;
products beyond a long are ranked as they are and shown as its limit; without vectors there are no rows; other columns
take no part.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Routing objects of the whole (a bounded sample), and numbers they hold at most (16 MB, broadcast with the tasks).
REGIONS, REGION_VALUES = 1024, 1 << 21
#: Vectors of a tree, entries of a leaf page, routing objects of an inner page, members among which they are sought.
TREE, LEAF, FAN, SAMPLE = 16_384, 256, 16, 1024
#: Numbers in a block of queries that meets a tree (32 MB).
BLOCK_VALUES = 1 << 22
#: Whole numbers up to this size are exact in doubles; the margin of distances, as a share of sqrt(M2).
EXACT, MARGIN = 2.0**52, 1e-6
LAST = np.iinfo(np.int64).max
PAGE = "region int, tree int, page int, leaf boolean, d int, vectors array<double>, to_parent array<double>, radii array<double>, children array<int>, ids array<bigint>, n_ids array<int>"
FOUND = "array<struct<score:bigint, vec_id:bigint, own:boolean>>"
HIT = "a bigint, b bigint, region int, tree int, high double, n int, visited bigint, computed bigint, found " + FOUND


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as doubles; null if the vector is null or holds a null, NaN or infinity."""

    def floored(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double") * scale) > 1e150))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(vector, floored))


def product(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """All inner products; Python's integers where doubles would round."""
    if exact:
        return a @ b.T
    return np.array([[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a], dtype=object).reshape(len(a), len(b))


def filled(flat: np.ndarray, lengths: np.ndarray, d: int) -> np.ndarray:
    """Vectors of any lengths as rows of ``d`` numbers."""
    out = np.zeros((len(lengths), d))
    out[np.arange(d) < lengths[:, None]] = flat
    return out


def rows_of(col: pa.Array, d: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    at = col.offsets.to_numpy().astype(np.int64)
    return filled(col.flatten().to_numpy(zero_copy_only=False), np.diff(at), d)


def sliced(it, rows: int = 2048):
    """Batches of so many rows: their distances to all regions are 16 MB."""
    for batch in it:
        yield from (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


@dataclass
class Index:
    """``pages``: a table, see ``PAGE``. Of each region its routing object, covering radius and number of trees."""

    pages: DataFrame
    vectors: DataFrame
    pivots: np.ndarray
    radii: np.ndarray
    trees: np.ndarray
    d: int
    m2: float
    k: int

    @property
    def margin(self) -> float:
        return MARGIN * max(1.0, self.m2) ** 0.5


def vectors_of(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v, a, b): whole vectors and two hashes that name a vector."""
    d = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), whole(F.col(f"`{vec_col}`"), scale).alias("v")).filter("v is not null")
    short = F.expr("slice(v, 1, size(v) - coalesce(array_position(transform(reverse(v), x -> x <> 0d), true) - 1, size(v)))")
    v = F.when(F.try_element_at("v", F.lit(-1)) != 0, F.col("v")).otherwise(F.when(F.exists("v", lambda x: x != 0), short).otherwise(F.array().cast("array<double>")))
    return d.withColumn("v", v).withColumns({"a": F.xxhash64("v"), "b": F.xxhash64(F.lit(7), "v")})


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """One row a vector with its ``keep`` smallest ids; each task reduces what it has before it sends."""
    w = Window.partitionBy("a", "b").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("i", F.row_number().over(w)).filter(F.col("i") <= keep)
    return few.groupBy("a", "b").agg(F.any_value("v").alias("v"), F.sort_array(F.collect_list(F.struct("i", "vec_id"))).alias("x")).select("a", "b", "v", F.col("x.vec_id").alias("ids"))


def index(df: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024, tree: int = TREE, regions: int = REGIONS) -> Index:
    """Indexes every vector of ``df``; a search returns up to ``k`` rows a query."""
    rows = vectors_of(df, id_col, vec_col, scale).distinct()
    vectors = written(distinct_vectors(rows, k + 1), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, d, m2 = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(square)).first()
    d, m2 = max(1, d or 0), m2 or 0.0
    count = max(1, min(regions, REGION_VALUES // d, -(-n // tree)))
    sample = np.array([r[0] + [0.0] * (d - len(r[0])) for r in vectors.orderBy("a", "b").limit(count).select("v").collect()]).reshape(-1, d)  # at most REGION_VALUES numbers
    idx = Index(None, vectors, sample, np.zeros(len(sample)), np.zeros(len(sample), np.int64), d, m2, k)
    if not n:
        idx.pages = df.sparkSession.createDataFrame([], PAGE)
        return idx
    placed = written(located(vectors, idx, "ids"), "located")
    for region, size, radius in placed.groupBy("region").agg(F.count("*"), F.max("far")).collect():  # a row a region
        idx.radii[region], idx.trees[region] = radius, -(-size // tree)
    exact, fan, trees = m2 < EXACT, FAN, idx.trees.tolist()
    pivots, full = idx.pivots, m2

    def build(key: tuple, table: pa.Table) -> pa.Table:
        region, number = (x.as_py() for x in key)
        v = rows_of(table.column("v"), d)
        ids = table.column("ids").combine_chunks()
        return pages_of(region, number, v, ids, pivots[region], full, exact, fan)

    pages = placed.withColumn("tree", tree_of(trees)).groupBy("region", "tree").applyInArrow(build, PAGE)
    idx.pages = written(pages, "pages")
    return idx


def tree_of(trees: list[int]) -> Column:
    """The tree of a vector in its region, by its hash."""
    return F.pmod(F.col("b"), F.get(F.lit(trees).cast("array<int>"), F.col("region"))).cast("int")


def augmented(v: np.ndarray, m2: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(m2 - np.einsum("ij,ij->i", v, v), 0))[:, None]])


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows of ``a`` to rows of ``b``."""
    sq = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * a @ b.T
    return np.sqrt(np.maximum(sq, 0))


def located(vectors: DataFrame, idx: Index, extra: str | None = None) -> DataFrame:
    """(a, b, v, ..., region, far): the nearest routing object and the distance to it."""
    pivots, d, m2 = augmented(idx.pivots, idx.m2), idx.d, idx.m2
    cols = ["a", "b", "v", *([extra] if extra else [])]

    def run(it):
        for batch in sliced(it):
            far = apart(augmented(rows_of(batch.column(2), d), m2), pivots)
            near = far.argmin(1).astype(np.int32) if len(far) else np.zeros(0, np.int32)
            yield pa.record_batch([*[batch.column(i) for i in range(len(cols))], pa.array(near), pa.array(far[np.arange(len(far)), near])], names=[*cols, "region", "far"])

    return vectors.select(*cols).mapInArrow(run, "a bigint, b bigint, v array<double>, " + ("ids array<bigint>, " if extra else "") + "region int, far double")


def pages_of(region: int, number: int, v: np.ndarray, ids: pa.Array, pivot: np.ndarray, m2: float, exact: bool, fan: int) -> pa.Table:
    """The pages of one tree; page 0 is its root, whose routing object is the region's."""
    a = augmented(v, m2)
    centre = augmented(pivot[None, :], m2)
    rows, open_, n_pages = [], [(0, np.arange(len(v)), centre)], 1
    while open_:
        page, own, centre = open_.pop()
        if len(own) <= LEAF:
            got = ids.take(pa.array(own))
            rows.append((page, True, v[own], apart(a[own], centre)[:, 0], [], [], got.flatten(), np.diff(got.offsets.to_numpy())))
            continue
        routes = spread_out(a, own, fan)
        far = apart(a[own], a[routes])
        near = far.argmin(1)
        sizes = np.bincount(near, minlength=len(routes))
        if sizes.max() > 0.9 * len(own):  # all alike: equal parts in order of distance, each with its own routing object
            order = np.argsort(far[:, int(sizes.argmax())], kind="stable")
            parts = [own[p] for p in np.array_split(order, fan) if len(p)]
            routes = np.array([p[0] for p in parts])
        else:
            parts = [own[near == i] for i in range(len(routes)) if sizes[i]]
            routes = routes[sizes > 0]
        children = list(range(n_pages, n_pages + len(parts)))
        n_pages += len(parts)
        radii = [float(apart(a[p], a[[r]]).max()) for p, r in zip(parts, routes, strict=True)]
        rows.append((page, False, v[routes], apart(a[routes], centre)[:, 0], radii, children, pa.array([], pa.int64()), []))
        open_ += [(c, p, a[[r]]) for c, p, r in zip(children, parts, routes, strict=True)]
    cols = [[region] * len(rows), [number] * len(rows), [r[0] for r in rows], [r[1] for r in rows], [v.shape[1]] * len(rows)]
    arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()), strict=True)]
    arrays += [lists([r[2].ravel() for r in rows], pa.float64()), lists([r[3] for r in rows], pa.float64()), lists([r[4] for r in rows], pa.float64()), lists([r[5] for r in rows], pa.int32()), lists([r[6] for r in rows], pa.int64()), lists([r[7] for r in rows], pa.int32())]
    return pa.table(arrays, names=[c.split()[0] for c in PAGE.split(", ")])


def lists(parts: list, kind: pa.DataType) -> pa.ListArray:
    """Each part as one list."""
    flat = [p if isinstance(p, pa.Array) else pa.array(np.asarray(p), kind) for p in parts]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in flat])]), pa.int32()), pa.concat_arrays(flat) if flat else pa.array([], kind))


def spread_out(a: np.ndarray, own: np.ndarray, fan: int) -> np.ndarray:
    """Up to ``fan`` members far from each other, among evenly taken ones."""
    some = own[np.linspace(0, len(own) - 1, min(SAMPLE, len(own))).astype(np.int64)]
    picks, least = [some[0]], apart(a[some], a[[some[0]]])[:, 0]
    while len(picks) < fan and least.max() > 0:
        picks.append(some[int(least.argmax())])
        least = np.minimum(least, apart(a[some], a[[picks[-1]]])[:, 0])
    return np.array(picks)


class Tree:
    """One tree's pages, and the search in them for a block of queries."""

    def __init__(self, pages: pa.Table, idx_m2: float, margin: float, exact: bool, keep: int):
        self.m2, self.margin, self.exact, self.keep = idx_m2, margin, exact, keep
        self.pages = {}
        get = {c: pages.column(c).combine_chunks() for c in pages.column_names}
        flat = {c: (get[c].flatten(), get[c].offsets.to_numpy()) for c in ("vectors", "to_parent", "radii", "children", "ids", "n_ids")}
        for i, (page, leaf, d) in enumerate(zip(get["page"].to_pylist(), get["leaf"].to_pylist(), get["d"].to_pylist(), strict=True)):
            part = {c: x[at[i] : at[i + 1]] for c, (x, at) in flat.items()}
            arrays = {c: x.to_numpy(zero_copy_only=False) for c, x in part.items() if c != "ids"}
            self.pages[page] = (leaf, arrays["vectors"].reshape(-1, d), arrays["to_parent"], arrays["radii"], arrays["children"], part["ids"], arrays["n_ids"])

    def search(self, q: np.ndarray, high: np.ndarray, to_root: np.ndarray) -> tuple[list[list], np.ndarray, np.ndarray]:
        """Of each query its best (score, id or last, id, is it its own vector); pages visited; products computed.

        ``high``: products below it are of no use. ``to_root``: distances to the region's routing object.
        """
        norms = np.einsum("ij,ij->i", q, q)
        best: list[list] = [[] for _ in q]
        high = high.copy()
        visited, computed = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        heap = [(0.0, 0, np.arange(len(q)), to_root, to_root * 0)]
        while heap:
            _, page, who, at_parent, least = heapq.heappop(heap)
            reach = np.sqrt(np.maximum(norms[who] + self.m2 - 2 * high[who], 0)) + self.margin  # infinite without a bound
            open_ = least <= reach
            if not open_.any():
                continue
            who, at_parent, reach = who[open_], at_parent[open_], reach[open_]
            visited[who] += 1
            leaf, vectors, to_parent, radii, children, ids, n_ids = self.pages[page]
            spare = radii if not leaf else 0.0
            may = np.abs(at_parent[:, None] - to_parent) - spare <= reach[:, None]  # known before any product
            cols = np.flatnonzero(may.any(0))
            if not len(cols):
                continue
            may = may[:, cols]
            scores = product(q[who], vectors[cols], self.exact)
            computed[who] += may.sum(1)
            if leaf:
                self._take(best, high, who, q, scores, may & (scores >= high[who][:, None]), cols, vectors, ids, n_ids)
                continue
            far = np.sqrt(np.maximum(norms[who][:, None] + self.m2 - 2 * scores.astype(float), 0))
            below = np.maximum(far - radii[cols], 0)
            need = may & (below <= reach[:, None])
            for j in np.flatnonzero(need.any(0)):
                rows = need[:, j]
                heapq.heappush(heap, (float(below[rows, j].min()), int(children[cols[j]]), who[rows], far[rows, j], below[rows, j]))
        return best, visited, computed

    def bound(self, best: list) -> float:
        """The product that a further row must reach; rounded down where doubles aren't exact."""
        if len(best) < self.keep:
            return float("-inf")
        return float(-best[-1][0]) if self.exact else float(np.nextafter(float(-best[-1][0]), -np.inf))

    def _take(self, best, high, who, q, scores, good, cols, vectors, ids, n_ids) -> None:
        starts = np.concatenate([[0], np.cumsum(n_ids)])
        for i in np.flatnonzero(good.any(1)):
            w = who[i]
            for j in np.flatnonzero(good[i]):
                s, c = int(scores[i, j]), cols[j]
                own = bool((q[w] == vectors[c]).all())
                for x in ids[starts[c] : starts[c + 1]].to_pylist():
                    best[w].append((-s, LAST if x is None else x, x is None, x, own))
            best[w] = sorted(best[w], key=lambda x: x[:3])[: self.keep]
            if len(best[w]) == self.keep:
                high[w] = max(high[w], self.bound(best[w]))


def hits(pages: DataFrame, asked: DataFrame, idx: Index, by: list[str]) -> DataFrame:
    """Each asked query (a, b, v, region, tree, far, high) in its tree."""
    d, m2, margin, exact, keep = idx.d, idx.m2, idx.margin, idx.m2 < EXACT, idx.k + 1
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64()), ("own", pa.bool_())]))]
    limit = np.iinfo(np.int64)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in HIT.split(", ")[:8]] + ["found"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        high = right.column("high").to_numpy()
        tree = Tree(left, m2, margin, exact, keep)
        best, visited, computed = tree.search(rows_of(right.column("v"), d), high, right.column("far").to_numpy())
        found = [[{"score": min(max(-x[0], limit.min), limit.max), "vec_id": x[3], "own": x[4]} for x in b] for b in best]
        bound = [tree.bound(b) for b in best]
        own = [right.column(c).combine_chunks() for c in ("a", "b", "region", "tree")]
        return pa.table([*own, pa.array(bound), pa.array([len(b) for b in best], pa.int32()), pa.array(visited), pa.array(computed), pa.array(found, kinds[-1])], names=names)

    return pages.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(run, HIT)


def search(idx: Index, queries: DataFrame) -> DataFrame:
    """(a, b, found): the ``k`` + 1 best rows of each distinct vector of ``queries`` (a, b, v), best first."""
    spark = queries.sparkSession
    if not len(idx.pivots):
        return spark.createDataFrame([], f"a bigint, b bigint, found {FOUND}")
    trees = idx.trees.tolist()
    asked = located(queries.dropDuplicates(["a", "b"]), idx).withColumn("tree", tree_of(trees)).withColumn("high", F.lit(float("-inf")))
    asked = written(asked, "asked")
    first = written(hits(idx.pages, asked, idx, ["region", "tree"]), "first")
    # further trees: those that the bound can't exclude
    bounded = asked.select("a", "b", "v", F.col("region").alias("r0"), F.col("tree").alias("t0")).join(first.select("a", "b", "high"), ["a", "b"])
    further = written(_reached(bounded, idx), "further")
    width = max(1, BLOCK_VALUES // idx.d)
    counts = dict(further.groupBy("region", "tree").count().select(F.concat_ws(":", "region", "tree"), "count").filter(F.col("count") > width).collect())  # only trees that many queries reach
    blocks = {k: -(-n // width) for k, n in counts.items()}
    table = spark.createDataFrame([(*map(int, k.split(":")), n) for k, n in blocks.items()], "region int, tree int, blocks int")
    table = F.broadcast(table)  # at most a row for each BLOCK_VALUES numbers sent
    n_blocks = F.coalesce("blocks", F.lit(1))
    pages = idx.pages.join(table, ["region", "tree"], "left").withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))).drop("blocks")
    sent = further.join(table, ["region", "tree"], "left").withColumn("block", F.pmod("a", n_blocks).cast("int")).drop("blocks")
    second = hits(pages, sent, idx, ["region", "tree", "block"])
    both = first.unionByName(second).select("a", "b", F.explode("found").alias("f"))
    w = Window.partitionBy("a", "b").orderBy(F.col("f.score").desc(), F.col("f.vec_id").asc_nulls_last())
    top = both.withColumn("i", F.row_number().over(w)).filter(F.col("i") <= idx.k + 1)
    return top.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("i", "f"))).alias("x")).select("a", "b", F.col("x.f").alias("found"))


def _reached(bounded: DataFrame, idx: Index) -> DataFrame:
    """A row for each tree, but the first, that may hold a better row."""
    pivots, radii, trees, d, m2, margin = idx.pivots, idx.radii, idx.trees, idx.d, idx.m2, idx.margin

    def run(it):
        for batch in sliced(it):
            v = rows_of(batch.column(2), d)
            norms, high = np.einsum("ij,ij->i", v, v), batch.column(5).to_numpy()
            far = np.sqrt(np.maximum(norms[:, None] + m2 - 2 * v @ pivots.T, 0))
            reach = np.sqrt(np.maximum(norms + m2 - 2 * high, 0)) + margin
            i, region = np.nonzero(far - radii <= reach[:, None])
            row = np.repeat(i, trees[region])
            which = np.repeat(region, trees[region])
            tree = np.arange(len(row)) - np.repeat(np.cumsum(trees[region]) - trees[region], trees[region])
            r0, t0 = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            new = (which != r0[row]) | (tree != t0[row])
            row, which, tree = row[new], which[new], tree[new]
            take = pa.array(row)
            yield pa.record_batch([batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(which.astype(np.int32)), pa.array(tree.astype(np.int32)), pa.array(far[row, which]), pa.array(high[row])], names=["a", "b", "v", "region", "tree", "far", "high"])

    return bounded.mapInArrow(run, "a bigint, b bigint, v array<double>, region int, tree int, far double, high double")


def nearest(df: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024, tree: int = TREE, regions: int = REGIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id ``every`` divides, the ``k`` highest products with all other rows."""
    idx = index(df, k, id_col, vec_col, scale, tree, regions)
    asked = vectors_of(df.filter(F.col(f"`{id_col}`") % every == 0), id_col, vec_col, scale).distinct()
    asked = written(asked, "queries")
    found = search(idx, asked.select("a", "b", "v"))
    lists = asked.select("vec_id", "a", "b").join(found, ["a", "b"])
    others = F.slice(F.filter("found", lambda f: ~(f["own"] & f["vec_id"].eqNullSafe(F.col("vec_id")))), 1, k)
    return lists.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("i", "f")).select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
