"""MinHash near-duplicates with tensored banding, every link confirmed on full shingle sets.

Two collections of ``SIDE`` small hashes (each of ``ROWS`` minhashes) are computed per document; table key (i, j)
combines hash i of the first collection with hash j of the second. ``SIDE * SIDE`` tables of keys of ``2 * ROWS``
minhashes thus cost ``2 * SIDE * ROWS`` minhashes. A document takes part in the tables only if one of its hashes in
*each* collection is shared with another text: without that no key can be.

With 10 and 3, a pair at similarity 0.85 is missed with probability 0.00015, less above it.

Equal shingle sets are one class from the start. Candidates are confirmed in two rounds, so that a bucket of copies
never becomes all of its pairs. First every member against the bucket's hub, the text that shares its hashes with most
others. Then, with components known, the members of buckets that are still in several components (``close_pairs``):
shingles that the same texts have are one token with their number as weight; tokens are ranked by rarity, and two
similar texts share a token among the rarest of both, those that outweigh what a similar text may lack. Groups of
texts by such a token are compared by exact bounds on the intersection. A group of more than ``HOT`` texts is divided
by the next token that they share, and so on, wherever that leaves less to compare (counted before). Texts of a divided
group that are similar by the shared tokens alone are paired with its smallest text, which links them all. What is left
are pairs within the bounds; the weights of all the tokens that two texts share add up to their intersection, so few but
similar pairs meet with their full sets. The pairs within the bounds still grow faster than the texts in a family of
templates whose texts are many and nearly similar; they are compared by their tokens, a few numbers each. No link that
could join two components is left out.

Cases: null text, no words: an empty set, linked with nothing; fewer words than a shingle: the whole sequence is the one
shingle; rows with one id are one document, linked if one of
its texts is (each row gets the id's component); a null id is linked with nothing, has no
component and is kept; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, join_small, keep_ids, mixed, written

SIZE, SIDE, ROWS, PERCENT = 5, 10, 3, 85
#: Texts of one token that are compared with each other before the group is divided by a second one; how often it is
#: divided; how many comparisons of two texts a row costs that dividing a group makes.
HOT, DEPTH, ROW_COST = 8, 8, 8
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = np.uint64(0x9FB21C651E98DF25)


class WordHashes(dict):
    """64-bit hashes of words, kept for the words of this worker; forgotten when they become many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:  # some 40 MB
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingle_sets(texts: list[str | None], size: int, cache: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    lists = [(t or "").encode().translate(_LOWER).split() for t in texts]
    n = [len(w) for w in lists]
    h = np.fromiter((cache[w] for words in lists for w in words), np.uint64, sum(n))
    x = h[: max(0, len(h) - size + 1)].copy()
    for k in range(1, size):
        x = x * _STEP + h[k : k + len(x)]
    x = mixed(x)
    out, at = [], 0
    for k in n:
        if k >= size:
            out.append(np.unique(x[at : at + k - size + 1]))
        elif k:
            y = np.array([k], np.uint64)
            for v in h[at : at + k]:
                y = y * _STEP + v
            out.append(mixed(y))
        else:
            out.append(np.zeros(0, np.uint64))
        at += k
    return out


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd factors and offsets of the hash functions."""
    x = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:n] | np.uint64(1), x[n:]


def side_keys(sets: list[np.ndarray], side: int, rows: int) -> np.ndarray:
    """For each non-empty set its 2 * side hashes; the lowest bit says the collection."""
    a, b = multipliers(2 * side * rows)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    u = np.concatenate(sets)
    out = np.zeros((len(sets), 2 * side), np.uint64)
    for k in range(2 * side):
        key = np.full(len(sets), k, np.uint64)
        for r in range(rows):
            key = mixed(key * _STEP + np.minimum.reduceat(u * a[k * rows + r] + b[k * rows + r], at))
        out[:, k] = (key & ~np.uint64(1)) | np.uint64(k >= side)
    return out


def signatures(docs: DataFrame, size: int, side: int, rows: int) -> DataFrame:
    """(doc_id, n, fp, keys): set size, the set's fingerprint, the hashes of both collections."""

    def sign(it):
        cache = WordHashes()
        for b in batches(it, 1 << 20):
            sets = shingle_sets(b.column(1).to_pylist(), size, cache)
            some = [s for s in sets if len(s)]
            keys = side_keys(some, side, rows).view(np.int64) if some else np.zeros((0, 2 * side), np.int64)
            ends = np.concatenate([[0], np.cumsum([2 * side if len(s) else 0 for s in sets])]).astype(np.int32)
            fp = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel(), pa.int64()))
            yield pa.record_batch([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp, pa.binary()), lists], names=["doc_id", "n", "fp", "keys"])

    return docs.mapInArrow(sign, "doc_id bigint, n bigint, fp binary, keys array<bigint>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, fp, s): the shingle hashes of each document, and the set's fingerprint."""

    def sets(it):
        cache = WordHashes()
        for b in batches(it, 1 << 20):
            found = shingle_sets(b.column(1).to_pylist(), size, cache)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).view(np.int64), pa.int64()))
            fp = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            yield pa.record_batch([b.column(0), pa.array(fp, pa.binary()), lists], names=["doc_id", "fp", "s"])

    return docs.mapInArrow(sets, "doc_id bigint, fp binary, s array<bigint>")


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) for undirected links (a, b): comp is the smallest id that can be reached.

    Every node hooks to its smallest neighbour, pointers are doubled until they rest at a root, links are drawn between
    roots, and so on until no link is left. Each step is a join or sum over tables in the shared folder.
    """
    e = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("comp"))
    while not e.isEmpty():
        both = e.union(e.select("b", "a"))
        parent = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("p")), "parents")
        while True:
            up = parent.select(F.col("x").alias("y"), F.col("p").alias("q"))
            jumped = written(parent.join(up, F.col("p") == F.col("y")).select("x", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")), "jumped")
            parent = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        labels = written(labels.join(parent, F.col("comp") == F.col("x"), "left").select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        pa_, pb_ = parent.select(F.col("x").alias("xa"), F.col("p").alias("pa")), parent.select(F.col("x").alias("xb"), F.col("p").alias("pb"))
        roots = e.join(pa_, F.col("a") == F.col("xa")).join(pb_, F.col("b") == F.col("xb"))
        e = written(roots.filter("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    return labels


def intersections(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, i, t): for each pair the size of the intersection and the sum of both sizes.

    Nothing is summed after the joins, so that Spark may split the rows of a hub that very many texts have.
    """
    sa, sb = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("t"))


def similar(i: Column, t: Column, percent: int) -> Column:
    return 100 * i >= percent * (t - i)


def own_shingles(sets: DataFrame) -> DataFrame:
    """(id, own): how many shingles no other of the documents has; nothing for those without any."""
    every = sets.select("id", F.explode("s").alias("h")).groupBy("h").agg(F.min("id").alias("id"), F.max("id").alias("last"), F.count("*").alias("c"))
    return every.filter("c = 1 and id = last").groupBy("id").agg(F.count("*").alias("own"))


def weighed_tokens(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, comp, n, rest, slack, pos, size, token, w, before) of texts that may be similar to another of ``nodes`` (id, n, comp).

    A token is all shingles that the same texts have, ``w`` of them. Tokens rise from the rarest; ``before`` is the weight
    of those that come first, ``size`` how many there are. ``rest``: shingles that others have too; ``slack``: how many of these a similar text may lack.
    """
    single = sets.join(nodes.select("id"), "id", "left_semi").select("id", F.explode("s").alias("h"))
    kinds = single.groupBy("h").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("id")).alias("p"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("q")).filter("c > 1")
    tokens = single.join(kinds, "h").groupBy("id", "c", "p", "q").agg(F.count("*").alias("w"))
    order = Window.partitionBy("id").orderBy("c", "p", "q")
    ranked = tokens.select("id", F.xxhash64("p", "q").alias("token"), "w", F.row_number().over(order).alias("pos"), (F.sum("w").over(order) - F.col("w")).alias("before"), F.sum("w").over(Window.partitionBy("id")).alias("rest"), F.count("*").over(Window.partitionBy("id")).alias("size"))
    slack = F.col("rest") - F.ceil(F.col("n") * percent / 100).cast("long")
    return ranked.join(nodes, "id").withColumn("slack", slack).filter("slack >= 0")


def close_pairs(nodes: DataFrame, sets: DataFrame, percent: int, hot: int = HOT, depth: int = DEPTH) -> DataFrame:
    """(a, b) of all texts of ``nodes`` (id, n, comp) in different components that may be similar by their bounds."""
    return bounded_pairs(written(weighed_tokens(nodes, sets, percent), "tokens"), percent, hot, depth)


def bounded_pairs(tokens: DataFrame, percent: int, hot: int = HOT, depth: int = DEPTH) -> DataFrame:
    """The same from the texts' weighed tokens.

    A path is the first tokens that two texts share, rarest first; ``missed`` is the weight that a text has before and
    between them, which the other lacks. What is left bounds the intersection from above, the path's own weight from
    below. Paths get longer by one token, ``depth`` times at most; after that they are compared as they are.
    """
    more = tokens.select("id", F.col("pos").alias("at"), "token", "w", "before")
    own = ["id", "n", "comp", "rest", "slack", "size"]
    rows = tokens.filter("before <= slack").select(*own, "pos", F.col("token").alias("path"), F.col("before").alias("missed"), (F.col("before") + F.col("w")).alias("upto"), F.lit(None).cast("long").alias("parent"))
    rows = written(rows, "paths")
    hub, found = F.min_by(F.struct("id", "n", "comp"), F.struct("n", "id")), []
    steps = F.sum(F.least(F.col("size") - F.col("pos"), F.col("slack") - F.col("missed") + 1))  # no fewer than the rows of longer paths
    for level in range(depth + 1):
        # texts of a path, and how many pairs of components the path makes: each text outside the largest one with every text
        parts = rows.groupBy("parent", "path", "comp").agg(F.count("*").alias("k"), hub.alias("hub"), steps.alias("steps"))
        groups = parts.groupBy("parent", "path").agg(F.sum("k").alias("c"), F.max("k").alias("most"), F.sum("steps").alias("steps"), F.min_by("hub", F.struct("hub.n", "hub.id")).alias("hub")).filter("c > most")
        groups = written(groups.withColumn("cost", F.col("c").cast("double") * (F.col("c") - F.col("most"))), "groups")
        wide = groups.filter((F.col("c") > hot) & (ROW_COST * F.col("steps") < F.col("cost")))
        longer, divided = None, groups.filter("false").select("path")
        if level < depth and not wide.isEmpty():
            longer = rows.join(wide.select("path"), "path", "left_semi").join(more, "id").withColumn("gap", F.col("missed") + F.col("before") - F.col("upto")).filter("at > pos and gap <= slack")
            longer = longer.select(*own, F.col("at").alias("pos"), F.xxhash64("path", "token").alias("path"), F.col("gap").alias("missed"), (F.col("before") + F.col("w")).alias("upto"), F.col("path").alias("parent"))
            longer = written(longer, "paths")
            sizes = longer.groupBy("parent", "path", "comp").count().groupBy("parent", "path").agg(F.sum("count").alias("c"), F.max("count").alias("most"))
            after = sizes.groupBy("parent").agg(F.sum(F.col("c").cast("double") * (F.col("c") - F.col("most"))).alias("after"))
            divided = written(wide.select("path", "hub", "cost").join(after.withColumnRenamed("parent", "path"), "path", "left").filter(F.coalesce("after", F.lit(0.0)) < F.col("cost")).select("path", "hub"), "divided")
        small = rows.join(groups.select("path"), "path", "left_semi").join(divided.select("path"), "path", "left_anti").select("path", "id", "n", "comp", (F.col("rest") - F.col("missed")).alias("left"))
        other = small.select("path", *[F.col(c).alias(f"{c}_") for c in ("id", "n", "comp", "left")])
        near = (F.col("id") < F.col("id_")) & (F.col("comp") != F.col("comp_")) & similar(F.least("left", "left_"), F.col("n") + F.col("n_"), percent)
        found.append(written(small.join(other, "path").filter(near).select(F.col("id").alias("a"), F.col("id_").alias("b")), "pairs"))
        if longer is None or divided.isEmpty():
            break
        sure = similar(F.col("upto") - F.col("missed"), F.col("n") + F.col("hub.n"), percent) & (F.col("comp") != F.col("hub.comp"))
        found.append(written(rows.join(divided, "path").filter(sure).select(F.col("id").alias("a"), F.col("hub.id").alias("b")), "sure"))
        rows = longer.join(divided.select(F.col("path").alias("parent")), "parent", "left_semi")
    return reduce(DataFrame.union, found).distinct()


#: Bits of a token's weight beside its hash in one number.
WEIGHT = 24


def by_tokens(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar by the weights of all the tokens they share.

    The weights add up to the intersection; hashes that fall together can only add to it. So few pairs but similar ones
    meet with their full sets. A text with a token too heavy for its bits keeps all its pairs.
    """
    most = (1 << WEIGHT) - 1
    code = F.shiftleft("token", WEIGHT).bitwiseOR(F.least(F.col("w"), F.lit(most)))
    own = written(tokens.groupBy("id").agg(F.first("n").alias("n"), F.collect_list(code).alias("codes"), F.max("w").alias("heaviest")), "codes")
    a, b = (own.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("codes").alias(f"c{x}"), F.col("heaviest").alias(f"h{x}")) for x in "ab")
    shared = F.aggregate(F.array_intersect("ca", "cb"), F.lit(0).cast("long"), lambda s, x: s + x.bitwiseAND(most))
    return pairs.join(a, "a").join(b, "b").filter((F.greatest("ha", "hb") >= most) | similar(shared, F.col("na") + F.col("nb"), percent)).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT, side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked at ``percent`` similarity, directly or by others."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = written(signatures(d, size, side, rows), "signatures")
    known = sig.filter("doc_id is not null and n > 0")
    classes = written(known.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "classes")
    copied = classes.filter("c > 1").select("fp", "rep")
    several = written(known.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "several")
    again = not several.isEmpty()  # ids with several rows: a set has a number of its own then, else its document's id
    one = known.join(classes.select(F.col("rep").alias("r"), F.col("fp").alias("f")), (F.col("doc_id") == F.col("r")) & (F.col("fp") == F.col("f")))
    one = one.dropDuplicates(["fp"]).withColumn("id", F.monotonically_increasing_id()) if again else one.withColumn("id", F.col("doc_id"))
    one = written(one.select("id", F.col("doc_id").alias("rep"), "n", "keys", "fp"), "one")

    def by_rep(links: DataFrame) -> DataFrame:
        """Links of sets as links of documents."""
        if not again:
            return links
        a, b = one.select(F.col("id").alias("a"), F.col("rep").alias("ra")), one.select(F.col("id").alias("b"), F.col("rep").alias("rb"))
        return links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))

    # hashes that two texts share, in both collections; score: with how many others a text shares hashes
    single = one.select("id", F.explode("keys").alias("key"))
    shared = single.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    live = single.join(shared, "key").groupBy("id").agg(F.min(F.col("key").bitwiseAND(1)).alias("lo"), F.max(F.col("key").bitwiseAND(1)).alias("hi"), F.sum("c").alias("score")).filter("lo = 0 and hi = 1").select("id", "score")
    live = written(one.join(live, "id"), "live")

    # full sets of these, and which of them could be similar to any other at all
    sets = full_sets(keep_ids(d, live.select(F.col("rep").alias("doc_id"))), size)
    sets = sets.join(live.select("id", "fp"), "fp").dropDuplicates(["id"]) if again else sets.withColumnRenamed("doc_id", "id")
    sets = written(sets.select("id", "s"), "sets")
    common = F.col("n") - F.coalesce("own", F.lit(0))
    fit = written(live.select("id", "rep", "n", "keys", "score").join(own_shingles(sets), "id", "left").filter(100 * common >= percent * F.col("n")).drop("own"), "fit")

    # the tables: every member against its bucket's hub
    firsts, seconds = F.slice("keys", 1, side), F.slice("keys", side + 1, side)
    table = F.flatten(F.transform(firsts, lambda x, i: F.transform(seconds, lambda y, j: F.xxhash64(x, y, i, j))))
    keyed = fit.select("id", "rep", "n", "score", F.explode(table).alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("c"), F.max_by("id", F.struct(F.col("score"), -F.col("id"))).alias("hub")).filter("c > 1").select("key", "hub")
    members = written(keyed.join(buckets, "key").filter("id <> hub").select("key", "id", "rep", "n", "hub"), "members")
    first = intersections(members.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), sets)
    links = by_rep(first.filter(similar(F.col("i"), F.col("t"), percent)).select("a", "b"))
    if again:  # an id with several texts is linked with the copies of each
        copies = known.join(several, "doc_id").join(copied, "fp").filter("doc_id <> rep")
        links = links.union(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    links = written(links, "confirmed")
    labels = connected(links)

    # what the first round left open
    at = join_small(members, labels.select(F.col("node").alias("rep"), "comp"), "rep").withColumn("comp", F.coalesce("comp", "rep"))
    open_ = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    nodes = written(at.join(open_, "key", "left_semi").select("id", "n", "comp").distinct(), "open")
    if not nodes.isEmpty():
        tokens = written(weighed_tokens(nodes, sets, percent), "tokens")
        more = by_rep(intersections(by_tokens(bounded_pairs(tokens, percent), tokens, percent), sets).filter(similar(F.col("i"), F.col("t"), percent)).select("a", "b"))
        more = written(more, "more")
        if not more.isEmpty():
            labels = connected(links.union(more))

    out = join_small(sig.select("doc_id", "n", "fp"), copied, "fp").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    out = join_small(out, labels.select(F.col("node").alias("rep"), "comp"), "rep").select("doc_id", "n", F.coalesce("comp", "rep").alias("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
