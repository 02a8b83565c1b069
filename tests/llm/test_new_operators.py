"""M-trees, Merkle manifests and fill-in-the-middle against plain Python, with every odd case."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import fill_in_middle, merkle, metric_tree

TEXTS = [None, "", "a", "x<P>y", "<S", "no mark <X> here < S>", "line\nline\n\nthird", "\n", "größe 😀 straße\nend", "word " * 30_000, "one two", "one two"]


def rows():
    rng = random.Random(3)
    out = [(i, t, None if i % 5 == 0 else "en", None if i in (2, 3) else f"src{'é' if i % 3 else ''}{i % 4}", None if i == 4 else i, 1, "o") for i, t in enumerate(TEXTS)]
    out += [(100 + i, " ".join(rng.choice(["ab", "c\nd", "é", "<M"]) for _ in range(rng.randrange(40))), "de", "hot", i, 1, "o") for i in range(150)]
    out += [(None, "null id", "en", "hot", 1, 1, "o"), (None, "null id 2", "en", None, 1, 1, "o"), (7, "again\n", "en", "hot", 1, 1, "o"), (7, "again\n", "en", "hot", 1, 1, "o"), (7, "other", "en", "hot", 1, 1, "o")]
    return out


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, `a.b` string"
CLASH = {"row": "leaf", "a.b": "draws.x"}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_manifest(table):
    def leaf_of(r, text):
        vals = (r[0], r[3], r[2], r[4], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))

    trees = defaultdict(list)
    for r in table:
        trees[r[3]].append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))

    def climb(nodes, place):
        path = []
        while len(nodes) > 1:
            run = place // 3 * 3
            path.append((nodes[run:place], nodes[place + 1 : run + 3]))
            nodes, place = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)], place // 3
        return nodes[0], path

    subs = [climb([x[2] for x in sorted(trees[s], key=lambda x: x[:3])], 0)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        own = sorted(trees[s], key=lambda x: x[:3])
        for i, (_, _, leaf, r) in enumerate(own):
            sub, low = climb([x[2] for x in own], i)
            root, high = climb(subs, k)
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            folded = leaf_of(r, r[1] and r[1].replace("\n", "")) if even else leaf
            for a, b in low + high:
                folded = sha("".join(a) + folded + "".join(b))
            out.append((r[0], leaf, sub, root, sha("".join(x for a, b in low + high for x in a + b)), folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("nodes", [merkle.NODES, 5])
def test_manifest(docs, nodes, monkeypatch):
    monkeypatch.setattr(merkle, "NODES", nodes)
    want = brute_manifest(rows())
    assert sorted((tuple(r) for r in merkle.digest(docs).collect()), key=repr) == want
    assert {w[-1] for w in want} == {True, False}


def test_manifest_of_little(spark, docs):
    assert merkle.digest(docs.limit(0)).collect() == []
    one = [rows()[4]]
    assert [tuple(r) for r in merkle.digest(spark.createDataFrame(one, SCHEMA)).collect()] == brute_manifest(one)
    nine = [(i, "t", "en", f"s{i}", 1, 1, "") for i in range(10)]  # a tree of sources only
    assert sorted((tuple(r) for r in merkle.digest(spark.createDataFrame(nine, SCHEMA)).collect()), key=repr) == brute_manifest(nine)


def brute_middle(doc_id, text):
    text = text or ""
    x = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or h[2] % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b, c = text[:i], text[i:j], text[j:]
    form, out = ("spm", f"<S>{c}<P>{a}<M>{b}") if h[3] % 100 < 20 else ("psm", f"<P>{a}<S>{c}<M>{b}")
    return doc_id, n, form, i, j - i, sha(out), sha(text)


def test_middle(docs):
    want = sorted((brute_middle(r[0], r[1]) for r in rows()), key=repr)
    assert sorted((tuple(r) for r in fill_in_middle.digest(docs).collect()), key=repr) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_in_middle.digest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("unit", ["word", "line"])
def test_middle_of_other_units(docs, unit):
    t = fill_in_middle.transformed(docs, unit)
    back = t.withColumn("back", fill_in_middle.restored(t["output"], t["form"])).collect()
    assert sorted((tuple(r["row"]) for r in back), key=repr) == sorted(rows(), key=repr)
    for r in back:
        text = r["row"]["text"] or ""
        assert r["back"] == text
        if r["form"] == "plain":
            continue
        for at in (r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]):
            if 0 < at < len(text):
                left, right = text[at - 1], text[at]
                assert left == "\n" if unit == "line" else (left.isspace() != right.isspace() or left.isalnum() != right.isalnum())


def test_bytes_that_are_no_text(spark):
    odd = spark.sql("select 5 as doc_id, cast(unhex('41FF42C3') as string) as text union all select 6, cast(unhex('E28282F0') as string)")
    t = fill_in_middle.transformed(odd)
    got = t.selectExpr("row.doc_id", "hex(cast(row.text as binary)) as a", "n_units", "hex(cast(output as binary)) as o", "form").collect()
    assert sorted((r["doc_id"], r["n_units"]) for r in got) == [(5, 4), (6, 2)]
    assert all(r["a"] in r["o"] if r["form"] == "plain" else len(r["o"]) == len(r["a"]) + 18 for r in got)


def brute_nearest(table, k=10):
    def of(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(1024.0 * float(x))) for x in v]

    known = {}
    for i, v in table:
        if (w := of(v)) is not None:
            while w and w[-1] == 0:
                w.pop()
            known[(i, tuple(w))] = None
    out = []
    for qi, q in known:
        if qi is None or qi % 100:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i or 0) for i, v in known if (i, v) != (qi, q))[:k]  # noqa: B905
        out += [(qi, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(found)]
    return sorted(out, key=repr)


def vectors(seed, n=600, d=6, kinds=8):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(kinds, d))
    data = (base[rng.integers(kinds, size=n)] + 0.1 * rng.normal(size=(n, d))).astype("f4")
    data[n // 2 : n // 2 + n // 3] = data[0]  # a third of all rows is one vector
    table = [(int(i), [float(x) for x in v]) for i, v in enumerate(data)]
    return table + [(700, None), (800, [1.0, None]), (900, [float("nan"), 1.0]), (1000, [float("inf")]), (1100, []), (1200, [0.5, -0.25]), (1300, [0.5, -0.25, 0.0]), (None, [float(x) for x in data[0]]), (None, [9.0, 9.0]), (0, [float(x) for x in data[0]]), (100, [1.0, 2.0, 3.0]), (-200, [-1.0] * d)]


FRAME = "vec_id bigint, embedding array<float>, a int, found string, `v.x` int"


@pytest.mark.parametrize("limits", [{}, {"tree": 40, "regions": 4}, {"tree": 40, "regions": 4, "leaf": 5, "block": 12}])
def test_nearest(spark, limits, monkeypatch):
    if "leaf" in limits:
        monkeypatch.setattr(metric_tree, "LEAF", limits.pop("leaf"))
        monkeypatch.setattr(metric_tree, "BLOCK_VALUES", limits.pop("block"))
    table = vectors(4)
    df = spark.createDataFrame([(*r, 1, "f", 2) for r in table], FRAME).repartition(3)
    got = metric_tree.nearest(df, **limits).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_nearest(table)


def test_nearest_of_little(spark):
    for table in ([], [(5, [1.0])], [(100, [1.0])], [(100, [0.0]), (200, [0.0])], [(100, None)]):
        df = spark.createDataFrame([(*r, 1, "f", 2) for r in table], FRAME)
        assert sorted((tuple(r) for r in metric_tree.nearest(df).collect()), key=repr) == brute_nearest(table)


def test_products_beyond_doubles(spark):
    table = [(i, [float(np.float32(2.0**20 + i % 7)), float(np.float32(1.5 * 2**18 + i % 5))]) for i in range(300)]
    df = spark.createDataFrame([(*r, 1, "f", 2) for r in table], FRAME)
    assert metric_tree.index(df).m2 > metric_tree.EXACT
    assert sorted((tuple(r) for r in metric_tree.nearest(df).collect()), key=repr) == brute_nearest(table)
    wild = spark.createDataFrame([(100, [3e38, 3e38], 1, "f", 2), (1, [3e38, 1.0], 1, "f", 2)], FRAME)
    assert [r["score"] for r in metric_tree.nearest(wild).collect()] == [np.iinfo(np.int64).max]


def test_bounds_spare_products(spark):
    """On rows that lie in groups, stored distances and radii leave most products uncomputed."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(64, 4)) * 4
    v = np.floor(base[rng.integers(64, size=8000)] * 100 + 20 * rng.normal(size=(8000, 4)))
    m2 = float(np.einsum("ij,ij->i", v, v).max())
    pages = metric_tree.pages_of(0, 0, v, pa.array([[i] for i in range(len(v))], pa.list_(pa.int64())), v[0], m2, True, 16)
    tree = metric_tree.Tree(pages, m2, metric_tree.MARGIN * m2**0.5, True, 11)
    q = v[::100]
    to_root = metric_tree.apart(np.hstack([q, np.zeros((len(q), 1))]), metric_tree.augmented(v[:1], m2))[:, 0]
    best, visited, computed = tree.search(q, np.full(len(q), -np.inf), to_root)
    scores = q @ v.T
    for i, b in enumerate(best):
        assert [(-x[0], x[3]) for x in b] == [(int(scores[i, j]), int(j)) for j in np.lexsort((np.arange(len(v)), -scores[i]))[:11]]
    assert computed.mean() < 0.4 * len(v)
    assert visited.mean() < 0.6 * pages.num_rows
