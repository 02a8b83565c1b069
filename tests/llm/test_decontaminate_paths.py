"""Decontamination gives the same rows whether the patterns are broadcast, are a table, or are dealt in parts."""

import random

import pytest

from tidemark.llm import decontaminate

PATHS = [{}, {"block_bytes": 0}, {"block_bytes": 0, "part": 7}]


def tables(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(n)) for n in (40, 12, 10, 9, 3, 25)]
    items = [*[(f"q{i}", t) for i, t in enumerate(texts)], ("same", texts[0]), (None, texts[5]), ("null", None), ("empty", " ")]
    filler = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    rows = [(i, f"{filler(i)} {rng.choice(texts)[i % 20 :]} {filler(5)}") for i in range(60)] + [(70, None), (71, ""), (None, texts[1]), (72, texts[3].upper()), (72, "clean"), (73, filler(30_000) + " " + texts[2])]
    docs = spark.createDataFrame([(*r, 7, "x", "y", 1) for r in rows], "doc_id bigint, text string, digest__ int, `a.b` string, items string, row int").repartition(3)
    return docs, spark.createDataFrame(items, "item_id string, text string")


@pytest.fixture(scope="module")
def results(spark):
    docs, bench = tables(spark)
    sort = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    return docs, [(decontaminate.clean_documents(docs, bench, **p).columns, sort(decontaminate.clean_documents(docs, bench, **p)), sort(decontaminate.contamination(docs, bench, **p))) for p in PATHS]


def test_all_paths_agree(results):
    docs, (first, *others) = results
    assert first[0] == docs.columns
    assert 10 < len(first[1]) < 60
    assert all(r[2:] == (7, "x", "y", 1) for r in first[1])
    for other in others:
        assert other == first


def test_few_windows_pass_by_chance(spark):
    rng = random.Random(5)
    words = [b"w%x" % rng.randrange(1 << 20) for _ in range(5000)]
    patterns = [b" ".join(rng.choice(words) for _ in range(10)) for _ in range(30_000)]
    frame = spark.createDataFrame([(10, decontaminate.pattern_hash(p), bytearray(p)) for p in patterns], "m int, h bigint, w binary")
    t = decontaminate.Tables.of(frame)
    assert len(t.bits) * 8 < 32 * 2 * len(patterns)
    text = [rng.choice(words) for _ in range(60_000)]
    assert sum(1 for _ in t.find(text)) < 60
    at = 1000
    text[at : at + 10] = patterns[17].split()
    assert any(start == at for start, *_ in t.find(text))
