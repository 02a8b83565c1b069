"""The pipeline against its stages in plain Python."""

import random

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import secret_scan

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def folder(spark, path):
    rng = random.Random(8)
    items = [(f"q{i}", sentence(rng, 30)) for i in range(4)]
    rows = [(i, sentence(rng, rng.choice([20, 80, 120])), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " extra words", "en", "s1") for i in range(10)]
    rows += [(200 + i, sentence(rng, 60) + " " + items[i % 4][1], "en", "s2") for i in range(5)]
    rows += [(300, sentence(rng, 70) + " password = hunter2222 " + sentence(rng, 5), "en", "s0"), (301, None, "en", None), (302, "a b " * 60, "en", "s0")]
    rows += [(400 + i, "too short", "en", "junk") for i in range(30)] + [(450, sentence(rng, 90), "en", "junk")]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, items


def test_pipeline(spark, tmp_path):
    rows, items = folder(spark, tmp_path)
    text = {r[0]: r[1] for r in rows}
    source = {r[0]: r[3] for r in rows}
    good = {d for d, t in text.items() if not brute.quality(t)[5] and source[d] != "junk"}  # the host goes with its pages
    comp, _ = brute.components([(d, text[d]) for d in sorted(good)], 80)
    kept = {d for d in good if comp[d] == d}
    clean = {d for d in kept if not brute.hits(text[d], items)[4]}
    assert len(clean) < len(kept) < len(good) < len(text)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == clean
    hidden = {r["doc_id"]: r["text"] for r in secret_scan.redacted(spark.createDataFrame([(d, text[d]) for d in clean], "doc_id bigint, text string")).collect()}
    assert "hunter2222" not in hidden[300] and "[SECRET]" in hidden[300]
    sizes = {d: len(brute.WORD.findall(t)) for d, t in hidden.items()}
    total = {}
    for d in clean:
        total[source[d]] = total.get(source[d], 0) + sizes[d]
    want = brute.targets(total)
    for d, r in got.items():
        assert r["size"] == sizes[d] and abs(r["target"] - want[source[d]]) < 1e-6 and r["taken"] <= 2 * r["size"]


def test_stages_keep_the_columns(spark, tmp_path):
    folder(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).isEmpty()
    assert docs.filter(F.col("text").isNull()).count() == 1
