"""The decontamination stage on rows with null and repeated ids."""

import corpus_pipeline

from tidemark.llm import decontaminate

ITEMS = [(f"q{k}", " ".join(f"w{k}x{i}" for i in range(12))) for k in range(4)]
ROWS = [(None, f"before {ITEMS[0][1]} after", "a"), (None, "clean", "b"), (5, f"it says {ITEMS[1][1]}", "c"), (5, "clean too", "d"), (5, None, "e"), (6, ITEMS[3][1], "f"), (7, "", "g"), (7, "clean", "h"), (7, "clean", "h")]


def test_rows_are_judged_by_their_own_text(spark, tmp_path):
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string").repartition(3)
    kept = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(r["source"] for r in kept.collect()) == list("bdeghh")
    blocks = decontaminate.clean_documents(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet"), block_bytes=100)
    assert sorted(r["source"] for r in blocks.collect()) == list("bdeghh")
