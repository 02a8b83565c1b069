"""Readers and helpers that no query needs: on small inputs."""

import json

from pyspark.sql import functions as F

from tidemark.functions import events, text, times
from tidemark.sources import files, tables


def test_json_index(spark, tmp_path):
    lines = [{"param": "2t", "levtype": "sfc", "number": "3", "step": "6", "_offset": 100, "_length": 50}, {"param": "tp", "levtype": "sfc", "step": "0-6", "_offset": 150, "_length": 1}]
    (tmp_path / "run.index").write_text("\n".join(map(json.dumps, lines)))
    got = [tuple(r) for r in files.json_index(spark, f"{tmp_path}/run.index").collect()]
    assert got == [("2t", "sfc", 3, 6, 100, 149, "run.index"), ("tp", "sfc", None, None, 150, 150, "run.index")]


def test_listing_and_ids(spark):
    xml = spark.createDataFrame([("<L><Contents><Key>a/b.idx</Key><Size>12</Size></Contents><Contents><Key>c</Key><Size>0</Size></Contents></L>",), ("<L/>",)], "page string")
    assert sorted(tuple(r) for r in files.listing(xml, "page").collect()) == [("a/b.idx", 12), ("c", 0)]
    page = "202501020304-KOKX-FXUS61-AFDOKX x 202501010304-KOKX-FXUS61-AFDOKX 202501010304-KOKX-FXUS61-AFDOKX-AAA 202501010304-KOKX-CDUS41-CLINYC"
    got = spark.range(1).select(text.product_ids(F.lit(page), "AFDOKX").alias("x")).first()["x"]
    assert got == ["202501010304-KOKX-FXUS61-AFDOKX", "202501010304-KOKX-FXUS61-AFDOKX-AAA", "202501020304-KOKX-FXUS61-AFDOKX"]


def test_times(spark):
    got = spark.createDataFrame([("Tue, 01 Jul 2025 04:05:06 GMT",), ("never",), (None,)], "x string").select(F.unix_seconds(tables.http_last_modified(F.col("x"))).alias("t")).collect()
    assert [r["t"] for r in got] == [1751342706, None, None]
    assert times.blocks("2025-07-01", 4) == ["2025-07-01", "2025-01-01", "2024-07-01", "2024-01-01"]


def test_points_and_bytes(spark, tmp_path):
    spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, flag boolean").write.parquet(f"{tmp_path}/p")
    d = tables.primary_points(spark.read.parquet(f"{tmp_path}/p"), "flag")
    assert [r["i"] for r in d.collect()] == [1]
    assert "EqualTo(flag,true)" in d._jdf.queryExecution().toString()
    b = spark.createDataFrame([(1000, 10, 7), (5, 0, 7)], "total bigint, items bigint, planned bigint").select(events.relevant_bytes(F.col("total"), F.col("items"), F.col("planned")).alias("b")).collect()
    assert [r["b"] for r in b] == [700.0, None]
