"""The extraction harness, the point index and the table function."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.sources import extraction, sinks


def test_failures_are_rows_and_resume_leaves_out_the_rest(spark):
    def worker(item):
        if item["i"] == 3:
            raise OSError("gone")
        return [{"h": item["i"] * 10 + k, "v": float(k)} for k in range(2)], 100

    work = spark.range(5).select(F.col("id").alias("i"), F.lit("x").alias("source"))
    r = extraction.extracted(work, worker, "h long, v double", 2).cache()
    assert sorted((x["i"], x["status"], x["attempts"]) for x in r.collect()) == [(0, "ok", 1), (1, "ok", 1), (2, "ok", 1), (3, "failed", 3), (4, "ok", 1)]
    assert "gone" in r.filter("i = 3").first()["error"]
    rows = extraction.exploded(r, ["i", "source"])
    assert rows.count() == 8 and rows.columns == ["i", "source", "h", "v"]
    left = work.join(sinks.done_table(r, ["i", "source"]), ["i", "source"], "left_anti")
    assert [x["i"] for x in left.collect()] == [3]
    assert {x["status"]: (x["items"], x["n_rows"]) for x in extraction.report(r).collect()} == {"ok": (4, 8), "failed": (1, 0)}
    assert extraction.extracted(work.limit(0), worker, "h long, v double", 2).isEmpty()


def test_point_index():
    calls = []

    def search(grid):
        calls.append(grid)
        return [(grid, 3.0)]

    p = extraction.PointIndex(search, check_every=3)
    assert [p.of("a", 1) for _ in range(7)] == [[(1, 3.0)]] * 7 and len(calls) == 3
    p.of(None, 2), p.of(None, 2)
    assert len(calls) == 5
    with pytest.raises(ValueError, match="plausible"):
        extraction.PointIndex(lambda g: [(0, 17.0)]).of("b", 1)


def test_table_function_equals_the_expression(spark):
    t = ["HEAD\n.SYNOPSIS...\nfine\n\n.MARINE /AND SO ON/...\ncalm\n", "none", ".A...\nx"]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(t)], "i int, t string")
    spark.udtf.register("sections", extraction.Sections)
    d.createOrReplaceTempView("bulletins")
    a = spark.sql("SELECT i, s.* FROM bulletins, LATERAL sections(t) s").collect()
    b = text.sections(d, "t", ["i"]).select("i", "section_name", "section_text").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
