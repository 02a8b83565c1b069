"""Recorded streams with a clock, and byte ranges."""

import random

from pyspark.sql import functions as F

from tidemark.sources import recorded
from tidemark.streaming import recorder

S = 1_000_000
ROW = "k string, ts timestamp, closes bigint, type string, segment int"


def played(spark, tmp_path, rows, wait="0 seconds", grace_ms=10_000, upto=None, name="a"):
    """``rows``: (key, second, closing second, segment)."""
    m = spark.createDataFrame([(k, t * S, c * S, "row", s) for k, t, c, s in rows], "k string, t bigint, closes bigint, type string, segment int").withColumn("ts", F.timestamp_micros("t")).drop("t")
    n = recorded.record(m, F.col("segment"), f"{tmp_path}/{name}", "k")
    stream = recorder.replayed(spark, f"{tmp_path}/{name}", upto or n, "k string, ts timestamp, closes bigint, type string", f"{tmp_path}/{name}-progress")
    return recorder.drained(recorder.recordings(recorder.clocked(stream, "ts", wait), "k", grace_ms), f"{tmp_path}/{name}-stream")


def test_a_recording_ends_by_the_clock_and_its_state_goes(spark, tmp_path):
    rows = [("a", 100, 110, 0), ("a", 105, 110, 0), ("b", 90, 500, 0), ("c", 119, 300, 0), ("a", 112, 110, 1), ("z", 121, 200, 1), ("a", 113, 110, 2), ("b", 400, 500, 2), ("z", 9000, 9100, 3), ("b", 401, 500, 4), ("z", 99_000, 9100, 5)]
    done, left = played(spark, tmp_path, rows)
    got = {r["key"]: (r["n"], r["late"], r["first"], r["last"]) for r in done.groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_late").alias("late"), (F.min("first_us") / S).alias("first"), (F.max("last_us") / S).alias("last")).collect()}
    # segment 1 is read with the clock at 119, before a's end at 120; segment 2 with the clock at 121
    assert got["a"] == (3, 1, 100, 112)
    assert got["b"] == (2, 1, 90, 400)
    assert got["c"] == (1, 0, 119, 119)
    assert sum(x["rows"] for x in left) == 0
    assert [r["n"] for r in done.filter("key = 'a' and n > 0").collect()] == [3]


def test_a_patient_clock_calls_nothing_late(spark, tmp_path):
    rows = [("a", 100, 110, 0), ("b", 4000, 9000, 1), ("a", 101, 110, 2)]
    done, left = played(spark, tmp_path, rows, wait="2 hours")
    assert done.filter("n_late > 0").isEmpty()
    assert sum(x["rows"] for x in left) > 0


def test_a_stream_goes_on_where_it_was_stopped(spark, tmp_path):
    rng = random.Random(4)
    m = spark.createDataFrame([(f"m{rng.randrange(45)}", i, rng.randrange(6)) for i in range(900)], "market_ticker string, i bigint, segment int")
    n = recorded.record(m, F.col("segment"), f"{tmp_path}/r")
    for upto, step in ((2, 1), (3, 2), (n, 2), (n, 1)):
        stream = recorder.replayed(spark, f"{tmp_path}/r", upto, "market_ticker string, i bigint", f"{tmp_path}/p", step)
        done, _ = recorder.drained(stream, f"{tmp_path}/s")
        assert sorted(r["i"] for r in done.collect()) == sorted(r["i"] for r in m.filter(F.col("segment") < upto).collect())
    assert done.select("batch").distinct().count() >= 4


def test_twenty_markets_to_a_chunk(spark):
    names = spark.createDataFrame([(f"m{i:03d}",) for i in range(45)] * 2, "market_ticker string")
    sizes = sorted(r["count"] for r in recorded.chunk_of(names).groupBy("chunk").count().collect())
    assert sizes == [5, 20, 20]


def test_ranges(spark, tmp_path):
    rng = random.Random(9)
    raw = rng.randbytes(50_000)
    (tmp_path / "data").write_bytes(raw)
    plan = [(s, s + rng.randrange(1, 900)) for s in (rng.randrange(49_000) for _ in range(60))] + [(0, 0), (49_999, 49_999)]
    frame = spark.createDataFrame([(f"{tmp_path}/data", a, b) for a, b in plan + plan[:3]], "file string, start bigint, end bigint")
    requests = {}
    for gap in (0, 2000):
        got = recorded.read_ranges(frame, f"{tmp_path}/plan{gap}", gap=gap).collect()
        assert sorted((r["start"], r["end"], bytes(r["bytes"])) for r in got) == sorted({(a, b, raw[a : b + 1]) for a, b in plan})
        requests[gap] = {(r["from"], r["to"]) for r in got}
    covered = set().union(*[range(a, b + 1) for a, b in plan])
    assert sum(b - a + 1 for a, b in requests[0]) == len(covered)  # no byte is read in vain, none twice
    assert len(requests[2000]) < len(requests[0]) < len(set(plan))
