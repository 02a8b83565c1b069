"""Quantiles and ranks of groups that no buffer and no window holds."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins, stats, windows

POINTS = [0.0, 0.1, 1 / 3, 0.5, 0.9, 0.99, 1.0]


def rows():
    """Ten groups, one with nine rows of ten; ties, nulls, NaN, huge and tiny numbers."""
    rng = random.Random(3)
    out = []
    for i in range(6000):
        g = "hot" if i % 10 else rng.choice(["a", "b", "c", "d", "e", "f", "g", None, "one"])
        v = rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 10), float(rng.randrange(5)), 1e-9 * rng.random(), -1e300 * rng.random()])
        out.append((g, v, i))
    return out + [("null", None, 6001), ("hot", None, 6002), ("one-only", 4.5, 6003), ("nan", float("nan"), 6004), ("same", 7.0, 6005), *[("same", 7.0, 6006 + i) for i in range(200)]]


@pytest.fixture(scope="module")
def df(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("q") / "t")
    spark.createDataFrame(rows(), "g string, v double, i long").repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("buffer", [10, 150, 100_000])
def test_quantiles(df, buffer, monkeypatch):
    monkeypatch.setattr(stats, "BUCKETS", 64)
    real = df.filter("v is not null and not isnan(v)")
    want = {r["g"]: (r["n"], r["q"]) for r in real.groupBy("g").agg(F.count("*").alias("n"), stats.percentiles("v", POINTS).alias("q")).collect()}
    got = {r["g"]: (r["n"], r["q"]) for r in stats.quantiles(df, ["g"], "v", POINTS, buffer).collect()}
    assert got == want
    one = stats.quantiles(df, [], "v", POINTS, buffer).collect()
    assert [r["q"] for r in one] == [r["q"] for r in real.agg(stats.percentiles("v", POINTS).alias("q")).collect()]


def test_ranks(df):
    data = [r for r in rows() if r[1] is not None and r[1] == r[1]]
    real = df.filter("v is not null and not isnan(v)")
    want, sizes = {}, {}
    for g in {r[0] for r in data}:
        own = sorted((r[1], r[2]) for r in data if r[0] == g)
        sizes[g] = len(own)
        want |= {i: k for k, (_, i) in enumerate(own)}
    got = windows.ranked(real, ["g"], ["v", "i"]).collect()
    assert {r["i"]: r["rank"] for r in got} == want
    assert all(r["n"] == sizes[r["g"]] for r in got)
    assert windows.ranked(real.limit(0), ["g"], ["v"]).collect() == []


def test_average_ranks_and_samples(df):
    real = df.filter("v is not null and not isnan(v)")
    got = {r["i"]: r["r"] for r in stats.average_rank(df.filter("v is null or not isnan(v)"), ["g"], "v", "r").collect()}
    data = [r for r in rows() if r[1] is not None and r[1] == r[1]]
    for g, v, i in data[::97]:
        own = [r[1] for r in data if r[0] == g]
        assert got[i] == sum(x < v for x in own) + (own.count(v) + 1) / 2
    assert got[6001] is None
    picked = windows.rank_sample(real.filter("g = 'hot'"), ["g"], ["v", "i"], 5).collect()
    n = real.filter("g = 'hot'").count()
    assert sorted(r["rank"] for r in picked) == [round(k * (n - 1) / 4) for k in range(5)]
    middle = joins.nearest_by_rank(real, ["g"], ["v", "i"], (F.col("n") - 1) / 2, F.col("i") % 3 == 0)
    assert middle.filter("g = 'hot'").count() == 1
