"""What has to hold on a cluster: no gap in rewrites, files in pieces, keys in buckets, no machine-local folder."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, windows
from tidemark.sources import sinks



def test_a_rewrite_leaves_a_table_at_every_moment(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    sinks.replaced(spark, spark.read.parquet(path).withColumn("x", F.col("id") * 2), path)
    assert spark.read.parquet(path).agg(F.sum("x")).first()[0] == 90
    # a job that died after the old table was moved aside: the next call finds it again
    (tmp_path / "t").rename(tmp_path / "t.__old")
    jvm = spark.sparkContext._jvm
    old, before = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.__old"))
    sinks.restored(old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), old, before)
    assert spark.read.parquet(path).count() == 10 and not (tmp_path / "t.__old").exists()


def test_large_files_are_hashed_in_pieces(spark, tmp_path):
    data = {f"f{i}": random.Random(i).randbytes(1000 * i) for i in range(1, 6)}
    for name, raw in data.items():
        (tmp_path / name).write_bytes(raw)
    for limit in (0, 2000, 1 << 20):
        got = {r["file"]: (r["bytes"], r["sha256"]) for r in sinks.file_hashes(spark, str(tmp_path), whole_bytes=limit).collect()}
        assert got == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in data.items()}


def test_predecessors_do_not_depend_on_the_bucket(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(0, 4000, 7)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t long, i long")
    want = {}
    last = {}
    for k, t, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want[i], last[k] = last.get(k), i
    for bucket in (10, 500, 10**9):
        got = {r["i"]: r["b"] for r in asof.with_predecessor(df, ["k"], "t", ["i"], bucket).select("i", F.col("__before.i").alias("b")).collect()}
        assert got == want


def test_running_sums_do_not_depend_on_the_width(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b"]), i, rng.choice([None, 1, 2, -3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    want, total = {}, {}
    for k, o, v in rows:
        total[k] = total.get(k, 0) + (v or 0)
        want[o] = total[k]
    for width in (1, 17, 1000):
        assert {r["o"]: r["s"] for r in windows.prefix_sum(df, ["k"], "o", F.col("v"), "s", width).collect()} == want


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getConf():  # noqa: N802
            return {}

    class Session:
        sparkContext = Context  # noqa: N815

    with pytest.raises(ValueError, match="checkpoint"):
        sinks.shared_dir(Session)


def test_cursors_and_the_fallback(monkeypatch):
    import sys
    import types

    from tidemark.sources import connector

    feed = types.ModuleType("feed")
    calls = []

    def live(key, cursor, options):
        calls.append((key, cursor))
        if key == "old":
            raise connector.TransportError(404)
        at = int(cursor or 0)
        return [(key, str(at + i)) for i in range(2)], str(at + 2) if at < 4 else ""

    feed.live, feed.archive, feed.stuck = live, lambda key, cursor, options: ([(key, "kept")], None), lambda key, cursor, options: ([], "same")
    monkeypatch.setitem(sys.modules, "feed", feed)
    reader = connector.CursorReader({"keys": "a,old", "transport": "feed:live", "fallback": "feed:archive"})
    got = [row for p in reader.partitions() for row in reader.read(p)]
    assert got == [("a", str(i)) for i in range(6)] + [("old", "kept")] and calls == [("a", None), ("a", "2"), ("a", "4"), ("old", None)]
    assert list(connector.CursorReader({"keys": "old", "transport": "feed:live"}).read(connector.Key("old"))) == []
    with pytest.raises(RuntimeError, match="twice"):
        list(connector.CursorReader({"keys": "x", "transport": "feed:stuck"}).read(connector.Key("x")))
