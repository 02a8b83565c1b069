"""Findings of the fourth round: each test fails on the code before."""

import datetime as dt
import random

import pyarrow as pa
from pyspark.sql import functions as F
from test_round3 import events_at, odd_events, same_as_sql

from tidemark.plans import recorder_queries, registry
from tidemark.streaming import recorder


def repeated_month(n: int = 420) -> list[tuple]:
    """Times go back three times; a market has several messages a day and a few at one time."""
    rng, kinds = random.Random(11), ("signup", "click", "view", "error", "purchase")
    return [(i, 6000 * (i % (n // 3)) // 7 * 7, rng.randrange(6), rng.choice(kinds), float(rng.randrange(60))) for i in range(n)]


def test_checkpoints_of_times_that_go_back(spark, tmp_path, monkeypatch):
    """a day's checkpoint is the book after its last message to arrive, in segments of 90 messages too."""
    monkeypatch.setattr(recorder_queries, "BATCH", 90)
    same_as_sql(spark, events_at(spark, tmp_path, repeated_month()), "stream_book_checkpoints", registry.oracle_sql()["stream_book_checkpoints"], "events")


def test_checkpoints_before_1970_and_without_a_time(spark, tmp_path):
    """intervals are numbered as in SQL; messages without a time have a checkpoint of their own."""
    rows = [(i, dt.datetime(1969, 12, 30) + dt.timedelta(hours=i) if i % 9 else None, i % 3, "signup" if i % 10 == 0 else "view", float(i * 7 % 60), "{}") for i in range(120)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    same_as_sql(spark, str(tmp_path), "stream_book_checkpoints", registry.oracle_sql()["stream_book_checkpoints"], "events")


def test_a_subscription_gets_blocks(spark):
    """a row for each task and subscription, whatever the number of messages; rows keep their order and nulls."""
    m = spark.range(0, 9000, 1, 3).select(F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("sid"), F.col("id").alias("ord"), F.when(F.col("id") % 2 == 0, F.array(F.lit("a"))).alias("levels"))
    got = recorder.blocks(m, "sid").collect()
    assert len(got) == 15
    rows = [(r["sid"], x) for r in got for x in pa.ipc.open_stream(r["block"]).read_all().to_pylist()]
    assert sorted(x["ord"] for _, x in rows) == list(range(9000))
    assert all(x["sid"] == s == (x["ord"] % 5 or None) and x["levels"] == (["a"] if x["ord"] % 2 == 0 else None) for s, x in rows)


def test_requests_of_times_that_go_back(spark, tmp_path):
    """requests follow time, and all messages of a request's time ask."""
    same_as_sql(spark, events_at(spark, tmp_path, repeated_month()), "stream_snapshot_requests", registry.oracle_sql()["stream_snapshot_requests"], "events")


def test_pairs_with_unknown_quotes_are_eligible(spark, tmp_path):
    """no event here shares its second with another of its user."""
    same_as_sql(spark, odd_events(spark, tmp_path, "value"), "zero_volume_changes", registry.oracle_sql()["zero_volume_changes"], "events")


def test_every_point_looks_for_its_nearest(spark, tmp_path):
    """ids that aren't divisible by ten too."""
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(1, 300) if i % 10]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    same_as_sql(spark, str(tmp_path), "haversine_nearest_point", registry.oracle_sql()["haversine_nearest_point"], "embeddings")
