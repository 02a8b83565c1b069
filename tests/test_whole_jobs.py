"""Queries over whole tables: what a cut of rows or of text would miss."""

import hashlib
from datetime import datetime, timedelta, timezone

import pytest

from tidemark.plans import registry
from tidemark.streaming import runs


def run(spark, name, path):
    return registry.queries()[name](spark, str(path)).collect()


def test_bulletins_of_every_document_and_all_its_text(spark, tmp_path):
    far = "x" * 300 + "\n.SHORT TERM /LATE/...\nrain\n.MARINE...\nwaves"
    rows = [(3, far, "en"), (4, far, None), (5, None, "de"), (5, "a\u0001b\u0002c", "de"), (None, "short", "fr")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    s = [(r["doc_id"], r["section_name"], r["n_chars"]) for r in run(spark, "section_split_all", tmp_path)]
    for d in (3, 4):
        assert [x[1] for x in s if x[0] == d] == ["HEADER", "SYNOPSIS", "SHORT TERM /LATE/", "MARINE", "NEAR TERM /THROUGH TONIGHT/", "AVIATION /12Z/"]
        assert (d, "SYNOPSIS", 300) in s and (d, "MARINE", 5) in s
    assert sorted(x[2] for x in s if x[0] == 5 and x[1] == "SYNOPSIS") == [0, 3]
    assert (None, "SYNOPSIS", 5) in s and len(s) == 6 + 6 + 4 + 4 + 4
    f = [(r["doc_id"], r["forecaster"], r["n_relevant"]) for r in run(spark, "bulletin_forecaster_all", tmp_path)]
    assert sorted(f, key=str) == sorted([(3, "JC", 3), (4, "JC", 3), (5, "JC", 2), (5, "JC", 2), (None, "JC", 2)], key=str)


@pytest.mark.parametrize("name", ["stream_tumbling", "stream_timeline_usable"])
def test_streams_count_rows_of_older_files(spark, tmp_path, monkeypatch, name):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(h, start + timedelta(hours=h), 1, "click", float(h)) for h in range(96)]
    files = [rows[72:], rows[0:40:2], rows[40:72], rows[1:40:2]]  # the newest first; a day in two files
    for part, path in [(rows, "one"), *[(f, "many") for f in files]]:
        spark.createDataFrame(part, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{path}/events.parquet")
    want = sorted(run(spark, name, tmp_path / "one"))
    assert len(want) == 4
    stream = runs.table_stream
    monkeypatch.setattr(runs, "table_stream", lambda spark, folder, table: stream(spark, folder, table, files_per_batch=1))
    assert sorted(run(spark, name, tmp_path / "many")) == want


def test_files_stations_and_markets_of_all_rows(spark, tmp_path):
    docs = [(i, None if i == 7 else f"text {i}\nof two lines, ü") for i in range(1500)] + [(7, "again"), (None, "no id")]
    spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0], x[1] or "")):
        want.setdefault("part=none" if d is None else f"part={d // 1000}", []).append(((t or "") + "\n").encode())
    got = run(spark, "source_file_hashes_all", tmp_path)
    assert sorted(map(tuple, got)) == sorted((k, len(b := b"".join(v)), hashlib.sha256(b).hexdigest()) for k, v in want.items())
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    e = [(i, at + timedelta(minutes=i), i % 30, "click", float(i)) for i in range(120)]
    spark.createDataFrame(e, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(int(r["SOURCE"]) for r in run(spark, "source_station_csv_all", tmp_path)) == list(range(120))
    m = run(spark, "minute_coverage_all", tmp_path)
    assert len(m) == 10 and all(r["rows"] == 12 and r["all_have_candle"] == 1 for r in m)
