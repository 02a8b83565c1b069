"""Reports and labels, candles, order books, sidecar indexes, sources and sinks on small frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import grib, observations, text, times
from tidemark.operators import joins, labels, market, orderbook, stats
from tidemark.sources import connector, files, sinks
from tidemark.streaming import books

REPORT = "...THE CENTRAL PARK NY CLIMATE SUMMARY FOR {day}...\n{late}\nTEMPERATURE (F)\n {word}\n  MAXIMUM         {value}{flag}    230 PM 95\n  MINIMUM         {low}    500 AM\n"


def report(day="JULY 1 2025", value="80", flag="", low="61", late="", word="YESTERDAY"):
    return REPORT.format(day=day, value=value, flag=flag, low=low, late=late, word=word)


def parsed(spark, *reports):
    rows = [(f"{issued}-KOKX-CDUS41-CLINYC{x}", t) for issued, x, t in reports]
    return text.climate_report(spark.createDataFrame(rows, "product_id string, raw_text string"), "raw_text", "product_id")


def label(spark, *reports):
    return labels.canonical(parsed(spark, *reports)).first()


PRELIM = "VALID TODAY AS OF 0400 PM LOCAL TIME."


def test_report_fields(spark):
    r = parsed(spark, ("202507020600", "", report(value="96", flag="R"))).first()
    assert (r["target_date"], r["max_temp_f"], r["max_temp_flag"], r["max_temp_time_lst"], r["min_temp_f"], r["is_preliminary"]) == (dt.date(2025, 7, 1), 96.0, "R", "230 PM", 61.0, False)
    assert parsed(spark, ("202507020600", "", report(value="MM"))).first()["max_temp_f"] is None
    for bad in (report(value="999"), report(day="JULLY 1 2025"), "nothing", report().replace("MAXIMUM", "HIGHEST"), None):
        r = parsed(spark, ("202507020600", "", bad)).first()
        assert r["parse_error"] and r["max_temp_f"] is None and r["target_date"] is None


def test_label_rules(spark):
    final = ("202507020600", "", report())
    r = label(spark, ("202507012000", "", report(value="78", late=PRELIM, word="TODAY")), final)
    assert (r["label_f"], r["label_status"], r["report_status"], r["n_preliminary_rejected"]) == (80.0, "OK", "FINAL", 1)
    r = label(spark, final, ("202507020900", "", report()))
    assert (r["report_status"], r["product_id"]) == ("FINAL_REISSUED", "202507020900-KOKX-CDUS41-CLINYC")
    assert label(spark, final, ("202507020900", "", report(value="82")))["report_status"] == "FINAL_CORRECTED"
    assert label(spark, ("202507012000", "", report(late=PRELIM)))["label_status"] == "LABEL_UNAVAILABLE_CLINYC"
    assert label(spark, ("202507010600", "", report()))["selection_error"] == "issued on or before its own day"
    assert label(spark, final, ("202507020600", "-CCA", report(value="81")))["selection_error"] == "irreducible tie"
    assert label(spark, final, ("202507020900", "", report(value="MM")))["selection_error"] == "retracted value"
    dates = spark.createDataFrame([(dt.date(2025, 7, 9),)], "target_date date")
    assert labels.canonical(parsed(spark, final), dates).first()["n_final_candidates"] == 0


def test_labels_attach_once(spark):
    f = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "target_date int, c string")
    one = spark.createDataFrame([(1, 80.0)], "target_date int, label_f double")
    again = labels.attach(labels.attach(f, one, ["label_f"]), one, ["label_f"])
    assert again.count() == 3 and again.filter("label_f = 80").count() == 2
    with pytest.raises(Exception, match="several rows"):
        labels.attach(f, one.union(one), ["label_f"]).collect()


def test_sections(spark):
    t = "HEAD\n.SYNOPSIS...\nhigh pressure\n.NEAR TERM /TONIGHT/...\nclear. ...not a heading\n&&\nJC\n"
    s = text.sections(spark.createDataFrame([(1, t), (2, "none"), (3, ""), (4, None)], "i int, t string"), "t", ["i"]).collect()
    assert [(r["i"], r["section_name"], r["section_text"]) for r in s] == [(1, "HEADER", "HEAD\n"), (1, "SYNOPSIS", "high pressure"), (1, "NEAR TERM /TONIGHT/", "clear. ...not a heading\n&&\nJC"), (2, "HEADER", "none"), (3, "HEADER", "")]
    assert [r[0] for r in spark.createDataFrame([(t,), ("a\nb",), ("",)], "t string").select(text.forecaster(F.col("t"))).collect()] == ["JC", None, None]


def test_scaled_fields(spark):
    raw = [("+0250,5",), ("+9999,9",), ("",), ("-0011,1",), ("x,1",)]
    d = observations.decoded(spark.createDataFrame(raw, "TMP string").withColumn("SLP", F.lit("10071,1")).withColumn("REPORT_TYPE", F.lit("SOD")))
    assert [r["temperature_c"] for r in d.collect()] == [25.0, None, None, -1.1, None]
    assert d.first()["sea_level_pressure_hpa"] == 1007.1 and not d.first()["is_real_observation"]


def test_ragged_times_and_tickers(spark):
    d = spark.createDataFrame([("2025-07-01T12:00:00.123456789Z", "KXHIGHNY-25JUL01-B92"), ("bad", "OTHER-25JUL01")], "t string, k string")
    assert [tuple(r) for r in d.select(times.ragged_epoch(F.col("t")), times.ticker_day(F.col("k"))).collect()] == [(1751371200, dt.date(2025, 7, 1)), (None, None)]


def test_message_choice(spark):
    lines = ["1:0:d=2025010100:APCP:surface:0-6 hour acc fcst:", "2:100:d=2025010100:APCP:surface:5-6 hour acc fcst:", "3:250:d=2025010100:TMP:2 m above ground:6 hour fcst:", "4:300:d=2025010100:APCP:surface:0-6 hour acc fcst:prob >0.254", "bad"]
    e = grib.index_lines(spark.createDataFrame([("f", 6, x) for x in lines], "f string, fh int, value string"), keys=["f", "fh"])
    pick = lambda rule, v="APCP", lev="surface": grib.choose_message(e, ["f", "fh"], v, lev, "fh", rule).first()
    assert (pick("shortest_window")["byte_start"], pick("shortest_window")["byte_end"]) == (100, 249)
    assert pick("windowed_1h")["msg_num"] == 2 and pick("cumulative_since_start")["msg_num"] == 1
    assert pick("instant")["error"] == "no candidate" and pick("instant", "TMP", "2 m above ground")["byte_end"] == 299
    twice = e.union(e.withColumn("msg_num", F.col("msg_num") + 10))
    assert grib.choose_message(twice, ["f", "fh"], "APCP", "surface", "fh", "windowed_1h").first()["error"] is None
    other = e.union(e.filter("msg_num = 2").withColumn("forecast_desc", F.lit("strange")))
    assert grib.choose_message(other, ["f", "fh"], "APCP", "surface", "fh", "windowed_1h").first()["error"] == "unreadable description"


def test_live_names_win_where_they_exist(spark):
    candles = [("m", json.dumps({"end_period_ts": 60, "yes_bid": {"open_dollars": "", "open": "0.3", "close": "0.4"}, "volume_fp": "7"})), ("m", json.dumps({"end_period_ts": 120, "volume": 3}))]
    a, b = market.normalized(spark.createDataFrame(candles, "market_ticker string, candle string")).collect()
    assert (a["yes_bid_open"], a["yes_bid_close"], a["volume"], b["volume"], b["yes_ask_open"]) == (None, 0.4, 7.0, 3.0, None)


def test_empty_books_have_three_values(spark):
    d = spark.createDataFrame([(0.0, 1.0), (0.0, None), (0.1, 1.0)], "b double, a double")
    assert [r[0] for r in d.select(market.empty_book(F.col("b"), F.col("a"))).collect()] == [True, None, False]


def test_gap_edges(spark):
    d = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 2.0, 5.0, 15.0, 60.0, 180.0, 180.5)], "m double")
    assert [r[0] for r in d.select(market.gap_bucket(F.col("m"))).collect()] == [None, "1", "1", "2", "3-5", "6-15", "16-60", "61-180", ">180"]


def test_tiling(spark):
    rows = [("e", None, 80.0, "less"), ("e", 80.0, 81.0, "between"), ("e", 82.0, 83.0, "between"), ("e", 83.0, None, "greater"), ("f", None, 80.0, "less"), ("f", 81.0, 82.0, "between"), ("f", 82.0, 83.0, "between")]
    d = market.tiling_faults(spark.createDataFrame(rows, "event_ticker string, floor_strike double, cap_strike double, strike_type string"))
    assert sorted((r["event_ticker"], r["floor_strike"], r["fault"]) for r in d.collect()) == [("f", 81.0, "gap"), ("f", 82.0, "overlap")]


def messages(spark, rows):
    full = [(1, i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "sid long, ord long, type string, market_ticker string, seq long, side string, price double, delta double, levels array<struct<side:string,price:double,size:double>>")


SNAP = ("orderbook_snapshot", "m", None, None, None, None, [("yes", 0.4, 300.0), ("no", 0.5, 333.0)])
BOOKS = {
    "folds": [SNAP, ("orderbook_delta", "m", 1, "yes", 0.4, 50.0, None), ("orderbook_delta", "m", 2, "no", 0.5, -333.0, None), ("orderbook_delta", "m", 3, "yes", 0.3, 10.0, None)],
    "delta first": [("orderbook_delta", "m", 1, "yes", 0.4, 50.0, None), SNAP],
    "gap": [SNAP, ("orderbook_delta", "m", 1, "yes", 0.4, 1.0, None), ("orderbook_delta", "n", 3, "yes", 0.4, 1.0, None), ("orderbook_delta", "m", 4, "yes", 0.4, 1.0, None)],
    "resync": [SNAP, ("orderbook_delta", "n", 1, "yes", 0.4, 1.0, None), ("orderbook_delta", "n", 5, "yes", 0.4, 1.0, None), SNAP, ("orderbook_delta", "m", 6, "yes", 0.9, 1.0, None)],
    "old": [SNAP, ("orderbook_delta", "m", 2, "yes", 0.4, 1.0, None), ("orderbook_delta", "m", 2, "yes", 0.4, 1.0, None), ("trade", None, 3, None, None, None, None)],
    "negative": [SNAP, ("orderbook_delta", "m", 1, "yes", 0.4, -301.0, None), ("orderbook_delta", "m", 2, "yes", 0.4, 5.0, None)],
    "disconnect": [SNAP, ("disconnect", None, None, None, None, None, None), ("orderbook_delta", "m", 1, "yes", 0.4, 5.0, None)],
}


@pytest.mark.parametrize("name", sorted(BOOKS))
def test_books_batch_and_stream_agree(spark, name):
    m = messages(spark, BOOKS[name])
    batch = sorted(tuple(r) for r in orderbook.books(orderbook.segments(m)).collect())
    state = {"last": None, "books": {}}
    for r in m.orderBy("ord").collect():
        books.step(state, r.asDict(recursive=True))
    assert [tuple(None if v != v else v for v in r[:-1]) for r in books.rows(1, state, 0).itertuples(index=False)] == batch
    if name == "folds":
        assert batch == [(1, "m", 1, 3, True, 0.4, None, 2, 0)]
    if name in ("gap", "negative", "disconnect"):
        assert not batch[0][4]


def test_tied_ranks_and_thin_groups(spark):
    d = spark.createDataFrame([(1, x, y) for x, y in [(1.0, 5.0), (1.0, 4.0), (2.0, 3.0), (3.0, 2.0), (4.0, 1.0)]] + [(2, 1.0, 1.0)], "g int, x double, y double")
    r = stats.spearman(d, ["g"], "x", "y").collect()
    assert len(r) == 1 and r[0]["spearman"] == pytest.approx(-0.9746794344808963)


def test_nearest_point_over_the_date_line(spark):
    p = spark.createDataFrame([(1, 0.0, 179.99), (2, 50.0, 10.0)], "i int, lat double, lon double")
    g = spark.createDataFrame([("a", 0.0, -179.99), ("b", 0.5, 179.0)], "g string, glat double, glon double")
    r = joins.nearest_points(p, g, "i", "lat", "lon", "glat", "glon", 1.0, 100.0).collect()
    assert [(x["i"], x["g"]) for x in r] == [(1, "a")]


def test_sources_and_sinks(spark, tmp_path):
    d = spark.createDataFrame([(1, "a", 2024), (2, "b", 2025)], "i int, s string, year int")
    sinks.yearly(d, f"{tmp_path}/y")
    assert sorted(map(tuple, files.by_year(spark, f"{tmp_path}/y").collect())) == sorted(map(tuple, d.collect()))
    sinks.replaced(spark, files.by_year(spark, f"{tmp_path}/y").filter("i = 1"), f"{tmp_path}/y")
    assert spark.read.parquet(f"{tmp_path}/y").count() == 1
    assert files.parquet_parts(spark, f"{tmp_path}/nothing", "a int, b string").columns == ["a", "b"]
    parts = files.parquet_parts(spark, f"{tmp_path}/y", "i int, later boolean")
    assert parts.first()["later"] is None
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "202507020600-KOKX.txt").write_text("one\ntwo")
    assert files.whole_texts(spark, f"{tmp_path}/t").first()["product_id"] == "202507020600-KOKX"
    assert sinks.file_hashes(spark, f"{tmp_path}/t").first()["bytes"] == 7


def test_retries():
    answers = iter([connector.TransportError(503), connector.TransportError(429), [1]])

    def call():
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    waits = []
    assert connector.fetched(call, sleep=waits.append) == [1] and len(waits) == 2

    def absent():
        raise connector.TransportError(404)

    assert connector.fetched(absent) is None

    def broken():
        raise connector.TransportError(400)

    with pytest.raises(connector.TransportError):
        connector.fetched(broken)
