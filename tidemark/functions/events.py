"""Event documents: status, times, verification; sizes of JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import ragged_epoch

#: The series that is followed, and what its titles say.
SERIES, PREFIX, TITLE = "KXHIGHNY", "KXHIGHNY-", ("new york", "temperature")
_TEXT, _NUMBER = r'"(?:[^"\\]|\\.)*"', r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"


def status(markets: Column) -> Column:
    """Of the first market; ``unknown`` without markets."""
    return F.coalesce(F.get(markets, F.lit(0))["status"], F.lit("unknown"))


def earliest_open(markets: Column) -> Column:
    """Epoch seconds; markets without a time don't count."""
    return F.array_min(F.transform(markets, lambda m: ragged_epoch(m["open_time"])))


def latest_close(markets: Column) -> Column:
    return F.array_max(F.transform(markets, lambda m: ragged_epoch(m["close_time"])))


def all_settled(markets: Column) -> Column:
    return F.coalesce((F.size(markets) > 0) & F.forall(markets, lambda m: m["status"].eqNullSafe("settled")), F.lit(False))


def refusal(series: Column, ticker: Column, title: Column, markets: Column) -> Column:
    """Why an event isn't one of the series, or null: the first reason."""
    low = F.lower(F.coalesce(title, F.lit("")))
    fits = low.contains(TITLE[0]) & low.contains(TITLE[1])
    return F.when(~series.eqNullSafe(SERIES), "other series").when(~F.coalesce(ticker.startswith(PREFIX), F.lit(False)), "other ticker").when(~fits, "other title").when(F.coalesce(F.size(markets), F.lit(0)) <= 0, "no markets")


def numeric_fields(json: Column) -> Column:
    """How many numbers a JSON document holds; texts are taken out first."""
    return F.regexp_count(F.regexp_replace(json, _TEXT, '""'), F.lit(_NUMBER))


def relevant_bytes(total_bytes: Column, items: Column, planned: Column) -> Column:
    """Bytes that a plan will move, from what the items so far did."""
    return total_bytes / F.nullif(items, F.lit(0)) * planned
