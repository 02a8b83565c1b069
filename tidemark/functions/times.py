"""Days, query times and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The local zone, the local hours that are asked about, the two policies.
ZONE = "America/New_York"
QUERY_HOURS = (6, 8, 10, 12, 14, 16)
MODES = ("strict", "proxy")


def local_day_bounds(day: Column, zone: str = ZONE) -> tuple[Column, Column]:
    """Start and end of a local calendar day in UTC; 23, 24 or 25 hours apart."""
    return F.to_utc_timestamp(day.cast("timestamp_ntz"), zone), F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp_ntz"), zone)


def local_query_time(day: Column, hour: Column, zone: str = ZONE) -> Column:
    """The instant at ``hour`` o'clock local time."""
    return F.to_utc_timestamp(F.make_timestamp_ntz(F.year(day), F.month(day), F.day(day), hour, F.lit(0), F.lit(0)), zone)


def state_id(day: Column, query_time: Column, mode: Column) -> Column:
    """Sixteen hex digits that name a (day, instant, policy); the same wherever it is computed."""
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("|"), F.date_format(query_time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00|"), mode)
    return F.substring(F.sha2(text, 256), 1, 16)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS day")


def state_grid(days: DataFrame, zone: str = ZONE, hours: tuple = QUERY_HOURS, modes: tuple = MODES) -> DataFrame:
    """Every day at every local hour under every policy, with id and day bounds."""
    start, end = local_day_bounds(F.col("day"), zone)
    grid = days.select("day", F.explode(F.array(*map(F.lit, hours))).alias("local_hour")).withColumn("query_time", local_query_time(F.col("day"), F.col("local_hour"), zone))
    grid = grid.withColumn("mode", F.explode(F.array(*map(F.lit, modes))))
    return grid.select(state_id(F.col("day"), F.col("query_time"), F.col("mode")).alias("state_id"), "day", "local_hour", "query_time", "mode", start.alias("day_start"), end.alias("day_end"))


def day_progress(t: Column, day: Column, zone: str = ZONE) -> tuple[Column, Column]:
    """(minutes since local midnight on the wall clock, hours until the day's end in absolute time)."""
    wall = F.from_utc_timestamp(t, zone)
    minutes = (F.unix_micros(wall) - F.unix_micros(day.cast("timestamp"))) / 60e6
    return minutes, (F.unix_micros(local_day_bounds(day, zone)[1]) - F.unix_micros(t)) / 3600e6


def age_hours(now: Column, then: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / 3600e6


def ragged_epoch(text: Column) -> Column:
    """Whole seconds of an ISO time with any number of fraction digits; null if it is none."""
    cut = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return F.unix_seconds(F.try_to_timestamp(cut))


def ticker_day(ticker: Column) -> Column:
    """The day in a ticker such as ``HIGHNY-25JUL01`` or ``KXHIGHNY-25JUL01-B92``; null otherwise."""
    at = r"^(?:KX)?HIGHNY-(\d{2})([A-Z]{3})(\d{2})"
    part = [F.regexp_extract(ticker, at, i) for i in (1, 2, 3)]
    number = F.lpad(((F.instr(F.lit("JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"), part[1]) + 2) / 3).cast("int").cast("string"), 2, "0")
    return F.when(part[0] != "", F.try_to_date(F.concat(F.lit("20"), part[0], F.lit("-"), number, F.lit("-"), part[2]), "yyyy-MM-dd"))


def product_issuance(product_id: Column) -> Column:
    """The time in ``YYYYMMDDHHMM-CCCC-...``."""
    return F.try_to_timestamp(F.split(product_id, "-")[0], F.lit("yyyyMMddHHmm"))


def blocks(newest_start: str, n: int) -> list[str]:
    """Starts of half-year blocks, newest first."""
    year, month = map(int, newest_start.split("-")[:2])
    out = []
    for _ in range(n):
        out.append(f"{year:04d}-{month:02d}-01")
        year, month = (year, 1) if month > 6 else (year - 1, 7)
    return out
