"""Candles: normalising, empty books, gaps between candles, what quotes do across them, life cycle, liquidity.

A candle that is missing is never filled in. ``pairs`` sets each candle beside the one before it in its market; all gap
analyses are sums over these pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.operators.stats import with_quantiles
from tidemark.sources.sinks import staged

#: Gap buckets (upper edges, right-closed), life-cycle buckets in order, endpoint patterns.
GAP_EDGES, GAP_LABELS = (1, 2, 5, 15, 60, 180), ("1", "2", "3-5", "6-15", "16-60", "61-180", ">180")
LIFECYCLE = (">24h", "12-24h", "6-12h", "3-6h", "1-3h", "<1h")
PATTERNS = ("A_same_bid_same_ask", "B_same_bid_changed_ask", "C_changed_bid_same_ask", "D_changed_bid_changed_ask")


def empty_book(bid_close: Column, ask_close: Column) -> Column:
    """Bid 0 and ask 1: nobody quotes. Unknown if either quote is missing."""
    return F.when(bid_close.isNotNull() & ask_close.isNotNull(), (bid_close == 0) & (ask_close == 1))


def gap_bucket(missing: Column, edges: tuple = GAP_EDGES, labels: tuple = GAP_LABELS) -> Column:
    """The label of a gap's length; null at or below zero."""
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels[:-1], strict=True))):
        out = F.when(missing <= edge, label).otherwise(out)
    return F.when(missing > 0, out)


def lifecycle_bucket(before_close_hours: Column, has_close: Column, after_close: Column) -> Column:
    """Where in a market's life a candle lies; the first rule that holds."""
    h = before_close_hours
    return F.when(~has_close, "unknown").when(after_close, "post_close").when(h > 24, ">24h").when(h >= 12, "12-24h").when(h >= 6, "6-12h").when(h >= 3, "3-6h").when(h >= 1, "1-3h").otherwise("<1h")


def flat_zero_volume(prefix: str = "") -> Column:
    """No volume and open = high = low = close on both sides; unknown is no."""
    c = lambda side, part: F.col(f"{prefix}yes_{side}_{part}")
    same = F.col(f"{prefix}volume") == 0
    for side in ("bid", "ask"):
        for a, b in (("open", "high"), ("high", "low"), ("low", "close")):
            same = same & (c(side, a) == c(side, b))
    return F.coalesce(same, F.lit(False))


def normalized(candles: DataFrame) -> DataFrame:
    """One schema from candles of either feed: a struct ``live`` (``*_dollars``, ``*_fp``) or ``past`` (plain names).

    The live names count wherever the candle has that key at all, even if it is empty; text that is no number is null.
    """
    out = []
    for side in ("yes_bid", "yes_ask", "price"):
        for part in ("open", "high", "low", "close"):
            live, past = F.get_json_object("candle", f"$.{side}.{part}_dollars"), F.get_json_object("candle", f"$.{side}.{part}")
            has = F.array_contains(F.coalesce(F.json_object_keys(F.get_json_object("candle", f"$.{side}")), F.array().cast("array<string>")), f"{part}_dollars")
            out.append(F.when(has, live).otherwise(past).try_cast("double").alias(f"{side}_{part}"))
    keys = F.coalesce(F.json_object_keys("candle"), F.array().cast("array<string>"))
    for live, past in (("volume_fp", "volume"), ("open_interest_fp", "open_interest")):
        out.append(F.when(F.array_contains(keys, live), F.get_json_object("candle", f"$.{live}")).otherwise(F.get_json_object("candle", f"$.{past}")).try_cast("double").alias(past))
    return candles.select("market_ticker", F.get_json_object("candle", "$.end_period_ts").try_cast("long").alias("timestamp"), *out)


def last_version(candles: DataFrame, order: str) -> DataFrame:
    """One candle per market and period, the one fetched last: a two-step maximum, without a window."""
    rest = [c for c in candles.columns if c not in ("market_ticker", "timestamp")]
    return candles.groupBy("market_ticker", "timestamp").agg(F.max_by(F.struct(*rest), order).alias("x")).select("market_ticker", "timestamp", "x.*")


def structure(markets: Column) -> Column:
    """Kind of an event from its markets' JSON: none, one, several that all name a strike type."""
    n = F.coalesce(F.size(markets), F.lit(0))
    named = F.forall(markets, lambda m: F.array_contains(F.json_object_keys(m), "strike_type"))
    return F.when(n == 0, "unknown").when(n == 1, "single_threshold").when(named, "bucketed").otherwise("unknown")


def endpoint(settled: Column, closed: Column, cutoff: Column) -> Column:
    """Which feed has a market's candles."""
    return F.when(F.coalesce(settled, closed) < cutoff, "historical").otherwise("live")


def pairs(candles: DataFrame, bounds: DataFrame | None = None, unit_seconds: float = 60.0) -> DataFrame:
    """Each candle beside its predecessor. ``bounds``: (market_ticker, close_ts), one row each.

    Candles of one time follow each other by ``arrival``, if they have it. Those without a time come last and precede none.
    """
    order = [F.col("timestamp").asc_nulls_last(), *[c for c in ("arrival",) if c in candles.columns]]
    p = windows.pairs(candles, ["market_ticker"], order, ["timestamp", "yes_bid_close", "yes_ask_close", "is_empty_book"]).filter("pre_timestamp is not null")
    if bounds is not None:
        p = p.join(bounds.select("market_ticker", "close_ts"), "market_ticker", "left")
    elif "close_ts" not in p.columns:
        p = p.withColumn("close_ts", F.lit(None).cast("long"))
    elapsed = F.col("timestamp") - F.col("pre_timestamp")
    bid_valid = F.col("pre_yes_bid_close").isNotNull() & F.col("yes_bid_open").isNotNull()
    ask_valid = F.col("pre_yes_ask_close").isNotNull() & F.col("yes_ask_open").isNotNull()
    same = lambda s: F.coalesce(F.col(f"pre_yes_{s}_close") == F.col(f"yes_{s}_open"), F.lit(False))
    mid = lambda a, b: (F.col(a) + F.col(b)) / 2
    hours = (F.col("close_ts") - F.col("pre_timestamp")) / 3600
    return p.select(
        "*", elapsed.alias("elapsed_seconds"), (elapsed / unit_seconds - 1).alias("missing"), bid_valid.alias("bid_valid"), ask_valid.alias("ask_valid"), (bid_valid & ask_valid).alias("quote_eligible"),
        same("bid").alias("same_bid"), same("ask").alias("same_ask"), (same("bid") & same("ask")).alias("same_quote"),
        F.when(bid_valid & ask_valid, F.abs(mid("yes_bid_open", "yes_ask_open") - mid("pre_yes_bid_close", "pre_yes_ask_close"))).alias("abs_mid_change"),
        flat_zero_volume().alias("flat_zero_volume"), (F.coalesce("pre_is_empty_book", F.lit(False)) | F.coalesce("is_empty_book", F.lit(False))).alias("touches_empty_book"),
        hours.alias("hours_before_close"), lifecycle_bucket(hours, F.col("close_ts").isNotNull(), F.col("pre_timestamp") >= F.col("close_ts")).alias("lifecycle"),
    )


def gaps(p: DataFrame, unit_seconds: float = 60.0, with_empty: bool = False) -> DataFrame:
    """Pairs farther apart than one period."""
    out = p.filter(F.col("elapsed_seconds") > unit_seconds).withColumn("gap_bucket", gap_bucket(F.col("missing")))
    return out if with_empty else out.filter(~F.col("touches_empty_book"))


def consecutive(p: DataFrame, unit_seconds: float = 60.0) -> DataFrame:
    """Pairs exactly one period apart; closer ones are neither."""
    return p.filter(F.col("elapsed_seconds") == unit_seconds)


def gap_stats(g: DataFrame, by: list[str]) -> DataFrame:
    g = staged(g.select(*by, "missing"))
    q = g.groupBy(*by).agg(F.count("*").alias("n_gaps"), F.sum("missing").alias("total_missing"), F.avg("missing").alias("mean_missing"), F.max("missing").alias("max_missing"))
    points = {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    return with_quantiles(q, g, by, {"missing": points}).select(*by, "n_gaps", "total_missing", "mean_missing", *points, "max_missing")


def endpoint_pattern() -> Column:
    b, a = F.col("same_bid"), F.col("same_ask")
    return F.when(b & a, PATTERNS[0]).when(b, PATTERNS[1]).when(a, PATTERNS[2]).otherwise(PATTERNS[3])


def lifecycle_summary(g: DataFrame, by: list[str]) -> DataFrame:
    """Count, median gap, median spread before it and how often the quote is unchanged, by life-cycle bucket."""
    spread = g.withColumn("spread", F.col("pre_yes_ask_close") - F.col("pre_yes_bid_close"))
    return spread.groupBy(*by, "lifecycle").agg(F.count("*").alias("n"), F.expr("percentile(missing, 0.5)").alias("median_gap"), F.expr("percentile(spread, 0.5)").alias("median_spread"), (100 * F.avg(F.when(F.col("quote_eligible"), F.col("same_quote").cast("int")))).alias("same_quote_pct"))


def flat_stats(candles: DataFrame, consec: DataFrame, by: list[str]) -> DataFrame:
    """Candles without volume, flat ones, and consecutive pairs in which nothing at all changed."""
    c = candles.groupBy(*by).agg(F.count("*").alias("candles"), F.count(F.when(F.col("volume") == 0, 1)).alias("zero_volume"), F.count(F.when(flat_zero_volume(), 1)).alias("flat"))
    unchanged = F.col("flat_zero_volume") & F.col("same_bid") & F.col("same_ask")
    p = consec.groupBy(*by).agg(F.count("*").alias("consecutive"), F.count(F.when(unchanged, 1)).alias("unchanged"))
    return c.join(p, by, "left").withColumn("unchanged_pct", 100.0 * F.col("unchanged") / F.col("consecutive"))


def zero_volume_changes(consec: DataFrame, by: list[str]) -> DataFrame:
    """Quotes that moved between consecutive candles although nothing was traded."""
    z = consec.filter(F.col("volume") == 0)
    moved = F.col("quote_eligible") & ~F.col("same_quote")
    g = z.groupBy(*by).agg(F.count("*").alias("zero_volume"), F.count(F.when(F.col("quote_eligible"), 1)).alias("eligible"), F.count(F.when(moved, 1)).alias("changed"), F.expr("percentile(case when quote_eligible and not same_quote then abs_mid_change end, array(0.5, 0.9))").alias("p"))
    return g.select(*by, "zero_volume", "eligible", "changed", (100.0 * F.col("changed") / F.nullif(F.col("eligible"), F.lit(0))).alias("changed_pct"), F.col("p")[0].alias("median_change"), F.col("p")[1].alias("p90_change"))


def market_summary(candles: DataFrame, g: DataFrame, by: list[str]) -> DataFrame:
    """One row per market: candles, volume, median spread of real quotes, and its gaps (0 if none)."""
    real = F.col("yes_bid_close").isNotNull() & F.col("yes_ask_close").isNotNull() & ~F.coalesce("is_empty_book", F.lit(False))
    c = candles.withColumn("spread", F.when(real, F.col("yes_ask_close") - F.col("yes_bid_close"))).groupBy(*by, "market_ticker").agg(F.count("*").alias("candle_count"), F.expr("percentile(spread, 0.5)").alias("median_spread"), F.sum("volume").alias("total_volume"))
    q = g.groupBy("market_ticker").agg(F.count("*").alias("gap_count"), F.expr("percentile(missing, 0.5)").alias("median_gap"), F.max("missing").alias("max_gap"), (100 * F.avg(F.when(F.col("quote_eligible"), F.col("same_quote").cast("int")))).alias("same_quote_pct"))
    return c.join(q, "market_ticker", "left").withColumn("gap_count", F.coalesce("gap_count", F.lit(0)))


def tiling_faults(markets: DataFrame, event: str = "event_ticker") -> DataFrame:
    """Strike intervals that don't join the one before: whole-degree intervals that include both ends start one above it,
    others start on it. An open floor comes first; a missing cap keeps the last one known."""
    from pyspark.sql import Window

    w = Window.partitionBy(event).orderBy(F.col("floor_strike").asc_nulls_first(), "cap_strike")
    before = F.last("cap_strike", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    both = (F.col("strike_type") == "between") & (F.lag("strike_type").over(w) == "between")
    d = markets.withColumn("before_cap", before).withColumn("expected_floor", before + both.cast("int"))
    fault = F.when(F.col("floor_strike") > F.col("expected_floor"), "gap").when(F.col("floor_strike") < F.col("expected_floor"), "overlap")
    return d.withColumn("fault", fault).filter("fault is not null")


def not_exactly_one_yes(markets: DataFrame, event: str = "event_ticker") -> DataFrame:
    """Settled events in which the number of markets that resolved yes isn't one."""
    one = markets.dropDuplicates([event, "market_ticker"])
    return one.groupBy(event).agg(F.count(F.when(F.col("result") == "yes", 1)).alias("n_yes"), F.count("*").alias("n_markets")).filter("n_yes <> 1")


def minute_coverage(candles: DataFrame, event: str, n_markets: str) -> DataFrame:
    """Per event: periods with any candle, with one of every market, with a quote of every market, with an empty book, and the
    spread of the sums of midpoints over fully quoted periods. ``n_markets``: a column with the event's number of markets."""
    quoted = F.col("yes_bid_close").isNotNull() & F.col("yes_ask_close").isNotNull()
    real = quoted & ~F.coalesce("is_empty_book", F.lit(False))
    mid = (F.col("yes_bid_close") + F.col("yes_ask_close")) / 2
    one = candles.groupBy(event, "timestamp", "market_ticker").agg(F.count("*").alias("rows"), F.max(quoted.cast("int")).alias("q"), F.max((~real & quoted).cast("int")).alias("e"), F.avg(F.when(real, mid)).alias("mid"), F.max(n_markets).alias("n"))
    per = one.groupBy(event, "timestamp").agg(F.sum("rows").alias("rows"), F.count("*").alias("have"), F.sum("q").alias("q"), F.max("e").alias("e"), F.count("mid").alias("mids"), F.sum("mid").alias("mid"), F.max("n").alias("n"))
    total = F.when(F.col("mids") == F.col("n"), F.col("mid"))
    return per.groupBy(event).agg(F.sum("rows").alias("rows"), F.count("*").alias("periods"), F.count(F.when(F.col("have") == F.col("n"), 1)).alias("all_have_candle"), F.count(F.when(F.col("q") == F.col("n"), 1)).alias("all_have_quote"), F.count(F.when(F.col("e") == 1, 1)).alias("with_empty_book"), F.avg(total).alias("midpoint_sum_mean"), F.min(total).alias("midpoint_sum_min"), F.max(total).alias("midpoint_sum_max"))


def liquidity_density(candles: DataFrame, group: str, event: str) -> DataFrame:
    """Per group: how many candles, markets and contracts an event has in the middle."""
    per = candles.groupBy(group, event).agg(F.count("*").alias("candles"), F.countDistinct("market_ticker").alias("markets"), F.sum("volume").alias("volume"))
    return per.groupBy(group).agg(F.count("*").alias("events"), *[F.expr(f"percentile({c}, 0.5)").alias(f"median_{c}") for c in ("candles", "markets", "volume")])
