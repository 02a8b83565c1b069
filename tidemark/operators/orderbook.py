"""Order books from snapshots and deltas, in one pass of windows and sums.

``messages``: sid, ord (arrival, unique per sid), type (orderbook_snapshot, orderbook_delta, trade, disconnect), market_ticker, seq, side
(yes, no), price, delta, and for snapshots ``levels``: array of (side, price, size). Sequence numbers belong to a
subscription (sid) that many markets share: old numbers are dropped, a gap makes every book of the sid worthless until
its next snapshot. Snapshots stand outside the sequence. A delta that would make a level negative makes that book
worthless too. As levels are sums, a book is a sum over the valid deltas of its segment; nothing is replayed row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import prefix, prefix_max, prefix_sum, sequence_flags
from tidemark.sources.sinks import staged

SIZE = "decimal(18,2)"
#: Arrivals of a stretch: what one window holds of a market, however active it is.
STRETCH = 1 << 20


def flagged(messages: DataFrame) -> DataFrame:
    """Deltas and trades with FIRST, OK, GAP or DUPLICATE_OR_OLD; other messages with null."""
    numbered = messages.filter(F.col("type").isin("orderbook_delta", "trade") & F.col("seq").isNotNull())
    rest = messages.filter(~(F.col("type").isin("orderbook_delta", "trade") & F.col("seq").isNotNull())).withColumn("flag", F.lit(None).cast("string"))
    return sequence_flags(numbered, "sid", "ord", "seq").unionByName(rest)


def segments(messages: DataFrame) -> DataFrame:
    """Snapshots and deltas with their market's segment, and ``state``: applied, no_snapshot, pending or negative.

    Pending: after a gap, a disconnection or an impossible delta, before the next snapshot.
    """
    f = flagged(staged(messages)).filter(F.coalesce(F.col("flag") != "DUPLICATE_OR_OLD", F.lit(True)))
    gap = F.when((F.col("flag") == "GAP") | (F.col("type") == "disconnect"), F.col("ord"))
    book = staged(prefix_max(staged(f), ["sid"], "ord", gap, "broken", STRETCH).filter(F.col("type").isin("orderbook_snapshot", "orderbook_delta")))
    snap = F.col("type") == "orderbook_snapshot"
    book = prefix(book, ["sid", "market_ticker"], "ord", {"segment_id": (F.when(snap, 1), "sum"), "started": (F.when(snap, F.col("ord")), "max")}, STRETCH)
    book = staged(book)
    alive = F.col("started").isNotNull() & (F.col("broken").isNull() | (F.col("broken") < F.col("started")))
    book = book.withColumn("alive", alive)
    # running sums of the levels find the first delta of a segment that would go below zero
    first = book.filter(snap).select("sid", "market_ticker", "segment_id", "ord", F.explode("levels").alias("l")).select("sid", "market_ticker", "segment_id", "ord", F.col("l.side").alias("side"), F.col("l.price").alias("price"), F.col("l.size").cast(SIZE).alias("delta"))
    later = book.filter(~snap & F.col("alive")).select("sid", "market_ticker", "segment_id", "ord", "side", "price", F.col("delta").cast(SIZE).alias("delta"))
    sizes = prefix_sum(staged(first.unionByName(later)), ["sid", "market_ticker", "segment_id", "side", "price"], "ord", F.col("delta"), "size", STRETCH)
    bad = sizes.filter("size < 0").groupBy("sid", "market_ticker", "segment_id").agg(F.min("ord").alias("bad"))
    out = book.join(bad, ["sid", "market_ticker", "segment_id"], "left")
    state = F.when(snap, "applied").when(F.col("started").isNull(), "no_snapshot").when(~F.col("alive") | (F.col("ord") > F.col("bad")), "pending").when(F.col("ord") == F.col("bad"), "negative").otherwise("applied")
    return out.select("sid", "ord", "type", "market_ticker", "side", "price", "delta", "levels", "segment_id", state.alias("state"))


def levels(segmented: DataFrame) -> DataFrame:
    """Sizes of the levels in each market's last segment; emptied levels are gone."""
    last = segmented.groupBy("sid", "market_ticker").agg(F.max("segment_id").alias("segment_id")).filter("segment_id > 0")
    now = segmented.filter("state = 'applied'").join(last, ["sid", "market_ticker", "segment_id"], "left_semi")
    first = now.filter("type = 'orderbook_snapshot'").select("sid", "market_ticker", "segment_id", F.explode("levels").alias("l")).select("sid", "market_ticker", "segment_id", F.col("l.side").alias("side"), F.col("l.price").alias("price"), F.col("l.size").cast(SIZE).alias("delta"))
    later = now.filter("type = 'orderbook_delta'").select("sid", "market_ticker", "segment_id", "side", "price", F.col("delta").cast(SIZE).alias("delta"))
    return first.unionByName(later).groupBy("sid", "market_ticker", "segment_id", "side", "price").agg(F.sum("delta").alias("size")).filter("size <> 0")


def books(segmented: DataFrame) -> DataFrame:
    """One row per market: segment, deltas applied in it, best bids, numbers of levels, and whether it can be trusted now."""
    segmented = staged(segmented)
    l = levels(segmented)  # noqa: E741
    best = l.groupBy("sid", "market_ticker").agg(F.max(F.when(F.col("side") == "yes", F.col("price"))).alias("best_yes_bid"), F.max(F.when(F.col("side") == "no", F.col("price"))).alias("best_no_bid"), F.count(F.when(F.col("side") == "yes", 1)).alias("n_yes_levels"), F.count(F.when(F.col("side") == "no", 1)).alias("n_no_levels"))
    top = segmented.groupBy("sid", "market_ticker", "segment_id").agg(F.count(F.when((F.col("type") == "orderbook_delta") & (F.col("state") == "applied"), 1)).alias("n_deltas"), F.max(F.when(F.col("state").isin("pending", "negative"), 1)).alias("lost"))
    last = top.groupBy("sid", "market_ticker").agg(F.max(F.struct("segment_id", "n_deltas", "lost")).alias("x")).select("sid", "market_ticker", "x.*").filter("segment_id > 0")
    return last.join(best, ["sid", "market_ticker"], "left").select("sid", "market_ticker", "segment_id", "n_deltas", F.col("lost").isNull().alias("trusted"), "best_yes_bid", "best_no_bid", F.coalesce("n_yes_levels", F.lit(0)).alias("n_yes_levels"), F.coalesce("n_no_levels", F.lit(0)).alias("n_no_levels"))


def counters(messages: DataFrame, segmented: DataFrame) -> DataFrame:
    """What happened, by kind."""
    a = flagged(messages).filter("flag is not null").groupBy(F.col("flag").alias("kind")).agg(F.count("*").alias("n"))
    b = segmented.groupBy(F.concat_ws(":", "type", "state").alias("kind")).agg(F.count("*").alias("n"))
    return a.unionByName(b)


def opening_capture(first_snapshot_us, open_us, market_count, expected_count):
    """How well the opening was caught: by how late the last market's first snapshot came (seconds after the open)."""
    late = (first_snapshot_us - open_us) / 1e6
    return F.when(first_snapshot_us.isNull() | (market_count == 0), "INVALID").when(market_count < expected_count, "PARTIAL").when(late <= 60, "FULL").when(late <= 600, "NEAR").otherwise("STARTED_AFTER_OPEN")


def capture_completeness(started_mid, invalid, partial):
    """The first that holds, in this order."""
    return F.when(started_mid, "STARTED_MID_EVENT").when(invalid, "INVALID").when(partial, "PARTIAL").otherwise("COMPLETE")
