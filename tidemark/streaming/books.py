"""Order books as a stream: the fold of ``operators.orderbook`` with state per subscription.

The state of a sid is its last sequence number and its markets' books, as one JSON text; a micro-batch's messages of a sid are
applied in order of arrival. The number of markets of a subscription bounds the state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "sid long, market_ticker string, segment_id long, n_deltas long, trusted boolean, best_yes_bid double, best_no_bid double, n_yes_levels long, n_no_levels long, upto long"


def new_book() -> dict:
    return {"yes": {}, "no": {}, "segment": 0, "n": 0, "state": "none"}


def step(state: dict, m: dict) -> None:
    """Applies one message to a sid's state: {"last": number, "books": {market: book}}."""
    books, kind = state["books"], m["type"]
    if kind == "disconnect":
        for b in books.values():
            b["state"] = "pending" if b["segment"] else b["state"]
        return
    if kind in ("orderbook_delta", "trade") and m["seq"] is not None:
        last = state["last"]
        if last is not None and m["seq"] <= last:
            return
        if last is not None and m["seq"] > last + 1:
            for b in books.values():
                b["state"] = "pending" if b["segment"] else b["state"]
        state["last"] = m["seq"]
    if kind not in ("orderbook_snapshot", "orderbook_delta"):
        return
    b = books.setdefault(m["market_ticker"], new_book())
    if kind == "orderbook_snapshot":
        b.update(yes={}, no={}, segment=b["segment"] + 1, n=0, state="live", lost=False)
        for x in m["levels"]:
            if x["size"]:
                b[x["side"]][str(x["price"])] = str(x["size"])
        return
    if b["state"] != "live":
        b["lost"] = True
        return
    side, price = b[m["side"]], str(m["price"])
    size = Decimal(side.get(price, "0")) + Decimal(str(m["delta"]))
    if size < 0:
        b["state"], b["lost"] = "pending", True
        return
    if size:
        side[price] = str(size)
    else:
        side.pop(price, None)
    b["n"] += 1


def rows(sid: int, state: dict, upto: int) -> pd.DataFrame:
    out = []
    for name, b in sorted(state["books"].items()):
        if b["segment"]:
            best = [max(map(float, b[s]), default=None) for s in ("yes", "no")]
            out.append((sid, name, b["segment"], b["n"], not b.get("lost"), *best, len(b["yes"]), len(b["no"]), upto))
    return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    own = json.loads(state.get[0]) if state.exists else {"last": None, "books": {}}
    every = pd.concat(list(batches)).sort_values("ord")
    for m in every.to_dict("records"):
        m["seq"] = None if pd.isna(m["seq"]) else int(m["seq"])
        step(own, m)
    state.update((json.dumps(own),))
    yield rows(int(key[0]), own, int(every["ord"].max()))


def book_stream(messages: DataFrame) -> DataFrame:
    """Every micro-batch: the books of the sids it touched. ``upto`` tells the newest row of a market from older ones."""
    return messages.groupBy("sid").applyInPandasWithState(_fold, OUT, "books string", "append", GroupStateTimeout.NoTimeout)
