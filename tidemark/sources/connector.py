"""Remote sources as a Python data source: pages or byte ranges, fetched by tasks with retries.

``transport`` names a function ``module:function`` that gets a page number and the options and returns rows; tests use a
local one, and so does any site that has its own client. Signing and credentials are the transport's business.
"""

from __future__ import annotations

import importlib
import random
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Answers worth asking again for.
RETRY = (429, 500, 502, 503, 504)


class TransportError(Exception):
    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


def delay(attempt: int, base: float, most: float, jitter: float) -> float:
    """Seconds to wait before the next try."""
    return min(most, base * 2**attempt) * (1 + jitter)


def fetched(call, tries: int = 6, base: float = 0.5, most: float = 30.0, sleep=time.sleep):
    """``call()``, again after a transient failure; 404 is an absence (None), anything else is raised."""
    for attempt in range(tries):
        try:
            return call()
        except TransportError as e:
            if e.status == 404:
                return None
            if e.status not in RETRY or attempt == tries - 1:
                raise
            sleep(delay(attempt, base, most, random.random() / 4))


class Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Page]:
        return [Page(i) for i in range(int(self.options.get("pages", 1)))]

    def read(self, partition: Page) -> Iterator[tuple]:
        module, _, name = self.options["transport"].partition(":")
        call = getattr(importlib.import_module(module), name)
        for row in fetched(lambda: call(partition.number, self.options)) or []:
            yield tuple(row)


class PagedSource(DataSource):
    """``spark.dataSource.register(PagedSource)``, then ``format("paged")`` with ``transport``, ``pages`` and a schema."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options.get("rows", "key string, value string")

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def _function(path: str):
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class Key(InputPartition):
    def __init__(self, key: str):
        self.key = key


class CursorReader(DataSourceReader):
    """A partition for each key; within it pages follow one another by cursor, and go out as they come."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Key]:
        return [Key(k) for k in self.options["keys"].split(",") if k]

    def pages(self, transport: str, key: str) -> Iterator[list] | None:
        """The pages of one feed; None if it does not know the key."""
        call = _function(transport)
        first = fetched(lambda: call(key, None, self.options))
        if first is None:
            return None

        def follow() -> Iterator[list]:
            answer, seen = first, set()
            while answer is not None:
                rows, cursor = answer
                yield rows
                if not cursor:
                    return
                if cursor in seen:
                    raise RuntimeError(f"{key}: the cursor {cursor} came twice")
                seen.add(cursor)
                answer = fetched(lambda c=cursor: call(key, c, self.options))

        return follow()

    def read(self, partition: Key) -> Iterator[tuple]:
        for name in ("transport", "fallback"):
            if name in self.options and (found := self.pages(self.options[name], partition.key)) is not None:
                for rows in found:
                    yield from (tuple(r) for r in rows)
                return


class CursorSource(DataSource):
    """``format("cursor")`` with ``keys`` (comma-separated), ``transport`` and, for keys it does not know, ``fallback``.

    A transport ``module:function`` gets (key, cursor or None, options) and returns (rows, next cursor or nothing). A live
    feed is the transport, its archive the fallback.
    """

    @classmethod
    def name(cls) -> str:
        return "cursor"

    def schema(self) -> str:
        return self.options.get("rows", "key string, value string")

    def reader(self, schema) -> CursorReader:
        return CursorReader(self.options)


def numbers(page: int, options: dict) -> list[tuple]:
    """A transport for trials: the numbers of a page."""
    size = int(options.get("size", 10))
    return [(f"{page}", f"{page * size + i}") for i in range(size)]


def chunk_plan(windows, start: str, end: str, seconds: int):
    """Requests of at most ``seconds`` each; the next one starts a second after the last one's end."""
    from pyspark.sql import functions as F

    at = F.explode(F.sequence(F.col(start), F.col(end), F.lit(seconds + 1))).alias("from_ts")
    return windows.filter(F.col(start) <= F.col(end)).select("*", at).withColumn("to_ts", F.least(F.col("from_ts") + seconds, F.col(end)))
