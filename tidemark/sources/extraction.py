"""Work items to rows: a fetch-and-decode function run by tasks, with its failures as rows of their own.

``worker(item) -> (rows, remote_bytes)`` is any picklable function of a dict; GRIB decoding is such a function where a
decoder is installed. A job is resumed by leaving out what ``sinks.done_table`` says is there.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

STATUS = "status string, attempts int, error string, remote_bytes long, seconds double"


def extracted(work: DataFrame, worker: Callable[[dict], tuple[list[dict], int]], rows: str, partitions: int, tries: int = 3) -> DataFrame:
    """One row per item: its columns, a status, and ``rows`` (array of structs, ``rows`` being their DDL).

    Items are dealt evenly to ``partitions``. An item that fails ``tries`` times is a row with status failed and no rows;
    it doesn't stop the others.
    """
    keys = work.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in work.dtypes), STATUS, f"rows array<struct<{rows.replace(' ', ':').replace(',:', ',')}>>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item in batch.to_dict("records"):
                began, error, got = time.perf_counter(), None, None
                for n in range(1, tries + 1):
                    try:
                        got = worker(item)
                        break
                    except Exception as e:  # whatever a remote source does is this item's failure, told in its row
                        error = f"{type(e).__name__}: {e}"[:500]
                seconds = time.perf_counter() - began
                out.append([*(item[k] for k in keys), "ok" if got else "failed", n, None if got else error, got[1] if got else 0, seconds, got[0] if got else []])
            yield pd.DataFrame(out, columns=[*keys, "status", "attempts", "error", "remote_bytes", "seconds", "rows"])

    return work.repartition(partitions).mapInPandas(run, schema)


def exploded(results: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the items that went well."""
    return results.filter("status = 'ok'").select(*keys, F.explode("rows").alias("r")).select(*keys, "r.*")


def report(results: DataFrame) -> DataFrame:
    """Items, rows and bytes by status, and items a second of one task's time."""
    return results.groupBy("status").agg(F.count("*").alias("items"), F.sum(F.size("rows")).alias("n_rows"), F.sum("remote_bytes").alias("remote_bytes"), (F.count("*") / F.sum("seconds")).alias("items_per_second"))


class PointIndex:
    """Nearest grid cells of a fixed set of points, kept per grid and checked again now and then.

    A grid is known by what identifies it (its fingerprint); values are always read fresh. ``search(grid) -> [(index,
    distance_km)]`` is the full search. A mapping farther than ``ceiling_km`` is refused.
    """

    def __init__(self, search: Callable, ceiling_km: float = 10.0, check_every: int = 500):
        self.search, self.ceiling_km, self.check_every = search, ceiling_km, check_every
        self.known: dict = {}

    def of(self, fingerprint, grid) -> list[tuple[int, float]]:
        if fingerprint is None:
            return self._found(grid)
        entry = self.known.get(fingerprint)
        if entry is None or entry[1] >= self.check_every:
            entry = self.known[fingerprint] = [self._found(grid), 0]
        entry[1] += 1
        return entry[0]

    def _found(self, grid) -> list[tuple[int, float]]:
        found = self.search(grid)
        far = [d for _, d in found if d > self.ceiling_km]
        if far:
            raise ValueError(f"a point is {max(far):.1f} km from its grid cell; at most {self.ceiling_km:g} is plausible")
        return found


@udtf(returnType="section_name string, section_text string")
class Sections:
    """Sections of one bulletin as a table function, for SQL with LATERAL; ``functions.text.sections`` is the fast way."""

    def eval(self, raw: str):
        import re

        parts = re.split(r"(?m)^\.([A-Z][A-Z0-9 /]+?)\.\.\.[ \t\r]*$", raw or "")
        if parts[0] or len(parts) == 1:
            yield "HEADER", parts[0]
        for name, body in zip(parts[1::2], parts[2::2], strict=True):
            yield name.strip(), body.strip()
