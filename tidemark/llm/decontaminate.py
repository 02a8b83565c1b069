"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of ``window`` consecutive words of a benchmark item is a pattern. Patterns of one length share a block
shift table: the last ``block`` words of the current text window say how far the search may jump; where the jump is
zero, the block's bucket of patterns is consulted and the words are compared directly.

A small benchmark is one broadcast. Beyond ``BLOCK_BYTES`` the patterns stay a table: the shift tables are indexed by a
hash of the block, as in the paper, and computed by a grouped minimum; a bit map of pattern hashes stands for the
buckets. Both are sized by the counted patterns (``SLOTS_EACH`` slots and ``BITS_EACH`` bits a pattern, at most one window
of unrelated text in a thousand passes), put together on executors in pieces of 64 kB, and all that is broadcast. One pass
over the documents gives the windows that pass both, and these are joined with the patterns and compared word by word.
More than ``PART`` patterns are dealt by hash into parts of at most so many, each with tables and a pass of its own, so
that no broadcast grows with the benchmark. An item of any size is cut into its windows where it is read.

Cases: null or empty text has no words; a null or wordless item has no window; an item with fewer words than the
window is one window; items with equal windows are all reported; words hit by an item with a null id are hit, but the
item has no name to report; repeated rows give repeated results; a null id stays.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, let, running, written

#: Benchmark text whose patterns are broadcast as they are (measured: 45 MB in a Python worker for half a MB of text).
BLOCK_BYTES = 1 << 19
#: Beyond that: slots and bits a pattern has in the tables, and bits that it sets; patterns of one pass (52 MB of tables).
SLOTS_EACH, BITS_EACH, SET, PART = 4, 16, 6, 1 << 23
#: Bytes of a piece of a table, as the executors make it.
PIECE = 1 << 16

#: Fixed: letters, digits and everything beyond ASCII make words, A-Z are lowered.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class WuManber:
    """Search for patterns of one length (in words)."""

    def __init__(self, patterns, length: int, block: int = 2):
        self.m, self.b = length, min(block, length)
        self.jump = self.m - self.b + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, set] = {}
        for p in patterns:
            for end in range(self.b, self.m + 1):
                key = p[end - self.b : end]
                self.shift[key] = min(self.shift.get(key, self.jump), self.m - end)
            self.bucket.setdefault(p[self.m - self.b :], set()).add(p)

    def find(self, text: list[bytes]):
        """Starts of all occurrences, ascending."""
        m, b, jump, shift, bucket = self.m, self.b, self.jump, self.shift.get, self.bucket
        end, n = m, len(text)
        while end <= n:
            key = tuple(text[end - b : end])
            s = shift(key, jump)
            if s:
                end += s
                continue
            window = tuple(text[end - m : end])
            if window in bucket[key]:
                yield end - m, window
            end += 1


def windows(items, window: int = 10) -> dict[tuple, list]:
    """Pattern -> ids of the items that have it."""
    found: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[i : i + window]), set()).add(item)
    return {k: list(v) for k, v in found.items()}


class Search:
    """All patterns of a benchmark block, by length."""

    def __init__(self, patterns: dict[tuple, list]):
        self.items = patterns
        by: dict[int, list] = {}
        for p in patterns:
            by.setdefault(len(p), []).append(p)
        self.engines = [WuManber(ps, m) for m, ps in sorted(by.items())]

    def spans(self, text: list[bytes]) -> tuple[list[list[int]], set]:
        """Merged word ranges that occurrences cover, and the items they come from."""
        raw, items = [], set()
        for e in self.engines:
            for start, p in e.find(text):
                raw.append((start, start + e.m))
                items.update(self.items[p])
        return merged(raw), items


def merged(ranges) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


SPANS = "doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"


def _spans(docs: DataFrame, search) -> DataFrame:
    def scan(it):
        s = search.value
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
        for b in batches(it):
            n, starts, ends, items = [], [], [], []
            for text in b.column(1).to_pylist():
                w = words(text)
                found, ids = s.spans(w)
                n.append(len(w))
                starts.append([x[0] for x in found])
                ends.append([x[1] for x in found])
                items.append(sorted(str(i) for i in ids if i is not None))
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), *[pa.array(x, schema.field(k).type) for k, x in enumerate((starts, ends, items), 2)]], schema=schema)

    return docs.mapInArrow(scan, SPANS)


def pattern_hash(pattern: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(pattern, digest_size=8).digest(), "little", signed=True)


def patterns_of(items: DataFrame, window: int) -> DataFrame:
    """(m, h, w, item_id): every window of (item_id, text) with its number of words and its hash, once an item."""

    def cut(it):
        def each():
            for b in it:
                for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    w = words(text)
                    for i in range(max(1, len(w) - window + 1) if w else 0):
                        yield min(window, len(w)), b" ".join(w[i : i + window]), item

        found = each()
        while part := list(islice(found, 20_000)):
            m, w, item = zip(*part, strict=True)
            yield pa.record_batch([pa.array(m, pa.int32()), pa.array([pattern_hash(x) for x in w], pa.int64()), pa.array(w, pa.binary()), pa.array(item, pa.string())], names=["m", "h", "w", "item_id"])

    return items.mapInArrow(cut, "m int, h bigint, w binary, item_id string").distinct()


def power(n: int) -> int:
    """The power of two that is not below ``n``, at least a piece."""
    return max(PIECE, 1 << (n - 1).bit_length())


def places(h: int, bits: int) -> list[int]:
    """The bits of a pattern: two halves of its hash walk through the map."""
    step = h >> 32 | 1
    return [(h + k * step) % bits for k in range(SET)]


def gathered(cells: DataFrame, values: str, size: dict[int, int], fill: dict[int, int]) -> dict[int, np.ndarray]:
    """Tables of bytes by kind, from (kind, at, value) with one row a place; executors make the pieces."""

    def piece(key: tuple, rows: pa.Table) -> pa.Table:
        kind, number = key[0].as_py(), key[1].as_py()
        out = np.full(PIECE, fill[kind], np.uint8)
        out[rows.column("at").to_numpy() % PIECE] = rows.column(values).to_numpy()
        return pa.table([pa.array([kind], pa.int32()), pa.array([number], pa.int64()), pa.array([out.tobytes()], pa.binary())], names=["kind", "piece", "bytes"])

    pieces = cells.withColumn("piece", F.floor(F.col("at") / PIECE)).groupBy("kind", "piece").applyInArrow(piece, "kind int, piece long, bytes binary")
    tables = {k: np.full(n, fill[k], np.uint8) for k, n in size.items()}
    for kind, number, raw in pieces.toLocalIterator():  # the size of the tables, no more
        tables[kind][number * PIECE : (number + 1) * PIECE] = np.frombuffer(raw, np.uint8)
    return tables


class Tables:
    """Shift tables by length, indexed by a hash of the block, and the bit map of whole patterns; sized by the patterns."""

    def __init__(self, shifts: dict[int, np.ndarray], bits: np.ndarray, block: int = 2):
        self.shifts, self.bits, self.block = shifts, bits, block

    @staticmethod
    def slot(words_: list[bytes], slots: int) -> int:
        return zlib.crc32(b" ".join(words_)) % slots

    @classmethod
    def of(cls, patterns: DataFrame, block: int = 2) -> Tables:
        """From (m, h, w): the least shift of each slot and the bits that are set."""
        counts = dict(patterns.select("m", "h").distinct().groupBy("m").count().collect())  # a row a length
        slots = {m: power(SLOTS_EACH * n) for m, n in counts.items()}
        n_bits = 8 * power(BITS_EACH * sum(counts.values()) // 8)

        def shifts(it):
            for b in it:
                least: dict[tuple, int] = {}
                for m, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    p, size = w.split(b" "), min(block, m)
                    for end in range(size, m + 1):
                        key = (m, cls.slot(p[end - size : end], slots[m]))
                        least[key] = min(least.get(key, 255), m - end)
                yield pa.record_batch([pa.array([k[0] for k in least], pa.int32()), pa.array([k[1] for k in least], pa.int64()), pa.array(list(least.values()), pa.int32())], names=["kind", "at", "shift"])

        def bits(it):
            for b in it:
                at = [x for h in b.column(0).to_pylist() for x in places(h, n_bits)]
                yield pa.record_batch([pa.array([0] * len(at), pa.int32()), pa.array([x // 8 for x in at], pa.int64()), pa.array([1 << x % 8 for x in at], pa.int32())], names=["kind", "at", "bit"])

        cells = patterns.select("m", "w").mapInArrow(shifts, "kind int, at long, shift int").groupBy("kind", "at").agg(F.min("shift").alias("shift"))
        tables = gathered(cells, "shift", slots, {m: min(255, m - min(block, m) + 1) for m in slots})
        cells = patterns.select("h").mapInArrow(bits, "kind int, at long, bit int").groupBy("kind", "at").agg(F.bit_or("bit").alias("bit"))
        return cls(dict(sorted(tables.items())), gathered(cells, "bit", {0: n_bits // 8}, {0: 0})[0], block)

    def find(self, text: list[bytes]):
        """(start, words, hash, window) of all windows that the tables cannot rule out."""
        known, n_bits = self.bits, 8 * len(self.bits)
        for m, shift in self.shifts.items():
            b, end, n, slots = min(self.block, m), m, len(text), len(shift)
            while end <= n:
                if s := shift[self.slot(text[end - b : end], slots)]:
                    end += int(s)
                    continue
                window = b" ".join(text[end - m : end])
                h = pattern_hash(window)
                if all(known[x >> 3] >> (x & 7) & 1 for x in places(h, n_bits)):
                    yield end - m, m, h, window
                end += 1


def candidates(docs: DataFrame, tables) -> DataFrame:
    """One pass: a row for each document (m = 0), and one for each window (start, m, h, w) that may be a pattern; digest: SHA-256 of the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()), ("start", pa.int64()), ("m", pa.int32()), ("h", pa.int64()), ("w", pa.binary())])

    def scan(it):
        t = tables.value
        for b in batches(it):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w, digest = words(text), hashlib.sha256((text or "").encode()).digest()
                rows.append((doc, digest, len(w), None, 0, None, None))
                for start, m, h, window in t.find(w):
                    rows.append((None, digest, None, start, m, h, window))
                    if len(rows) >= 20_000:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.mapInArrow(scan, "doc_id bigint, digest binary, n_words bigint, start bigint, m int, h bigint, w binary")


def united(spans: Column) -> Column:
    """Sorted spans with those that touch made one."""

    def of(s: Column) -> Column:
        return let(F.struct(s.alias("s"), running(F.transform(s, lambda x: x["end"]), F.greatest).alias("e")), groups)

    def groups(q: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(q["s"]) - 1), lambda i: F.when(i == 0, True).otherwise(F.get(q["s"], i)["start"] > F.get(q["e"], i - 1)))
        return let(first, lambda g: F.transform(g, lambda x, j: F.struct(F.get(q["s"], x)["start"].alias("start"), F.get(q["e"], F.coalesce(F.get(g, j + 1), F.size(q["s"])) - 1).alias("end"))))

    return let(spans, of)


def large_search(docs: DataFrame, items: DataFrame, window: int, part: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, n_words) of all documents, and (digest, spans, items) of the texts with an occurrence."""
    patterns = written(patterns_of(items, window), "patterns")
    parts = max(1, -(-patterns.select("m", "h").distinct().count() // part))
    scans = []
    for k in range(parts):
        some = patterns.filter(F.pmod("h", F.lit(parts)) == k)
        tables = docs.sparkSession.sparkContext.broadcast(Tables.of(some.select("m", "h", "w")))
        scans.append(written(candidates(docs, tables), "candidates"))
    scan = scans[0]
    found = reduce(DataFrame.union, [x.filter("m > 0").select("digest", "start", "m", "h", "w") for x in scans])
    named = patterns.groupBy("m", "h", "w").agg(F.collect_set("item_id").alias("items"))
    hits = found.distinct().join(named, ["m", "h", "w"])
    hits = hits.groupBy("digest").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("m")).alias("end")))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return scan.filter("m = 0").select("doc_id", "digest", "n_words"), written(hits.select("digest", united(F.col("s")).alias("spans"), "items"), "hits")


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text).alias("text")).filter("text is not null")


def small_search(items: DataFrame, window: int, block_bytes: int):
    """A broadcast search for all items, or None if they have more than ``block_bytes`` (summed here)."""
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return items.sparkSession.sparkContext.broadcast(Search(windows(((r[0], r[1]) for r in items.toLocalIterator()), window))) if total <= block_bytes else None


def clean_documents(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, part: int = PART) -> DataFrame:
    """The rows of ``docs`` whose own ``text`` has no benchmark window, with their own columns; a row is judged by its text, whatever its id. A null text stays."""
    items = _items(benchmark, item_col, item_text)
    search = small_search(items, window, block_bytes)
    if search is None:
        _, hits = large_search(docs.select(F.lit(None).cast("long").alias("doc_id"), "text"), items, window, part)
        rows = docs.select(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        return rows.join(hits.select("digest"), "digest", "left_anti").select("row.*")

    def keep(it):
        s = search.value
        for b in batches(it):
            yield b.filter(pa.array([not s.spans(words(t))[0] for t in b.column(b.schema.get_field_index("text")).to_pylist()], pa.bool_()))

    plain = docs.toDF(*["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])  # any names are right
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def benchmark_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, part: int = PART) -> DataFrame:
    """(doc_id, n_words, spans array<struct<start,end>> in words, items array<string>) for every document.

    The benchmark is the stated query set. Its size is summed first; up to ``block_bytes`` its patterns are one broadcast,
    beyond that hashed tables are, and what passes them is joined with the patterns. The documents are read once for each
    ``part`` patterns.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = _items(benchmark, item_col, item_text)
    search = small_search(items, window, block_bytes)
    kind = "array<struct<start:bigint,end:bigint>>"
    if search is not None:
        return _spans(d, search).select("doc_id", "n_words", F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).cast(kind).alias("spans"), "items")
    every, hits = large_search(d, items, window, part)
    return every.join(hits, "digest", "left").select("doc_id", "n_words", F.coalesce(F.col("spans").cast(kind), F.array().cast(kind)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest: n_words, n_hit (words inside occurrences), n_items, items_sha256, contaminated."""
    s = benchmark_spans(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return s.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
