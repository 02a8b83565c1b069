"""Repeated passages by prefix-free parsing.

A rolling hash over 24-byte grams sets triggers: the smallest gram of every 50-byte string is one, so equal strings
share a trigger at the same place. The strings whose smallest gram is a given trigger lie side by side; the bytes they
span are that trigger's phrase, and phrases overlap so that every 50-byte string lies within exactly one. Equal text
parses into equal phrases, whatever surrounds it.

1. The parse: each batch of documents sends its distinct trigger grams, with the smallest document of each, to the
   ranges of a hash space; the answer says which grams occur in several documents. Only phrases of those matter.
2. The dictionary: each batch sends its distinct phrases of such grams, with the smallest document of each, to the
   range of the gram. A range sorts all suffixes of its distinct phrases by bytes, to the depth of a string, by prefix
   doubling (``suffix_ranks``): the suffix array of the dictionary. The suffix array of the parse lists the places of
   each phrase by document (``Parse``). Phrases overlap by a string less one byte, so no string goes on in the next
   phrase, and the parse is sorted to the depth of one phrase. The first array, each suffix replaced by the places of
   its phrase from the second, is the corpus order of the range's strings. A run of equal strings has one smallest
   document; the answer marks the suffixes of a phrase that a smaller document has.
3. Back in the documents, marked suffixes become removed runs.

Highly repetitive text thus costs one phrase per batch, however often it is repeated. Ranges are as many as the text
needs (``RANGE`` bytes each). A gram in very many phrases is cut in two: strings that start well before the trigger
meet by the bytes before it, the others by the bytes after it, so that different surroundings go to different ranges.
Strings and phrases are told apart by their bytes; hashes only deal them out (64-bit; trigger grams 48-bit).

Documents must come from a table, or a plan that yields the same rows in the same order each time: batches are read
three times and found again by a digest of their content; a batch that changed is an error.

Cases: null text is empty; texts shorter than ``size`` bytes are kept; rows with one id never remove each other's text;
a null id is neither removed from nor a source of removals; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, pieces, ranges_of, utf8, written

SIZE, GRAM = 50, 24
#: Text bytes of a batch, of what is parsed at once, and of what one range of grams is to hold the phrases of.
BATCH, PIECE, RANGE = 8 << 20, 1 << 20, 4 << 20
#: Phrases of one gram in the whole corpus beyond which its strings are dealt out by their surroundings too.
HOT = 1 << 16
ROW = "key string, part int, a binary, b binary, c binary"
_NAMES = ["key", "part", "a", "b", "c"]
_P = 0x9E3779B97F4A7C15 | 1
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _zstd():
    return pa.Codec("zstd", 3)


def pack(x: np.ndarray, rising: bool = False) -> bytes:
    """Compressed by byte planes; ``rising``: ascending values are stored as steps."""
    if not len(x):
        return bytes(8)
    if rising:
        x = np.concatenate([x[:1], np.diff(x)])
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return len(x).to_bytes(8, "little") + _zstd().compress(planes.tobytes(), asbytes=True)


def unpack(raw: bytes, dtype, rising: bool = False) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(_zstd().decompress(raw[8:], n * width, asbytes=True), np.uint8).reshape(width, n)
    x = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(x, dtype=dtype) if rising else x


class Powers:
    """Powers of the rolling hash's base and of its inverse, as many as were needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int):
        if len(self.up) <= n:
            n = max(n + 1, 2 * len(self.up))
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _P, np.uint64), dtype=np.uint64)])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, pow(_P, -1, 1 << 64), np.uint64), dtype=np.uint64)])
        return self.up, self.down


class Rolling:
    """Fingerprints of any substring of ``data``."""

    def __init__(self, data: np.ndarray, powers: Powers):
        up, self.down = powers.to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def parse(data: np.ndarray, offsets: np.ndarray, powers: Powers, size: int = SIZE, gram: int = GRAM):
    """Phrases of all texts: (row, first string's start, last string's start, trigger, gram, Rolling); places in ``data``."""
    roll = Rolling(data, powers)
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < size:
        return none, none, none, none, np.zeros(0, np.uint64), roll
    at = np.arange(n - gram + 1)
    h = roll.of(at, at + gram)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, have = size - gram + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    length = np.diff(offsets)
    row = np.repeat(np.arange(len(length)), np.maximum(length - size + 1, 0))
    before = np.concatenate([[0], np.cumsum(np.maximum(length - size + 1, 0))])[:-1]
    s = np.arange(len(row)) - before[row] + offsets[:-1][row]
    if not len(s):
        return none, none, none, none, np.zeros(0, np.uint64), roll
    t = (low[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (row[1:] != row[:-1])])
    i = np.flatnonzero(new)
    j = np.concatenate([i[1:], [len(s)]]) - 1
    return row[i], s[i], s[j], t[i], mixed(h[t[i]]) >> np.uint64(16), roll


class Batch:
    """Some documents and their phrases, in the order of the documents."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        self.ids, self.texts = ids, texts
        self.known = np.array([i is not None for i in ids], bool)
        self.doc = np.array([i or 0 for i in ids], np.int64)

    def key(self) -> str:
        h = hashlib.blake2b(np.concatenate([self.doc, self.known]).tobytes(), digest_size=16)
        for t in self.texts:
            h.update(len(t).to_bytes(8, "little") + t)
        return h.hexdigest()

    def phrases(self, powers: Powers, size: int):
        """(row, start in its text, strings, gram, hash, trigger after the start) of all phrases of documents with an id; long texts in overlapping parts."""
        parts = [(i, k, t[k : k + PIECE + size - 1]) for i, t in enumerate(self.texts) if self.known[i] for k in range(0, max(1, len(t) - size + 1), PIECE)]
        offsets = np.concatenate([[0], np.cumsum([len(p[2]) for p in parts])]).astype(np.int64)
        which, begin = np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)
        out: list[list] = [[], [], [], [], [], []]
        for i, j in pieces(offsets, PIECE):
            data = np.frombuffer(b"".join(p[2] for p in parts[i:j]), np.uint8)
            at = offsets[i : j + 1] - offsets[i]
            row, a, b, t, g, roll = parse(data, at, powers, size)
            e = mixed(roll.of(a, b + size) + (t - a).astype(np.uint64))
            for x, y in zip(out, (which[row + i], a - at[row] + begin[row + i], b - a + 1, g, e, t - a), strict=True):
                x.append(y)
        return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def _least(keys: np.ndarray, doc: np.ndarray):
    """Distinct keys ascending, the smallest doc of each, whether it has several docs, and each row's place in them."""
    order = np.lexsort((doc, keys))
    k, d = keys[order], doc[order]
    first = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    i = np.flatnonzero(first)
    last = np.concatenate([i[1:], [len(k)]]) - 1 if len(i) else i
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(first) - 1
    return k[i], d[i], d[last] != d[i], place, order[i]


def _range(g: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of the 48-bit space."""
    return ((g >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _stretches(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(range, from, to) for ascending ranges; those without an entry are left out."""
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    return [(int(part[i]), int(i), int(j)) for i, j in zip(at, np.append(at[1:], len(part)), strict=True)]


def padded(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """The bytes of each phrase as a row of 64-bit words, zeros behind them, the length last."""
    width = -(-width // 8) * 8
    out = np.zeros((len(start), width + 8), np.uint8)
    column = np.arange(width)
    for i in range(0, len(start), 1 << 14):
        s, n = start[i : i + (1 << 14), None], length[i : i + (1 << 14), None]
        out[i : i + (1 << 14), :width] = np.where(column < n, data[np.minimum(s + column, len(data) - 1)], 0)
    words = out.view(np.uint64)
    words[:, -1] = length
    return words


def hashed(words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words), np.uint64)
    for c in words.T:
        h = mixed(h * np.uint64(_P) + c)
    return h


def distinct(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(one phrase of each kind, the kind of each phrase). Equal hashes are compared by bytes."""
    words = padded(data, start, length, width)
    h = hashed(words)
    order = np.argsort(h, kind="stable")
    w = words[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]).any(1)]) if len(order) else np.zeros(0, bool)
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def _dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key; equal keys share one."""
    order = np.argsort(keys)
    k = keys[order]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(np.concatenate([[False], k[1:] != k[:-1]]), dtype=np.uint64) if len(k) else k
    return out


def suffix_ranks(data: np.ndarray, start: np.ndarray, strings: np.ndarray, size: int) -> np.ndarray:
    """For the suffixes at the first ``strings`` places of each phrase, in turn, their rank by their first ``size`` bytes.

    A phrase has ``strings + size - 1`` bytes. Eight bytes are sorted as big-endian numbers, then ranks of twice as many
    bytes are made from two ranks each, the last two overlapping.
    """
    if not len(start):
        return np.zeros(0, np.uint64)

    def places(depth: int) -> np.ndarray:
        """Where ``depth`` bytes of a phrase are left."""
        n = strings + size - depth
        before = np.cumsum(n) - n
        return np.repeat(start - before, n) + np.arange(int(n.sum()))

    code = data.astype(np.uint64)
    for k in (1, 2, 4):
        code = (code << np.uint64(8 * k)) | np.append(code[k:], np.zeros(min(k, len(code)), np.uint64))
    rank, depth, at = np.zeros(len(data), np.uint64), 8, places(8)
    rank[at] = _dense(code[at])
    while depth < size:
        step = min(depth, size - depth)
        at = places(depth + step)
        rank[at] = _dense((rank[at] << np.uint64(32)) | rank[at + step])
        depth += step
    return rank[at]


class Parse:
    """The suffix array of a range's parse, to the depth of one phrase: its places by phrase, then by document."""

    def __init__(self, kind: np.ndarray, doc: np.ndarray):
        self.order = np.lexsort((doc, kind))
        k = kind[self.order]
        self.first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        self.least = doc[self.order[self.first]]  # of each phrase's interval


def marks(data: np.ndarray, start: np.ndarray, strings: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """For each phrase a bit for each of its strings: does a smaller document have it?"""
    one, kind = distinct(data, start, strings + size - 1, 2 * size - GRAM)
    parse = Parse(kind, doc)
    n = strings[one]
    phrase = np.repeat(np.arange(len(one)), n)
    inner = np.arange(len(phrase)) - (np.cumsum(n) - n)[phrase]
    rank = suffix_ranks(data, start[one], n, size).astype(np.int64)
    order = np.argsort(rank, kind="stable")  # the suffix array of the dictionary; a run of equal ranks is one string
    run = np.flatnonzero(np.concatenate([[True], np.diff(rank[order]) > 0])) if len(order) else order
    least = np.minimum.reduceat(parse.least[phrase[order]], run) if len(order) else parse.least
    bit = np.where(least[rank] < parse.least[phrase], np.uint64(1) << inner.astype(np.uint64), np.uint64(0))
    own = np.bitwise_or.reduceat(bit, np.cumsum(n) - n) if len(bit) else bit
    every = (np.uint64(1) << strings.astype(np.uint64)) - np.uint64(1)
    return np.where(doc > parse.least[kind], every, own[kind])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32()] + [pa.binary()] * 3
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_NAMES)


def grouped(it, limit: int):
    ids, texts, total = [], [], 0
    for b in it:
        data, at = utf8(b.column(1))
        raw = data.tobytes()
        for i, doc in enumerate(b.column(0).to_pylist()):
            ids.append(doc)
            texts.append(raw[at[i] : at[i + 1]])
            total += len(texts[-1]) + 1
            if total >= limit:
                yield Batch(ids, texts)
                ids, texts, total = [], [], 0
    if ids:
        yield Batch(ids, texts)


def grams(docs: DataFrame, parts: int, limit: int, size: int) -> DataFrame:
    """What each batch asks about its trigger grams: (grams, smallest documents, twice the phrases and one if of several documents)."""

    def ask(it):
        powers = Powers()
        for batch in grouped(it, limit):
            row, _, _, g, *_ = batch.phrases(powers, size)
            g, doc, several, place, _ = _least(g, batch.doc[row])
            more = 2 * np.bincount(place, minlength=len(g)) + several
            key = batch.key()
            yield _rows([(key, k, pack(g[i:j], True), pack(doc[i:j]), pack(more[i:j])) for k, i, j in _stretches(_range(g, parts))])

    return docs.mapInArrow(ask, ROW)


def shared_grams(requests: DataFrame, hot: int) -> DataFrame:
    """For each gram asked about: 0 if one document has it, 1 if several do and the batch has the smallest, 2 if not; 4 more if it is hot."""

    def answer(table: pa.Table) -> pa.Table:
        keys, part = table.column("key").to_pylist(), table.column("part")[0].as_py()
        g, doc, more = ([unpack(x, kind, up) for x in table.column(c).to_pylist()] for c, kind, up in (("a", np.uint64, True), ("b", np.int64, False), ("c", np.int64, False)))
        size = [len(x) for x in g]
        doc, more = np.concatenate(doc), np.concatenate(more)
        _, least, several, place, _ = _least(np.concatenate(g), doc)
        inner = np.bincount(place, more & 1, len(least)) > 0
        phrases = np.bincount(place, more >> 1, len(least))
        every = np.where((inner | several)[place], np.where(doc > least[place], 2, 1) + np.where(phrases[place] > hot, 4, 0), 0).astype(np.uint8)
        found = dict(zip(keys, np.split(every, np.cumsum(size)[:-1]), strict=True))
        return pa.Table.from_batches([_rows([(k, part, pack(x), None, None) for k, x in found.items()])])

    return requests.groupBy("part").applyInArrow(answer, ROW)


def stored(docs: DataFrame, limit: int) -> DataFrame:
    """The batches: (part -1, ids, lengths, text)."""

    def store(it):
        for b in grouped(it, limit):
            text = b"".join(b.texts)
            head = pack(b.doc)
            yield _rows([(b.key(), -1, len(head).to_bytes(8, "little") + head + pack(b.known), pack(np.array([len(t) for t in b.texts], np.int64)), len(text).to_bytes(8, "little") + (_zstd().compress(text, asbytes=True) if text else b""))])

    return docs.mapInArrow(store, ROW)


def _restored(a: bytes, b: bytes, c: bytes) -> Batch:
    n = int.from_bytes(a[:8], "little")
    doc, known, length = unpack(a[8 : 8 + n], np.int64), unpack(a[8 + n :], np.bool_), unpack(b, np.int64)
    total = int.from_bytes(c[:8], "little")
    text = _zstd().decompress(c[8:], total, asbytes=True) if total else b""
    at = np.concatenate([[0], np.cumsum(length)])
    return Batch([int(d) if k else None for d, k in zip(doc, known, strict=True)], [text[i:j] for i, j in zip(at[:-1], at[1:], strict=True)])


class Group:
    """A group's batches and the phrases whose gram several documents have."""

    def __init__(self, table: pa.Table, parts: int, size: int):
        rows = sorted(zip(*[table.column(c).to_pylist() for c in _NAMES], strict=True), key=lambda r: r[1])
        self.key, self.size, self.parts = rows[0][0], size, parts
        self.batches = [_restored(*r[2:]) for r in rows if r[1] < 0]
        self.known = [unpack(r[2], np.uint8) for r in rows if 0 <= r[1] < parts]
        self.masks = {r[1] - parts: unpack(r[2], np.uint64) for r in rows if r[1] >= parts}
        if not self.batches:
            return
        batch = self.batches[0]  # batches of one key are equal
        row, start, strings, g, e, t = batch.phrases(Powers(), size)
        every, _, _, place, _ = _least(g, batch.doc[row])
        state = np.concatenate(self.known or [np.zeros(0, np.uint8)])
        if len(state) != len(every):
            raise RuntimeError("the documents changed while they were read; use a written table")
        state = state[place]
        live = state > 0
        row, start, strings, g, e, t, hot = (x[live] for x in (row, start, strings, g, e, t, state > 3))
        self.data = np.frombuffer(b"".join(batch.texts), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(x) for x in batch.texts])])[:-1].astype(np.int64)
        if hot.any():
            cut = self._halves(*(x[hot] for x in (row, start, strings, t)))
            row, start, strings, g, e = (np.concatenate([x[~hot], y]) for x, y in zip((row, start, strings, g, e), cut, strict=True))
            order = np.lexsort((start, row))
            row, start, strings, g, e = (x[order] for x in (row, start, strings, g, e))
        self.row, self.start, self.strings, self.g, self.e = row, start, strings, g, e
        # distinct phrases by range, then hash; equal hashes are compared by bytes
        part = _range(self.g, parts)
        order = np.lexsort((batch.doc[self.row], self.e, part))
        ps, es = part[order], self.e[order]
        first = np.concatenate([[True], (ps[1:] != ps[:-1]) | (es[1:] != es[:-1])]) if len(order) else np.zeros(0, bool)
        again = np.flatnonzero(~first)
        for k in range(0, len(again), 1 << 15):
            i = again[k : k + (1 << 15)]
            first[i] = (self._bytes(order[i]) != self._bytes(order[i - 1])).any(1)
        self.one = order[np.flatnonzero(first)]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(first) - 1
        self.cut = _stretches(part[self.one])

    def _bytes(self, which: np.ndarray) -> np.ndarray:
        return padded(self.data, self.begin[self.row[which]] + self.start[which], self.strings[which] + self.size - 1, 2 * self.size - GRAM)

    def _halves(self, row: np.ndarray, start: np.ndarray, strings: np.ndarray, t: np.ndarray):
        """Each phrase as two: strings that have at least ``half`` bytes before the trigger, and the others; dealt by more than the gram."""
        half = (self.size - GRAM + 1) // 2
        early = np.clip(t - half + 1, 0, strings)  # how many strings start early enough
        out = []
        for first, n, low, width in ((start, early, t - half, half + GRAM), (start + early, strings - early, t, self.size - half + 1)):
            some = n > 0
            r, f = row[some], first[some]
            at = self.begin[r] + start[some] + low[some]
            g = hashed(padded(self.data, at, np.full(len(at), width), width)) >> np.uint64(16)
            e = hashed(padded(self.data, self.begin[r] + f, n[some] + self.size - 1, 2 * self.size - GRAM))
            out.append((r, f, n[some], g, e))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    def ask(self) -> pa.RecordBatch:
        batch, rows = self.batches[0], []
        for k, i, j in self.cut:
            p = self.one[i:j]
            text = b"".join(batch.texts[r][s : s + n + self.size - 1] for r, s, n in zip(self.row[p].tolist(), self.start[p].tolist(), self.strings[p].tolist(), strict=True))
            rows.append((self.key, k, len(text).to_bytes(8, "little") + _zstd().compress(text, asbytes=True), pack(self.strings[p].astype(np.uint8)), pack(batch.doc[self.row[p]])))
        return _rows(rows)

    def marked(self) -> list[list]:
        """For each document the starts of strings that a smaller document has, as (start, end) ranges."""
        batch = self.batches[0]
        out: list[list] = [[] for _ in batch.ids]
        if not len(self.place):
            return out
        masks = np.concatenate([self.masks[k] for k in sorted(self.masks)] or [np.zeros(0, np.uint64)])
        if len(masks) != len(self.one):
            raise RuntimeError("the documents changed while they were read; use a written table")
        smaller = batch.doc[self.row[self.one]][self.place] < batch.doc[self.row]
        mask = np.where(smaller, np.uint64(0xFFFFFFFFFFFFFFFF), masks[self.place])
        hit = np.flatnonzero(mask)
        for r, s, n, m in zip(self.row[hit].tolist(), self.start[hit].tolist(), self.strings[hit].tolist(), mask[hit].tolist(), strict=True):
            ranges = out[r]
            if m & ((1 << n) - 1) == (1 << n) - 1:
                found = [(s, s + n)]
            else:
                found = [(s + k, s + k + 1) for k in range(n) if m >> k & 1]
            for a, b in found:
                b += self.size - 1
                if ranges and a <= ranges[-1][1]:
                    ranges[-1][1] = max(b, ranges[-1][1])
                else:
                    ranges.append([a, b])
        return out


def ordered(requests: DataFrame, parts: int, size: int) -> DataFrame:
    """For each phrase asked about a bit mask: which of its strings a smaller document has."""

    def answer(table: pa.Table) -> pa.Table:
        keys, part = table.column("key").to_pylist(), table.column("part")[0].as_py()
        texts = [_zstd().decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in table.column("a").to_pylist()]
        strings = [unpack(x, np.uint8).astype(np.int64) for x in table.column("b").to_pylist()]
        doc = np.concatenate([unpack(x, np.int64) for x in table.column("c").to_pylist()])
        n = np.concatenate(strings)
        length = n + size - 1
        masks = marks(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(length) - length, n, doc, size)
        found = dict(zip(keys, np.split(masks, np.cumsum([len(x) for x in strings])[:-1]), strict=True))
        return pa.Table.from_batches([_rows([(k, parts + part, pack(m), None, None) for k, m in found.items()])])

    return requests.groupBy("part").applyInArrow(answer, ROW)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, limit: int = BATCH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, spans array<struct<start,end>>, kept binary): byte runs that a document with a smaller id has too."""
    if not GRAM < size <= GRAM + 63:
        raise ValueError(f"size must be {GRAM + 1} to {GRAM + 63}")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = ranges_of(d, RANGE)
    known = written(shared_grams(grams(d, parts, limit, size), hot), "grams")

    def ask(table: pa.Table) -> pa.Table:
        g = Group(table, parts, size)
        return pa.Table.from_batches([g.ask() if g.batches else _rows([])])

    requests = known.unionByName(stored(d, limit)).groupBy("key").applyInArrow(ask, ROW)
    masks = written(ordered(requests, parts, size), "masks")

    def finish(table: pa.Table) -> pa.Table:
        g = Group(table, parts, size)
        rows: list[list] = [[], [], [], []]
        if g.batches:
            spans = g.marked()
            for batch in g.batches:
                for doc, text, found in zip(batch.ids, batch.texts, spans, strict=True):
                    kept, last = [], 0
                    for a, b in found:
                        kept.append(text[last:a])
                        last = b
                    rows[0].append(doc)
                    rows[1].append(len(text))
                    rows[2].append([{"start": a, "end": b} for a, b in found])
                    rows[3].append(b"".join([*kept, text[last:]]))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], span), pa.array(rows[3], pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return known.unionByName(masks).unionByName(stored(d, limit)).groupBy("key").applyInArrow(finish, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def digest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return repeated_passages(docs, **options).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
