"""Language-model scores by deleted interpolation.

P(w | v) = a(b) c(v, w) / c(v) + l(b) c(w) / N + z(b) / (V + 1), where b is the context's frequency bucket (powers of
two of c(v)) and the weights of each bucket are learned by expectation-maximisation on held-out counts: a tenth of the
training documents is held out of the counts, and its tokens' estimates from the other nine tenths are what EM sees.
The scores then use the counts of all training documents.

Counts cover the whole corpus and never meet in one place. A task turns a batch of documents into its distinct words
and word pairs (sorted 64-bit and 56-bit hashes with counts), and sends each range of hashes to its own group; the
group adds the counts of all batches and answers every batch with the totals of what it asked about. Hot words and
pairs thus arrive once a batch, not once a use. Answers carry the batch's fingerprint (of its ids, role and tokens), so a
batch that is read again finds its own answer, and one that changed is an error rather than a wrong score. The documents
must therefore be a table, or a plan that yields the same rows in the same order each time. Counts are 64-bit.

EM sees the held-out tokens in cells of a quarter of an octave in both estimates; a cell stands for its tokens with their
mean estimates, not with its middle. The cells are bounded by buckets and bins and are all that reaches the driver; a
test holds weights and scores against EM over every token. After a context that was never seen the bigram estimate is
always 0: its weight is 0 there, and the other two sum to one.

Cases: null and empty text is one end token; a null id is scored, but not learned from; without training documents
counts are 0 and only the uniform part is left; repeated rows count and are scored each, also if equal texts are in
training and held-out documents; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, ranges_of, utf8, written

#: Text bytes of a batch, and of what one range of hashes is to hold the counts of; buckets of contexts; bins of an estimate, four an octave, the last for zero.
BATCH, RANGE, BUCKETS, BINS = 8 << 20, 4 << 20, 40, 161
DEFAULT = (0.3, 0.65, 0.05)
END, START = b"\n", b"\r"  # no word holds these
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = np.uint64(0x9FB21C651E98DF25)
ROW = "key string, part int, a binary, b binary, c binary, d binary, e binary"
_NAMES = ["key", "part", "a", "b", "c", "d", "e"]
_ZSTD = None


def _codec():
    global _ZSTD
    if _ZSTD is None:
        _ZSTD = pa.Codec("zstd", 1)
    return _ZSTD


def pack(x: np.ndarray, rising: bool = False) -> bytes:
    """Compressed by byte planes; ``rising``: ascending values are stored as steps."""
    if rising and len(x):
        x = np.concatenate([x[:1], np.diff(x)])
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return len(x).to_bytes(8, "little") + (_codec().compress(planes.tobytes(), asbytes=True) if len(x) else b"")


def unpack(raw: bytes, dtype, rising: bool = False) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(_codec().decompress(raw[8:], n * size, asbytes=True), np.uint8).reshape(size, n)
    x = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(x, dtype=dtype) if rising else x


class Local(dict):
    """Words of a batch, numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Batch:
    """Tokens of some documents. ``token``: places in ``words`` (ascending hashes); ``pair``: places in ``pairs``."""

    def __init__(self, texts: list[bytes]):
        known = Local()
        self.start, self.end = known[START], known[END]
        lists = [t.translate(_LOWER).split() for t in texts]
        self.n = np.array([len(w) + 1 for w in lists], np.int64)
        stop = [END]
        flat = np.fromiter((known[w] for words in lists for part in (words, stop) for w in part), np.int64, int(self.n.sum()))
        h = np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in known), np.uint64, len(known))
        order = np.argsort(h, kind="stable")
        place = np.empty(len(h), np.int64)
        place[order] = np.arange(len(h))
        self.words, self.token = h[order], place[flat].astype(np.uint32)
        self.start, self.end = int(place[0]), int(place[1])
        self._pairs()

    def _pairs(self):
        self.before = np.empty_like(self.token)
        if len(self.token):
            self.before[1:] = self.token[:-1]
            self.before[np.concatenate([[0], np.cumsum(self.n)[:-1]])] = self.start
        h = mixed(self.words[self.before] * _STEP + self.words[self.token]) >> np.uint64(8)
        self.pairs, self.pair = np.unique(h, return_inverse=True)

    @classmethod
    def stored(cls, n: np.ndarray, words: np.ndarray, token: np.ndarray, start: int, end: int) -> Batch:
        self = cls.__new__(cls)
        self.n, self.words, self.token, self.start, self.end = n, words, token, start, end
        self._pairs()
        return self

    def key(self, ids: list[int | None], held: bool) -> str:
        """What tells a batch from all others: its role, its ids, and its tokens."""
        h = hashlib.blake2b(repr((held, ids)).encode(), digest_size=16)
        for x in (self.n, self.words, self.token):
            h.update(len(x).to_bytes(8, "little") + x.tobytes())
        return h.hexdigest()


def _ranges(hashes: np.ndarray, parts: int, bits: int) -> dict[int, slice]:
    """Of ``parts`` equal ranges of the hash space those that ascending ``hashes`` fall into, and where."""
    r = ((hashes >> np.uint64(bits - 32)) * np.uint64(parts)) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.zeros(0, np.int64)
    return {int(r[i]): slice(int(i), int(j)) for i, j in zip(at, np.append(at[1:], len(r)), strict=True)}


def grouped(it, limit: int, wanted=None):
    """(ids, roles, texts) of about ``limit`` bytes each: documents that EM holds out apart from the others."""
    held: list[list] = [[], [], [], 0]
    rest: list[list] = [[], [], [], 0]
    for b in it:
        data, at = utf8(b.column(1))
        raw = data.tobytes()
        for i, (doc, role) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
            g = held if role == 2 else rest
            if wanted is not None and (role == 2) != wanted:
                continue
            g[0].append(doc)
            g[1].append(role)
            g[2].append(raw[at[i] : at[i + 1]])
            g[3] += int(at[i + 1] - at[i]) + 1
            if g[3] >= limit:
                yield g[0], g[1], g[2]
                g[0], g[1], g[2], g[3] = [], [], [], 0
    for g in (held, rest):
        if g[0]:
            yield g[0], g[1], g[2]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32()] + [pa.binary()] * 5
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_NAMES)


def asked(docs: DataFrame, parts: int, limit: int) -> DataFrame:
    """What each batch asks each range of hashes: words, their counts, pairs, their counts, held-out ones among them."""

    def ask(it):
        none = slice(0, 0)
        for ids, roles, texts in grouped(it, limit):
            b = Batch(texts)
            role = np.repeat(np.array(roles), b.n)
            counts = [np.bincount(x[role >= 1], minlength=size) for x, size in ((b.token, len(b.words)), (b.pair, len(b.pairs)))]
            held = roles[0] == 2
            key, words, pairs = b.key(ids, held), _ranges(b.words, parts, 64), _ranges(b.pairs, parts, 56)
            rows = []
            for k in sorted(words.keys() | pairs.keys()):
                w, p = words.get(k, none), pairs.get(k, none)
                rows.append((key, k, pack(b.words[w], True), pack(counts[0][w]), pack(b.pairs[p], True), pack(counts[1][p]), bytes([held])))
            yield _rows(rows)

    return docs.mapInArrow(ask, ROW)


def _totals(hashes: list[np.ndarray], counts: list[np.ndarray], held: list[bool]):
    """Per list, the sums of its hashes over all lists, and the sums over held-out lists."""
    every, at = np.unique(np.concatenate(hashes), return_inverse=True)
    size = [len(h) for h in hashes]
    c = np.concatenate(counts).astype(np.int64)
    h = np.where(np.repeat(np.array(held), size), c, 0)
    total, out = (np.bincount(at, x, len(every)).astype(np.int64) for x in (c, h))  # sums in doubles: exact to 2**53
    ends = np.cumsum(size)[:-1]
    return np.split(total[at], ends), np.split(out[at], ends), int((total > 0).sum()), int(total.sum()), int(out.sum())


def answered(requests: DataFrame) -> DataFrame:
    """Rows back to the batches (a to d: totals and held-out counts of words and pairs), and one row of sums a range (key null)."""

    def answer(table: pa.Table) -> pa.Table:
        cols = [table.column(c).to_pylist() for c in _NAMES]
        held = [x[0] == 1 for x in cols[6]]
        wt, wh, v, n, nh = _totals([unpack(x, np.uint64, True) for x in cols[2]], [unpack(x, np.int64) for x in cols[3]], held)
        pt, ph, *_ = _totals([unpack(x, np.uint64, True) for x in cols[4]], [unpack(x, np.int64) for x in cols[5]], held)
        part = cols[1][0]
        rows = {}
        for i, key in enumerate(cols[0]):  # equal batches get one answer
            rows[key] = (key, part, pack(wt[i]), pack(wh[i]), pack(pt[i]), pack(ph[i]), bytes([held[i]]))
        sums = (None, part, v.to_bytes(8, "little"), n.to_bytes(8, "little"), nh.to_bytes(8, "little"), b"", b"")
        return pa.Table.from_batches([_rows([sums, *rows.values()])])

    return requests.groupBy("part").applyInArrow(answer, ROW)


def tokens(docs: DataFrame, limit: int, wanted: bool | None) -> DataFrame:
    """The batches themselves (part -1): ids, lengths, words, tokens; ``wanted``: held out of EM, or not, or both."""

    def store(it):
        for ids, roles, texts in grouped(it, limit, wanted):
            b = Batch(texts)
            known = np.array([(i is not None) for i in ids], np.uint8)
            doc = pack(np.array([i or 0 for i in ids], np.int64))
            head = len(doc).to_bytes(8, "little") + doc + pack(known)
            yield _rows([(b.key(ids, roles[0] == 2), -1, head, pack(b.n), pack(b.words, True), pack(b.token), b.start.to_bytes(8, "little") + b.end.to_bytes(8, "little"))])

    return docs.mapInArrow(store, ROW)


class Answered:
    """A group's batches with the counts they asked for."""

    def __init__(self, table: pa.Table):
        cols = [table.column(c).to_pylist() for c in _NAMES]
        rows = sorted(zip(*cols, strict=True), key=lambda r: r[1])
        own = [r for r in rows if r[1] < 0]
        parts = [r for r in rows if r[1] >= 0]
        self.counts = [np.concatenate([unpack(r[c], np.int64) for r in parts] or [np.zeros(0, np.int64)]) for c in (2, 3, 4, 5)]
        self.batches = []
        for r in own:
            size = int.from_bytes(r[2][:8], "little")
            ids, known = unpack(r[2][8 : 8 + size], np.int64), unpack(r[2][8 + size :], np.uint8)
            b = Batch.stored(unpack(r[3], np.int64), unpack(r[4], np.uint64, True), unpack(r[5], np.uint32), int.from_bytes(r[6][:8], "little"), int.from_bytes(r[6][8:], "little"))
            if len(self.counts[0]) != len(b.words) or len(self.counts[2]) != len(b.pairs):
                raise RuntimeError("the documents changed while they were scored; score a written table")
            self.batches.append((ids, known.astype(bool), b))

    def estimates(self, b: Batch, n: int, kept: bool):
        """c(w), c(v), P2, P1 of each token; ``kept``: from what EM does not hold out."""
        words, pairs = self.counts[0], self.counts[2]
        if kept:
            words, pairs = words - self.counts[1], pairs - self.counts[3]
        c, context = words[b.token], words[b.before]
        context = np.where(b.before == b.start, words[b.end], context)  # every document has one start and one end
        return c, context, pairs[b.pair] / np.maximum(context, 1), c / max(n, 1)


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(context + 1.0)).astype(np.int64), BUCKETS - 1)


def bins(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.clip(np.floor(-4 * np.log2(np.maximum(p, 1e-300))), 0, BINS - 2), BINS - 1).astype(np.int64)


def mixture(cells: np.ndarray, v: int, rounds: int = 60) -> np.ndarray:
    """Weights (bucket, 3) by EM from rows of (bucket, P2, P1, tokens); thin buckets lean on all buckets, 20 tokens' worth.

    Bucket 0 is contexts that were never seen: P2 is no estimate there and gets no weight.
    """
    out = np.tile(np.array(DEFAULT), (BUCKETS, 1))
    if len(cells):
        p = np.column_stack([cells[:, 1], cells[:, 2], np.full(len(cells), 1.0 / (v + 1))])
        weight = cells[:, 3]

        def em(which: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
            q, w, lam = p[which], weight[which], start.copy()
            for _ in range(rounds):
                share = q * lam
                share /= share.sum(1, keepdims=True)
                lam = (share * w[:, None]).sum(0) + prior * start
                lam /= lam.sum()
            return lam

        pooled = np.maximum(em(np.ones(len(cells), bool), np.array(DEFAULT), 0.0), 1e-6)
        pooled /= pooled.sum()
        for k in range(BUCKETS):
            out[k] = np.maximum(em(cells[:, 0] == k, pooled, 20.0), 1e-9)
    out[0, 0] = 0.0
    return out / out.sum(1, keepdims=True)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, limit: int = BATCH) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    text_id = F.col(id_col).cast("string")
    fold = F.crc32(text_id) % folds
    role = F.when(fold.isNull() | (fold == held), 0).when(F.crc32(F.concat(F.lit("em"), text_id)) % 10 == 0, 2).otherwise(1)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), role.cast("int").alias("role"))
    parts = ranges_of(d, RANGE)
    answers = written(answered(asked(d, parts, limit)), "answers")
    sums = answers.filter("key is null").agg(*[F.sum(little(c)) for c in ("a", "b", "c")]).first()
    v, n, n_held = (int(x or 0) for x in sums)
    replies = answers.filter("key is not null")

    def cells(table: pa.Table) -> pa.Table:
        a = Answered(table)
        found: list[list] = [[], [], []]
        for _, _, b in a.batches:
            _, context, p2, p1 = a.estimates(b, n - n_held, True)
            for x, y in zip(found, ((bucket(context) * BINS + bins(p2)) * BINS + bins(p1), p2, p1), strict=True):
                x.append(y)
        code, p2, p1 = (np.concatenate(x or [np.zeros(0)]) for x in found)
        code, at, count = np.unique(code.astype(np.int64), return_inverse=True, return_counts=True)
        return pa.table({"cell": code, "n": count.astype(np.int64), "p2": np.bincount(at, p2, len(code)), "p1": np.bincount(at, p1, len(code))})

    own = tokens(d, limit, True)
    held_out = replies.filter(F.hex("e") == "01").unionByName(own).groupBy("key").applyInArrow(cells, "cell bigint, n bigint, p2 double, p1 double")
    hist = held_out.groupBy("cell").agg(F.sum("n"), *[F.sum(F.col(c).cast("decimal(38,24)")).cast("double") for c in ("p2", "p1")]).collect()  # decimals: the same sum in any order
    weights = mixture(np.array([[c // (BINS * BINS), p2 / k, p1 / k, k] for c, k, p2, p1 in sorted(map(tuple, hist))]).reshape(-1, 4), v)

    def scores(table: pa.Table) -> pa.Table:
        a = Answered(table)
        out = [[], [], [], [], []]
        for ids, known, b in a.batches:
            c, context, p2, p1 = a.estimates(b, n, False)
            lam = weights[bucket(context)]
            p = lam[:, 0] * p2 + lam[:, 1] * p1 + lam[:, 2] / (v + 1)
            at = np.concatenate([[0], np.cumsum(b.n)[:-1]])
            out[0].append(pa.array(ids, pa.int64(), mask=~known))
            out[1].append(b.n)
            out[2].append(np.add.reduceat((c > 0).astype(np.int64), at))
            out[3].append(np.add.reduceat(np.log10((c + 0.5) / (n + 0.5 * (v + 1))), at))
            out[4].append(np.add.reduceat(np.log10(p), at))
        return pa.table([pa.chunked_array(out[0], pa.int64()), *[pa.array(np.concatenate(x or [np.zeros(0)]), k) for x, k in zip(out[1:], (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)]], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    done = replies.unionByName(tokens(d, limit, None)).groupBy("key").applyInArrow(scores, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    out_fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return done.select("doc_id", F.coalesce(out_fold == held, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def little(c: str):
    """A long from eight little-endian bytes."""
    big = F.concat(*[F.substring(F.hex(F.col(c)), 15 - 2 * k, 2) for k in range(8)])
    return F.conv(big, 16, 10).cast("long")
