"""Language identification with a string kernel.

Kernel: blended spectrum of byte n-grams (2 to 4), presence only: the n-grams two texts share, over the geometric mean
of how many each has. N-grams are hashed to ``SPACE`` slots, so a text is one bit vector. Nyström landmarks come from
a bounded, hash-chosen sample of labelled rows; one-versus-rest kernel ridge regression is solved in their space.
A text's kernel values against all landmarks, times the dual weights, are one matrix product per batch: the landmark
vectors and the weights are multiplied once beforehand, and a text's own norm is a factor.

Bound: at most about ``SAMPLE`` labelled ids are learned from (about equally many of each language, chosen by a hash of
the id, one text each) and ``LANDMARKS`` of them are landmarks; their bit vectors (8 kB each) are what the driver
gathers. More than ``LANGUAGES`` languages are learned from ``EACH`` texts each, those with the smallest hashes, with a
landmark for each language up to ``MARKS``: the regression's left side is factorised once and solved for a block of
languages after another, and texts are scored in blocks of landmarks and languages, so that a worker holds one block. What
the driver gathers then grows with the number of languages, 16 kB each, and not with the documents.

Cases: of several rows with one id the smallest text is learned from; null text, no letter, or nothing to learn from: ``und`` with score 0; null lang is not learned from; repeated
rows and null ids give a row each; ties go to the language that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, keep_ids, utf8

SAMPLE, LANDMARKS, LANGUAGES, SPACE = 2000, 256, 1000, 1 << 16
EACH, MARKS, BLOCK = 2, 4096, 256
RIDGE = 1.0
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_FACTORS = {n: np.uint64(f) for n, f in ((2, 0x9E3779B97F4A7C15), (3, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9))}


def slots(data: np.ndarray) -> dict[int, np.ndarray]:
    """For n of 2 to 4, the slot of the n-gram that starts at each byte."""
    c = _LOWER[data]
    grams, code = {}, c
    for n in (2, 3, 4):
        code = (code[:-1] << np.uint64(8)) | c[n - 1 :] if len(c) >= n else np.zeros(0, np.uint64)
        grams[n] = ((code * _FACTORS[n]) >> np.uint64(48)).astype(np.int64)
    return grams


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1: which slots each text fills."""
    grams = slots(data)
    bits = np.zeros((len(offsets) - 1, SPACE), np.uint8)
    for i in range(len(offsets) - 1):
        for n, g in grams.items():
            if offsets[i + 1] - offsets[i] >= n:
                bits[i, g[offsets[i] : offsets[i + 1] - n + 1]] = 1
    return bits


def _blocks(it, rows: int = 128):
    for b in batches(it, 2 << 20):
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def sample_of(labelled: DataFrame, label: str, bound: int) -> DataFrame:
    """About ``bound`` rows, equally many of each label where there are so many, by a hash of doc_id; rows are narrow here."""
    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id")
        return labelled.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= EACH).drop("k")
    if not sizes:
        return labelled.limit(0)
    each = bound / len(sizes)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, each / n)))])
    return labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share[F.col(label)] * (1 << 30))


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray):
        self.langs, self.weights = langs, weights

    def scores(self, bits: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(bits.sum(1, dtype=np.int64), 1)).astype(np.float32)
        return (bits.astype(np.float32) @ self.weights) / norm[:, None]


class BlockModel:
    """For many languages: landmarks as packed bits, and their dual weights; only a block of either is unpacked at a time."""

    def __init__(self, langs: list[str], marks: np.ndarray, dual: np.ndarray):
        self.langs, self.marks, self.dual = langs, marks, dual

    def scores(self, bits: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(bits.sum(1, dtype=np.int64), 1)).astype(np.float32)
        x = bits.astype(np.float32)
        shared = np.hstack([x @ np.unpackbits(self.marks[i : i + BLOCK], axis=1).astype(np.float32).T for i in range(0, len(self.marks), BLOCK)])
        return (shared @ self.dual) / norm[:, None]


def fit_blocks(packed: np.ndarray, langs: list[str], ridge: float = RIDGE) -> BlockModel:
    """The regression of ``fit`` for any number of languages; ``packed``: bits by eights."""
    names = sorted(set(langs))
    at = {k: i for i, k in enumerate(names)}
    label = np.array([at[x] for x in langs])
    first = np.unique(label, return_index=True)[1]
    chosen = first[np.linspace(0, len(first) - 1, min(MARKS, len(first))).astype(np.int64)]
    unpacked = lambda rows: np.unpackbits(packed[rows], axis=1).astype(np.float32)
    norm = np.sqrt(np.maximum(np.bitwise_count(packed).sum(1, dtype=np.int64), 1)).astype(np.float32)
    k_nm = np.empty((len(packed), len(chosen)), np.float32)
    for j in range(0, len(chosen), BLOCK):
        marks = unpacked(chosen[j : j + BLOCK]).T
        for i in range(0, len(packed), BLOCK):
            k_nm[i : i + BLOCK, j : j + BLOCK] = unpacked(slice(i, i + BLOCK)) @ marks
    k_nm /= norm[:, None] * norm[chosen][None, :]
    weight = (len(langs) / (len(names) * np.bincount(label)))[label].astype(np.float32)
    left = (k_nm.T @ (k_nm * weight[:, None])).astype(np.float64) + ridge * k_nm[chosen] + 1e-6 * np.eye(len(chosen))
    half = np.linalg.inv(np.linalg.cholesky((left + left.T) / 2))  # the left side of every language
    dual = np.empty((len(chosen), len(names)), np.float32)
    for j in range(0, len(names), BLOCK):
        right = k_nm.T @ ((label[:, None] == np.arange(j, min(j + BLOCK, len(names)))) * weight[:, None])
        dual[:, j : j + BLOCK] = half.T @ (half @ right)
    return BlockModel(names, packed[chosen], dual / norm[chosen][:, None])


def fit(bits: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression in the landmarks' space; rows in the order given."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((SPACE, 0), np.float32))
    norm = np.sqrt(np.maximum(bits.sum(1, dtype=np.int64), 1))
    by = {k: [i for i, x in enumerate(langs) if x == k] for k in names}
    chosen = [i for k in names for i in by[k][: max(1, landmarks // len(names))]]
    marks = bits[chosen].astype(np.float32)  # shared n-grams are whole numbers, exact in single precision
    k_nm = np.vstack([bits[i : i + 256].astype(np.float32) @ marks.T for i in range(0, len(bits), 256)]) / (norm[:, None] * norm[chosen][None, :])
    k_mm = k_nm[chosen]
    y = np.array([[x == k for k in names] for x in langs], np.float64)
    balance = np.array([len(langs) / (len(names) * len(by[x])) for x in langs])
    left = k_nm.T @ (k_nm * balance[:, None]) + ridge * k_mm + 1e-6 * np.eye(len(chosen))
    dual = np.linalg.solve(left, k_nm.T @ (y * balance[:, None]))
    return Model(names, (marks.T.astype(np.float64) @ (dual / norm[chosen][:, None])).astype(np.float32))


def train(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """``docs``: doc_id, text, lang of the rows that may be learned from."""
    known = docs.filter("lang is not null and text is not null")
    chosen = sample_of(known.select("doc_id", "lang"), "lang", sample).select("doc_id").distinct()
    rows = keep_ids(known, chosen).groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("m")).select("doc_id", "m.text", "m.lang")  # at most about `sample` ids

    def bits(it):
        for b in _blocks(it):
            packed = np.packbits(presence(*utf8(b.column(1))), axis=1)
            yield pa.record_batch([b.column(0), b.column(2), pa.array([x.tobytes() for x in packed], pa.binary())], names=["doc_id", "lang", "bits"])

    got = sorted(((r[0], r[1], bytes(r[2])) for r in rows.mapInArrow(bits, "doc_id bigint, lang string, bits binary").collect()), key=lambda r: (hash_order(r[0]), r[1], r[2]))
    if not got:
        return fit(np.zeros((0, SPACE), np.uint8), [])
    packed, langs = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(len(got), -1), [r[1] for r in got]
    if len(set(langs)) > LANGUAGES:
        return fit_blocks(packed, langs)
    return fit(np.unpackbits(packed, axis=1), langs, landmarks)


def hash_order(i: int | None) -> int:
    return ((i or 0) * 0x9E3779B97F4A7C15) % (1 << 64)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score): the language with the highest regression value, and that value clipped to 0..1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(it):
        m = shared.value
        for b in _blocks(it):
            col = b.column(1)
            letters = [has_letter(x) for x in col.to_pylist()]
            if m.langs:
                s = m.scores(presence(*utf8(col)))
                best = s.argmax(1)
                lang = [m.langs[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
                value = [float(min(1.0, max(0.0, s[i, k]))) if letters[i] else 0.0 for i, k in enumerate(best)]
            else:
                lang, value = ["und"] * b.num_rows, [0.0] * b.num_rows
            yield pa.record_batch([b.column(0), pa.array(lang, pa.string()), pa.array(value, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id bigint, lang_pred string, score double")


def language(docs: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> DataFrame:
    """Learn from rows outside the held-out fold of crc32(doc_id), predict every row: (doc_id, held_out, lang_pred, score)."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = train(d.filter(fold != held), sample, landmarks)
    return identify(d, model).select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
