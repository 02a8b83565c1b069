"""Toxicity by a character n-gram linear classifier whose features are scaled by naive Bayes log-count ratios.

Features are the presence of character n-grams (4 to 6 code points, A-Z lowered), hashed to ``SPACE`` slots. On the
labelled sample the slots' document counts by class give r = log((p + a) / |p|) - log((q + a) / |q|); slots of at least
``LEAST`` documents with the strongest r are features, and a logistic regression with an L2 penalty is trained on
presence times r.

Bound: at most about ``PER_CLASS`` labelled ids of each class are learned from, chosen by a hash of the id, one text each.
Slots are counted on the executors; the driver gathers one count a slot and, with the features chosen, one bit a feature
and text (16 MB), however long the texts are. Slope and intercept are set on the quarter of the sample that is not
trained on, weighted to the classes' true shares among all labelled rows, class 1 ``MISS`` times.

Cases: null and empty text have no feature and get the intercept's score; no labelled row, or one class only: score is
that class's share (0.0 without any); a document with several labels is toxic if one of them says so; of several rows
with one id the smallest text is learned from; repeated rows and null ids give a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, written

PER_CLASS, SPACE, LEAST, FEATURES = 1000, 1 << 20, 4, 1 << 16
SIZES = (4, 5, 6)
SMOOTH, PENALTY, STEPS = 1.0, 1.0, 150
#: A missed toxic text counts as so many false alarms when the threshold is set.
MISS = 3.0
_MULT, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, A-Z lowered, and where each text starts (one more: the end)."""
    joined = "".join(t or "" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    points[(points >= 65) & (points <= 90)] += np.uint64(32)
    return points, np.concatenate([[0], np.cumsum([len(t or "") for t in texts])]).astype(np.int64)


def slots(points: np.ndarray) -> dict[int, np.ndarray]:
    """For each n, the slot of the n-gram that starts at each character."""
    code, out = points, {}
    for n in range(2, max(SIZES) + 1):
        code = code[:-1] * _BASE + points[n - 1 :] if len(points) >= n else np.zeros(0, np.uint64)
        if n in SIZES:
            out[n] = (((code + np.uint64(n)) * _MULT) >> np.uint64(44)).astype(np.int64)
    return out


def texts(points: np.ndarray, offsets: np.ndarray):
    """For each text, the slots of its n-grams, repeats included."""
    grams = slots(points)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield np.concatenate([g[a : b - n + 1] for n, g in grams.items() if b - a >= n] or [np.zeros(0, np.int64)])


class Model:
    """``number``: slot -> feature (0: none); ``weight``: of each feature; ``bias``."""

    def __init__(self, number: np.ndarray, weight: np.ndarray, bias: float):
        self.number, self.weight, self.bias = number, weight, bias

    def scores(self, given: list[str | None]) -> np.ndarray:
        flags = np.zeros((len(given), len(self.weight)), bool)
        for i, s in enumerate(texts(*characters(given))):
            flags[i, self.number[s]] = True
        z = flags @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def constant(share: float) -> Model:
    share = min(1 - 1e-12, max(1e-12, share))
    return Model(np.zeros(SPACE, np.int32), np.zeros(1), float(np.log(share / (1 - share))))


def chosen_features(n1: np.ndarray, n0: np.ndarray, ones: int, zeros: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots that are features, ascending, and the log-count ratio of each; from the documents of each class by slot."""
    r = np.log((n1 + SMOOTH) / (ones + 2 * SMOOTH)) - np.log((n0 + SMOOTH) / (zeros + 2 * SMOOTH))
    r[n1 + n0 < LEAST] = 0
    kept = np.sort(np.argsort(-np.abs(r), kind="stable")[: FEATURES - 1])
    kept = kept[r[kept] != 0]
    return kept, r[kept]


def fit(flags: np.ndarray, y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each feature and bias, by Adam over all rows in each step; ``flags``: rows by features, 0 or 1."""
    at, ids = np.nonzero(flags)
    at, ids = at.astype(np.int32), ids.astype(np.int32)
    n = len(y)
    size = np.sqrt(np.maximum(np.bincount(at, (r**2)[ids], n), 1)).mean()
    scale = r / size
    w, b = np.zeros(len(r)), 0.0
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = np.bincount(at, (w * scale)[ids], n) + b
        g = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / n
        gw, gb = np.bincount(ids, g[at], len(w)) * scale + PENALTY / n * w / 100, g.sum()
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        k = 0.05 * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= k * mw / (np.sqrt(vw) + 1e-8)
        b -= k * mb / (np.sqrt(vb) + 1e-8)
    return w * scale, float(b)


def calibrated(z: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Platt's slope and intercept for rows that were not trained on, weighted to the classes' true shares."""
    n1, n0 = int(y.sum()), int((1 - y).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, MISS * share / n1, (1 - share) / n0) * len(y)
    size = max(1e-9, float(np.std(z)))
    x = np.column_stack([z / size, np.ones(len(z))])
    t = np.array([1.0, 0.0])
    for _ in range(100):  # damped Newton steps
        q = 1 / (1 + np.exp(-np.clip(x @ t, -500, 500)))
        step = np.linalg.solve(x.T @ (x * (weight * q * (1 - q))[:, None]) + 1e-3 * np.eye(2), x.T @ (weight * (q - target)) + 1e-3 * t)
        t = t - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(t[0] / size), float(t[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """``labels``: doc_id, toxic of the rows that may be learned from."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if not sizes:
        return constant(0.0)
    share = sizes.get(1, 0) / sum(sizes.values())
    part = F.when(F.col("toxic") > 0, min(1.0, per_class / sizes.get(1, 1))).otherwise(min(1.0, per_class / sizes.get(0, 1)))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < part * (1 << 30))  # at most about two times per_class ids
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    rows = written(rows.withColumn("aside", F.crc32(F.concat(F.lit("aside"), F.col("doc_id").cast("string"))) % 4 == 3), "labelled")
    sums = {(r[0], r[1]): r[2] for r in rows.groupBy("toxic", "aside").count().collect()}
    few = min(sums.get((1, True), 0), sums.get((0, True), 0)) < 5  # too few to calibrate: all are trained on
    ones, zeros = (sum(n for (label, aside), n in sums.items() if label == c and (few or not aside)) for c in (1, 0))
    if not ones or not zeros:
        return constant(share)

    def counts(it):
        n = np.zeros((2, SPACE), np.int64)
        for b in batches(it, 2 << 20):
            for s, label, aside in zip(texts(*characters(b.column(1).to_pylist())), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if few or not aside:
                    n[label, np.unique(s)] += 1
        some = np.flatnonzero(n.sum(0))
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(n[1, some]), pa.array(n[0, some])], names=["slot", "n1", "n0"])

    found = rows.mapInArrow(counts, "slot bigint, n1 bigint, n0 bigint").groupBy("slot").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toArrow()
    n1, n0 = np.zeros(SPACE), np.zeros(SPACE)
    at = found.column("slot").to_numpy()
    n1[at], n0[at] = found.column("n1").to_numpy(), found.column("n0").to_numpy()
    kept, r = chosen_features(n1, n0, ones, zeros)
    number = np.zeros(SPACE, np.int32)
    number[kept] = np.arange(1, len(kept) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def bits(it):
        for b in batches(it, 2 << 20):
            out = []
            for s in texts(*characters(b.column(1).to_pylist())):
                flags = np.zeros(len(kept) + 1, bool)
                flags[shared.value[s]] = True
                out.append(np.packbits(flags[1:]).tobytes())
            yield pa.record_batch([b.column(0), b.column(2), b.column(3), pa.array(out, pa.binary())], names=["doc_id", "toxic", "aside", "bits"])

    got = sorted(tuple(x) for x in rows.mapInArrow(bits, "doc_id bigint, toxic int, aside boolean, bits binary").collect())
    flags = np.array([np.unpackbits(np.frombuffer(x[3], np.uint8), count=len(kept)) for x in got], np.uint8).reshape(len(got), -1)
    y, aside = np.array([x[1] for x in got], np.int64), np.array([x[2] and not few for x in got], bool)
    weight, bias = fit(flags[~aside], y[~aside], r)
    if aside.any():
        slope, at_ = calibrated(flags[aside] @ weight + bias, y[aside], min(1 - 1e-6, max(1e-6, share)))
        weight, bias = weight * slope, bias * slope + at_
    return Model(number, np.concatenate([[0.0], weight]), bias)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, per_class: int = PER_CLASS) -> DataFrame:
    """Learn from labels outside the held-out fold of crc32(doc_id), score every row: (doc_id, held_out, score, predicted)."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(d, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(fold != held), per_class)
    shared = d.sparkSession.sparkContext.broadcast(model)

    def score(it):
        for b in batches(it, 1 << 20):
            for i in range(0, b.num_rows, 64):
                c = b.slice(i, 64)
                s = shared.value.scores(c.column(1).to_pylist())
                yield pa.record_batch([c.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    return d.mapInArrow(score, "doc_id bigint, score double, predicted int").select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "score", "predicted")
