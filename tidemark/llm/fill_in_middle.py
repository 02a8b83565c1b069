"""Fill-in-the-middle: texts are cut in three and put in another order, so that a model learns to fill the gap.

A batch of texts is decoded once into UTF-32 code points. Neighbours of unlike classes are boundaries of units; a text with
n units has n + 1 places where it can be cut, and numbers drawn from a hash of its id choose two of them. The pieces are
slices of the code points and are encoded again. Units: ``point`` (each code point is a class of its own), ``word`` (runs
of white space, of letters and digits, of anything else), ``line`` (a line with its line feed).

Cases: a null text is empty; an empty text, and one with a mark in it, stay plain; a null id is the number of the empty
string; equal ids draw equal numbers; bytes that aren't UTF-8 are kept, each as one code point; other columns pass through
untouched whatever their names; an empty table gives an empty table. Nothing is shuffled: a lost executor's rows are made again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import batches, let, utf8

#: What stands before each piece.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many are cut, and of a hundred cut ones so many put the suffix first.
CUT, SUFFIX_FIRST = 90, 20
#: Texts of so many bytes are decoded together.
BATCH_BYTES = 4 << 20


def classes(points: np.ndarray, unit: str) -> np.ndarray:
    """The class of each code point; a unit is a run of one class."""
    if unit == "point":
        return np.arange(len(points))
    if unit == "line":
        ends = np.cumsum(points == 10)
        return np.concatenate([[0], ends[:-1]]) if len(points) else ends
    space = (points == 32) | ((points >= 9) & (points <= 13))
    low = points | 32
    word = ((low >= 97) & (low <= 122)) | ((points >= 48) & (points <= 57)) | (points >= 128)
    return np.where(space, 0, np.where(word, 1, 2))


def places(points: np.ndarray, unit: str) -> np.ndarray:
    """Where a text can be cut: its start, every boundary of units, its end."""
    kind = classes(points, unit)
    inner = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    return np.concatenate([[0], inner, [len(points)]]) if len(points) else np.zeros(1, np.int64)


def _has_mark(points: np.ndarray) -> bool:
    a = points[:-2]
    at = np.flatnonzero((a == 60) & (points[2:] == 62)) if len(a) else a
    return bool(len(at)) and bool(np.isin(points[at + 1], [ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]).any())


def _decoded(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)


def _encoded(points: np.ndarray) -> bytes:
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def cut(raw: bytes, draws: list[int], unit: str) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    points = _decoded(raw)
    at = places(points, unit)
    n = len(at) - 1
    if not n or draws[2] % 100 >= CUT or _has_mark(points):
        return n, "plain", None, None, raw
    i, j = sorted(int(at[d % (n + 1)]) for d in draws[:2])
    prefix, middle, suffix = (_encoded(p) for p in (points[:i], points[i:j], points[j:]))
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if draws[3] % 100 < SUFFIX_FIRST:
        return n, "spm", i, j - i, s + suffix + p + prefix + m + middle
    return n, "psm", i, j - i, p + prefix + s + suffix + m + middle


def draws(doc_id: str, seed: str = "1") -> Column:
    """Four 32-bit numbers from the id alone, the same wherever and whenever they are drawn."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return let(digest, lambda d: F.array(*[F.conv(F.substring(d, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]))


def transformed(docs: DataFrame, unit: str = "point", doc_id: str = "doc_id", text: str = "text", seed: str = "1", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input row as a struct, or its columns ``keep``), ``n_units``, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars``, ``output``."""
    if unit not in ("point", "word", "line"):
        raise ValueError(unit)
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    framed = docs.select(row.alias("row"), draws(doc_id, seed).alias("draws"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(it):
        for b in batches(it, BATCH_BYTES):
            raw, at = utf8(b.column(2))
            drawn = b.column(1).flatten().to_numpy().reshape(-1, 4).tolist()
            found = [cut(raw[at[i] : at[i + 1]].tobytes(), d, unit) for i, d in enumerate(drawn)]
            n, form, p, m, output = zip(*found, strict=True)
            kept = pa.array(output, pa.binary()).view(pa.string())  # not decoded: the bytes are those of the input
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(p, pa.int64()), pa.array(m, pa.int64()), kept], names=[f.name for f in schema.fields])

    schema = StructType([framed.schema["row"], *StructType.fromDDL("n_units bigint, form string, prefix_chars bigint, middle_chars bigint, output string").fields])
    return framed.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone: a cut text holds each mark once."""
    head = F.substring(output, len(PREFIX) + 1, 1 << 30)

    def before(x: Column, mark: str) -> Column:
        return F.substring_index(x, mark, 1)

    def after(x: Column, mark: str) -> Column:
        return F.substring(x, F.length(F.substring_index(x, mark, 1)) + F.lit(len(mark) + 1), F.lit(1 << 30))

    middle = after(head, MIDDLE)
    psm = F.concat(before(head, SUFFIX), middle, before(after(head, SUFFIX), MIDDLE))
    spm = F.concat(before(after(head, PREFIX), MIDDLE), middle, before(head, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    t = transformed(docs, keep=["doc_id"])
    back = restored(F.col("output"), F.col("form"))
    return t.select(F.col("row.doc_id").alias("doc_id"), F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
