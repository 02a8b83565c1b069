"""Token counts by overlap resynchronisation.

Short texts are encoded whole. A huge text is encoded in overlapping chunks; the offsets of the tokens show which
boundaries two neighbouring chunks have in common, and the counts are spliced at a common boundary that is proven
stable: no piece of the vocabulary holds the two characters beside it, so no merge can ever cross it. When the overlap
has no such boundary, it is widened, up to the whole text, so the count is always the tokenizer's own.

Cases: null is empty (0 tokens); repeated rows and null ids give a row each; a model whose pieces do not add up to the
text (a rewriting normalizer) is always run on whole texts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches

#: Characters of a chunk, and of the first overlap.
CHUNK, OVERLAP = 32_768, 512


class PieceCounter:
    """Counts of one sentencepiece model."""

    def __init__(self, model: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.chunk, self.overlap = chunk, overlap
        n = sp.get_piece_size()
        self.chars = np.zeros(n, np.int64)
        self.inside: set[str] = set()
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.chars[i] = not 0x80 <= int(piece[3:5], 16) < 0xC0  # only the first byte of a character counts
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.chars[i] = len(piece)
                self.inside.update(piece[k : k + 2] for k in range(len(piece) - 1))

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", "▁") not in self.inside

    def ends(self, text: str) -> np.ndarray | None:
        """Where each token ends in ``text``; None where pieces and text do not add up."""
        at = np.cumsum(self.chars[np.array(self.sp.encode(text, num_threads=1), np.int64)]) - 1  # a blank is put in front
        return at if len(at) and at[-1] == len(text) else None

    def long_count(self, text: str) -> int:
        """Tokens of a text in overlapping chunks."""
        n, overlap = len(text), self.overlap
        start, splice, total = 0, -1, 0  # the chunk's start; the end of the last token counted before it
        ends = self.ends(text[: self.chunk + overlap])
        if ends is None:
            return len(self.sp.encode(text))
        stop = min(n, self.chunk + overlap)
        while stop < n:
            # the next chunk starts before this one stops
            while True:
                begin = max(splice, 0, stop - 2 * overlap)
                after = min(n, begin + self.chunk + 2 * overlap)
                following = self.ends(text[begin:after])
                if following is None:
                    return len(self.sp.encode(text))
                common = np.intersect1d(ends + start, following + begin, assume_unique=False)
                common = [p for p in common[(common > max(begin, splice)) & (common < stop)].tolist() if self.stable(text, p)]
                if common or begin == max(splice, 0):
                    break
                overlap *= 2
            if not common:  # nothing proven since the last splice: encode on from there, further
                wider = min(n, stop + max(self.chunk, stop - start))
                ends = self.ends(text[start:wider])
                if ends is None:
                    return len(self.sp.encode(text))
                stop = wider
                continue
            at = common[len(common) // 2]
            total += int(np.sum((ends + start > splice) & (ends + start <= at)))
            start, ends, stop, splice, overlap = begin, following, after, at, self.overlap
        return total + int(np.sum((ends + start > splice) & (ends + start <= n)))

    def counts(self, texts: list[str]) -> list[int]:
        out, short = [0] * len(texts), []
        for i, t in enumerate(texts):
            if len(t) > self.chunk + self.overlap:
                out[i] = self.long_count(t)
            elif t:
                short.append(i)
        if short:
            for i, ids in zip(short, self.sp.encode([texts[i] for i in short], num_threads=1), strict=True):
                out[i] = len(ids)
        return out


@lru_cache(maxsize=2)
def counter(model: str, chunk: int, overlap: int) -> PieceCounter:
    """One for each Python worker."""
    return PieceCounter(model, chunk, overlap)


def token_counts(docs: DataFrame, model: str, text_col: str = "text", id_col: str = "doc_id", limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit). ``model`` is the path of a sentencepiece model on every executor."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def count(it):
        for b in batches(it, 1 << 20):
            col = b.column(1)
            n_bytes = [len(x) if x else 0 for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]
            n = counter(model, chunk, overlap).counts([x or "" for x in col.to_pylist()])
            yield pa.record_batch([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return d.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
