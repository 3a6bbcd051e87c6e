"""Token counts of whole texts; huge texts by overlapping chunks that are spliced where both encodings must agree.

A chunk is encoded with offsets and so is the next one, which starts ``overlap`` characters before the first one's
end.  Inside the overlap the two encodings are joined at a boundary of both that is proven stable: the characters
on its two sides are adjacent in no vocabulary piece, so no merge can cross it and each side encodes as it would
in the whole text.  Without such a place the overlap doubles, at last up to the chunk's own start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 32_768, 256
_SPACE = 0x2581  # the piece alphabet's mark for a space
_models: dict[str, PieceCounter] = {}


class PieceCounter:
    """Exact token counts for one sentencepiece model."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap, self.widened = chunk, overlap, 0
        pairs = set()
        for i in range(self.model.get_piece_size()):
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)):
                points = [ord(c) for c in self.model.id_to_piece(i)]
                pairs.update((a << 21) | b for a, b in zip(points, points[1:]))
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    @classmethod
    def load(cls, path: str) -> PieceCounter:
        if path not in _models:
            _models[path] = cls(path)
        return _models[path]

    def counts(self, texts: list[str]) -> list[int]:
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        found = dict(zip(short, self.model.encode([texts[i] for i in short], num_threads=1))) if short else {}
        return [len(found[i]) if i in found else self.long_count(t) for i, t in enumerate(texts)]

    def _ends(self, text: str) -> np.ndarray:
        """Byte offsets in ``text`` at which its tokens end."""
        return np.fromiter((p.end for p in self.model.encode(text, return_type="proto").pieces), dtype=np.int64)

    def _stable(self, text: str, low: int, high: int) -> np.ndarray:
        """Places p with low < p < high whose neighbours stand together in no piece."""
        points = np.frombuffer(text[low:high].encode("utf-32-le"), dtype="<u4").astype(np.int64)
        points[points == 32] = _SPACE
        pairs = (points[:-1] << 21) | points[1:]
        at = np.searchsorted(self.pairs, pairs)
        known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pairs
        return low + 1 + np.flatnonzero(~known)

    def long_count(self, text: str) -> int:
        """Count of a text of any length, a chunk at a time."""
        if self.model.normalize(text) != "▁" + text.replace(" ", "▁"):
            return len(self.model.encode(text))  # a normaliser that rewrites text could reach across any place
        total, start, counted, stop = 0, 0, 0, min(self.chunk, len(text))

        def after(ends):  # tokens behind the last splice; the first chunk counts from its start, empty pieces too
            return ends > len(text[start:counted].encode()) if counted else ends >= 0

        ends = self._ends(text[start:stop])
        while stop < len(text):
            overlap, later = self.overlap, min(stop + self.chunk, len(text))
            while True:
                begin = max(stop - overlap, start)
                following = self._ends(text[begin:later])
                places = self._stable(text, begin, stop)
                to_start = len(text[start:begin].encode())
                inner = np.array([len(text[begin:p].encode()) for p in places], dtype=np.int64)
                common = np.isin(inner + to_start, ends) & np.isin(inner, following) & (places > counted)
                if common.any() or begin == start:
                    break
                overlap, self.widened = overlap * 2, self.widened + 1
            if begin > start:
                pick = np.flatnonzero(common)[-1]
                total += int((after(ends) & (ends <= inner[pick] + to_start)).sum())
                counted, start = int(places[pick]), begin
            ends, stop = following, later  # without any place, one longer chunk from the same start
        return total + int(after(ends).sum())


def count_tokens(docs: DataFrame, model: str, key="doc_id", text="text", limit: int = 4096,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit``, one row per input row, in one pass without a shuffle.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null keys are kept; other columns are ignored.
    ``model`` is a sentencepiece file that every worker can open.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PieceCounter.load(model)
        counter.chunk, counter.overlap = chunk, overlap
        for batch in batches:
            texts = batch["text"].tolist()
            n = counter.counts(texts)
            yield pd.DataFrame({"key": batch["key"].tolist(), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n})

    # keys travel as strings: pandas would turn longs beside nulls into doubles
    source = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = source.mapInPandas(count, "key string, n_bytes long, n_tokens long")
    return counted.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
