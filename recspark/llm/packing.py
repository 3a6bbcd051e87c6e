"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

A bin is filled greedily, always with the longest piece that fits.  Then its smallest piece is exchanged for the two
unpacked pieces that fill the widened gap best, as long as that leaves less room.  Pieces of one length are
interchangeable, so the method runs on the table of counts by length (at most ``capacity`` rows): the bin found is
repeated while the counts allow it, which is what packing bin by bin would do.  The plan lists, for ranks within a
length, the sequence and offset; ranks are counted per length and hash bucket, so no length meets in one task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.durable import cut

CAPACITY = 2048
CACHED_WORDS = 1_000_000  # words of a worker's cache; it starts anew when full
BUCKET_ROWS = 50_000
_encoders: dict[str, WordEncoder] = {}


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: visible bytes as they are, others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Ids of whole texts from a tokenizer file whose pre-tokenizer never crosses white space.

    Such a text encodes as its words one after the other, so words are encoded once per worker and kept as bytes.
    Words that are letters with marks behind them are encoded as their lower-case letters and their marks, as the
    tokenizer splits and lowers them itself.
    """

    _PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.cache: dict[str, bytes] = {"": b""}
        specials = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark, self.mark_id = min(specials, default=("", -1))

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _encode(self, words: list[str], together: int = 100) -> Iterator[tuple[str, bytes]]:
        """Words encoded in groups, a special token between them; words that hold its string go alone."""
        plain = [w for w in words if self.mark and self.mark not in w]
        alone = words if not self.mark else [w for w in words if self.mark in w]
        for w, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            yield w, np.array(e.ids, dtype=self.kind).tobytes()
        groups = [plain[i:i + together] for i in range(0, len(plain), together)]
        size = np.dtype(self.kind).itemsize
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([self.mark.join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype=self.kind)
            data, start = ids.tobytes(), 0
            for w, stop in zip(group, [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]):
                yield w, data[start * size:stop * size]
                start = stop + 1

    def _learn(self, words):
        cache, parted, needed = self.cache, [], set()
        for w in words:
            match = self._PLAIN.fullmatch(w)
            if match:
                letters, marks = match[1].lower(), match[2]
                parted.append((w, letters, marks))
                if letters not in cache:  # one pre-token: straight to the merges
                    tokens = self.model.tokenize(letters if letters.isascii() else "".join(map(_BYTE_LETTERS.__getitem__, letters.encode())))
                    cache[letters] = array(self.code, [t.id for t in tokens]).tobytes()
                if marks not in cache:
                    needed.add(marks)
            else:
                needed.add(w)
        cache.update(self._encode(list(needed)))
        for w, letters, marks in parted:
            cache[w] = cache[letters] + cache[marks]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            for space in "\t\n\v\f\r":
                text = text.replace(space, " ")
            words = text.split(" ")
            new = {w for w in words if w not in self.cache}
            if new:
                if len(self.cache) + 2 * len(new) > CACHED_WORDS:
                    self.cache = {"": b""}
                    new = set(words) - {""}
                self._learn(new)
            yield np.frombuffer(b"".join(map(self.cache.__getitem__, words)), dtype=self.kind)


def token_pieces(docs: DataFrame, tokenizer: str, key="doc_id", text="text", capacity: int = CAPACITY,
                 end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): documents ended by ``end_id``, cut at ``capacity`` if longer.

    A null or empty text is the end id alone.  Every input row gives pieces of its own, repeated ones too.
    """
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder.load(tokenizer)
        for batch in batches:
            rows = []
            for k, ids in zip(batch["key"], encoder.encode(batch["text"].tolist())):
                array = np.append(ids.astype("<u4"), np.array([end_id], dtype="<u4"))
                for piece, start in enumerate(range(0, len(array), capacity)):
                    part = array[start:start + capacity]
                    row = (k, piece, start, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            yield pd.DataFrame(rows, columns=names)

    # keys travel as strings: pandas would turn longs beside nulls into doubles
    source = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    cut_up = source.mapInPandas(pieces, "doc_id string, piece int, start long, length long, ids_crc32 long"
                                + ", ids array<int>" * with_ids)
    return cut_up.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first rank, pieces per bin, bins, first sequence, offset)``.

    The t-th of a run's pieces per bin, in its i-th bin, has rank ``first + t * bins + i``.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, dtype=np.int64)
    runs, sequence = [], 0
    sizes = np.arange(capacity + 1)
    while left.any():
        rest, gap, chosen = left.copy(), capacity, {}

        def fill():
            nonlocal gap
            while gap and (fits := np.flatnonzero(rest[: gap + 1])).size:
                size = int(fits[-1])
                take = int(min(rest[size], gap // size))
                chosen[size] = chosen.get(size, 0) + take
                rest[size] -= take
                gap -= take * size

        fill()
        while gap and len(chosen) + sum(chosen.values()) > 2:  # a bin of one piece has nothing smaller to exchange
            small = min(chosen)
            room = gap + small
            largest = np.maximum.accumulate(np.where(rest[: room + 1] > 0, sizes[: room + 1], 0))
            a = np.flatnonzero(rest[: room + 1])
            a = a[a < room]
            b = largest[room - a]
            twin = (b == a) & (rest[a] < 2)
            b = np.where(twin, largest[np.maximum(np.minimum(room - a, a - 1), 0)], b)
            both = np.where(b > 0, a + b, 0)
            if not both.size or both.max() <= small:
                break
            best = int(both.argmax())
            pair = int(a[best]), int(b[best])
            chosen[small] -= 1
            if not chosen[small]:
                del chosen[small]
            rest[small] += 1
            for size in pair:
                chosen[size] = chosen.get(size, 0) + 1
                rest[size] -= 1
            gap = room - sum(pair)
            fill()
        bins, offset = min(int(left[s]) // k for s, k in chosen.items()), 0
        for size, k in sorted(chosen.items(), reverse=True):
            runs.append((size, int(used[size]), k, bins, sequence, offset))
            used[size] += k * bins
            left[size] -= k * bins
            offset += size * k
        sequence += bins
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, order=("doc_id", "piece")) -> DataFrame:
    """Adds ``sequence_id, offset`` to rows with a ``length`` from 1 to ``capacity``; other columns stay.

    Equal rows are placed one after the other; an empty table stays empty.  ``pieces`` is written to the shared
    folder before it is counted, so ranks hold when a task is run again.
    """
    pieces = cut(pieces)
    rows = pieces.count()
    bucket = F.pmod(F.xxhash64(*order), F.lit(max(1, -(-rows // BUCKET_ROWS))))
    keyed = pieces.withColumn("__bucket", bucket)
    counts = cut(keyed.groupBy("length", "__bucket").agg(F.count("*").alias("__n")))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}  # <= capacity rows
    runs = sorted(plan_bins(histogram, capacity))
    place = Window.partitionBy("length", "__bucket").orderBy(*order)
    ranked = (keyed.withColumn("__row", F.row_number().over(place) - 1).join(firsts, ["length", "__bucket"])
              .withColumn("__rank", F.col("__first") + F.col("__row")).select(*pieces.columns, "__rank"))
    table = np.array(runs, dtype=np.int64).reshape(-1, 6)
    starts = (table[:, 0] << 48) + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = table[np.searchsorted(starts, (length << 48) + rank, side="right") - 1]
        turn, number = np.divmod(rank - run[:, 1], run[:, 3])
        return pd.DataFrame({"sequence_id": run[:, 4] + number, "offset": run[:, 5] + turn * length})

    return (ranked.withColumn("__at", look_up(F.col("length").cast("long"), "__rank"))
            .select(*pieces.columns, "__at.sequence_id", "__at.offset"))
