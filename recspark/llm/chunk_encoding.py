"""Byte-level BPE of whole texts with content-defined chunk reuse.

A rolling hash of 16 characters cuts texts into chunks, so that equal passages of different documents give equal
chunks.  Chunks that occur more than once are encoded once and joined back to the documents that hold them; all
other chunks are encoded where they are.  Encodings of neighbouring chunks are then joined by re-encoding a window
around the cut, widened until its outer words have exactly the tokens that the chunks gave them.  The outer ends of
a window are spaces between two visible ASCII characters: the pre-tokenizer always starts a token there, so the
window encodes as it does in the whole text.

Which documents hold a repeated chunk is told by a bitmap of fixed size; a false hit costs a shuffle of that
document, nothing else.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.durable import stored

from .bitmaps import bitmap_of
from .words import blocks, code_points, rolling

MEAN_CHUNK, MIN_CHUNK, MAX_CHUNK, ROLL = 256, 64, 8192, 16
FILTER_BITS = 25
_encoders: dict[tuple[str, str], ChunkEncoder] = {}


def chunk_cuts(texts: list[str]) -> list[list[int]]:
    """For each text the character offsets of its chunks, from 0 to its length."""
    found = []
    for low, high in blocks(texts):
        points, starts = code_points(texts[low:high])
        marks = np.flatnonzero(rolling(points, ROLL) % np.uint64(MEAN_CHUNK) == 0) + ROLL
        for i in range(high - low):
            begin, end = int(starts[i]), int(starts[i + 1]) - 1
            own = marks[np.searchsorted(marks, begin + ROLL):np.searchsorted(marks, end)]
            cuts = [0]
            for mark in (own - begin).tolist() + [end - begin]:
                while mark - cuts[-1] > MAX_CHUNK:
                    cuts.append(cuts[-1] + MAX_CHUNK)
                if mark - cuts[-1] >= MIN_CHUNK or mark == end - begin:
                    cuts.append(mark)
            found.append(cuts if end > begin else [0])
    return found


def digest(text: str) -> tuple[int, int]:
    """128 bits of a chunk as two signed longs."""
    both = np.frombuffer(xxhash.xxh3_128_digest(text.encode()), dtype="<i8")
    return int(both[0]), int(both[1])


class ChunkEncoder:
    """Ids of chunks and their repair; ``ranks`` are the same vocabulary's merge ranks, a faster form of it."""

    def __init__(self, tokenizer: str, ranks: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(ranks, "rb") as file:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = special
        self.coder = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens=special)
        size = max([*merges.values(), *special.values()]) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        for token, i in merges.items():
            self.lengths[i] = len(token)
        for token, i in special.items():
            self.lengths[i] = len(token.encode())
        self.stored = "<u2" if size <= 1 << 16 else "<u4"  # ids as they travel
        self.digits = [str(i) for i in range(size)]
        self.bytes = [b""] * size
        for token, i in [*merges.items(), *((t.encode(), i) for t, i in special.items())]:
            self.bytes[i] = token

    @classmethod
    def load(cls, tokenizer: str, ranks: str) -> ChunkEncoder:
        if (tokenizer, ranks) not in _encoders:
            _encoders[tokenizer, ranks] = cls(tokenizer, ranks)
        return _encoders[tokenizer, ranks]

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.coder.encode(text, allowed_special="all"), dtype=np.int64)
        return np.array(self.coder.encode_ordinary(text), dtype=np.int64)

    @staticmethod
    def _safe(data: bytes) -> np.ndarray:
        """Offsets of spaces between two visible ASCII characters."""
        b = np.frombuffer(data, dtype=np.uint8)
        seen = (b > 32) & (b < 127)
        return 1 + np.flatnonzero(seen[:-2] & (b[1:-1] == 32) & seen[2:]) if len(b) > 2 else np.zeros(0, dtype=np.int64)

    def join(self, chunks: list[bytes], encoded: list[np.ndarray]) -> np.ndarray:
        """Ids of the chunks' whole text from the ids of each chunk alone."""
        done: list[tuple[bytes, np.ndarray]] = []
        for data, ids in zip(chunks, encoded):
            while done:
                left, left_ids = done.pop()
                joint = self._repair(left, left_ids, data, ids)
                if joint is not None:
                    done.append(joint[0])
                    data, ids = joint[1]
                    break
                data = left + data  # nothing agreed within both: they become one chunk
                ids = self.ids(data.decode())
            done.append((data, ids))
        return np.concatenate([i for _, i in done]) if done else np.zeros(0, dtype=np.int64)

    def _repair(self, left, left_ids, right, right_ids):
        """Both parts with the window between them moved into the left one, or None if no window agrees."""
        before, after = self._safe(left), self._safe(right)
        left_ends, right_ends = np.cumsum(self.lengths[left_ids]), np.cumsum(self.lengths[right_ids])
        reach = 2
        while reach <= min(len(before), len(after)):
            start, inner = int(before[-reach]), int(before[-reach + 1])
            stop, outer = int(after[reach - 1]), int(after[reach - 2])
            window = self.ids((left[start:] + right[:stop]).decode())
            ends = np.cumsum(self.lengths[window])
            # the first and the last word of the window must have the tokens the chunks gave them
            a, b = np.searchsorted(left_ends, [start, inner], side="right")
            c, d = np.searchsorted(right_ends, [outer, stop], side="right")
            head = int(np.searchsorted(ends, inner - start, side="right"))
            tail = int(np.searchsorted(ends, len(left) - start + outer, side="right"))
            if np.array_equal(window[:head], left_ids[a:b]) and np.array_equal(window[tail:], right_ids[c:d]):
                return ((left + right[:stop], np.concatenate([left_ids[:a], window])), (right[stop:], right_ids[d:]))
            reach *= 2
        return None

    def row(self, ids: np.ndarray) -> tuple[int, str, str]:
        listed = ids.tolist()
        text = b"".join(map(self.bytes.__getitem__, listed)).decode(errors="replace")  # as the byte-level decoder does
        said = ",".join(map(self.digits.__getitem__, listed))
        return len(listed), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def encode_documents(docs: DataFrame, tokenizer: str, ranks: str, key="doc_id", text="text", with_ids: bool = False) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``), one row per input row.

    Null and empty texts have no tokens.  Repeated rows give repeated results; keys may be null.  Special strings
    in a text become their special token, as the tokenizer does by default.  Other columns are ignored.
    """
    # keys travel as strings: pandas would turn longs beside nulls into doubles
    source = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType
    result = "key string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def finish(coder, k, ids):
        return (k, *coder.row(ids), ids.astype(np.int32)) if with_ids else (k, *coder.row(ids))

    columns = [c.split()[0] for c in result.split(", ")]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            a, b = [], []
            for t, cuts in zip(texts, chunk_cuts(texts)):
                own = {digest(t[x:y]) for x, y in zip(cuts, cuts[1:])}
                a.append([x for x, _ in own])
                b.append([y for _, y in own])
            yield pd.DataFrame({"a": a, "b": b})

    each = source.select("text").mapInPandas(digests, "a array<long>, b array<long>")
    pairs = each.select(F.explode(F.arrays_zip("a", "b")).alias("c")).select("c.a", "c.b")
    repeated = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    known = docs.sparkSession.sparkContext.broadcast(bitmap_of(repeated.select("a"), "a", FILTER_BITS))

    def shared_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, seen = batch["text"].tolist(), {}
            for t, cuts in zip(texts, chunk_cuts(texts)):
                for x, y in zip(cuts, cuts[1:]):
                    part = t[x:y]
                    d = digest(part)
                    if d[0] in known.value:
                        seen.setdefault(d, [part, 0])[1] += 1  # once per batch
            yield pd.DataFrame([(*d, *v) for d, v in seen.items()], columns=["a", "b", "part", "n"])

    def encode_shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = ChunkEncoder.load(tokenizer, ranks)
        for batch in batches:
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"],
                                "ids": [coder.ids(p).astype(coder.stored).tobytes() for p in batch["part"]]})

    texts = (source.select("text").mapInPandas(shared_texts, "a long, b long, part string, n long")
             .groupBy("a", "b").agg(F.first("part").alias("part"), F.sum("n").alias("n")).where("n > 1").drop("n"))
    encoded = texts.mapInPandas(encode_shared, "a long, b long, ids binary")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Results of documents without repeated chunks; texts and possible hits of the others."""
        coder = ChunkEncoder.load(tokenizer, ranks)
        empty = (None,) * (len(columns) - 1)
        for batch in batches:
            keys, texts = batch["key"].tolist(), batch["text"].tolist()
            rows = []
            for k, t, cuts in zip(keys, texts, chunk_cuts(texts)):
                spans = [(x, *digest(t[x:y])) for x, y in zip(cuts, cuts[1:])]
                hits = [s for s in spans if s[1] in known.value]
                if hits:
                    rows.append((k, *empty, *digest(t), t, *(list(c) for c in zip(*hits))))
                else:
                    rows.append((*finish(coder, k, coder.ids(t)), None, None, None, None, None, None))
            frame = pd.DataFrame(rows, columns=[*columns, "u", "v", "text", "at", "a", "b"])
            yield frame.astype({"n_tokens": "Int64", "u": "Int64", "v": "Int64"})

    # written once: results, and one row per text that still needs the shared chunks
    held = stored(source.mapInPandas(route, result + ", u long, v long, text string, at array<int>, a array<long>, b array<long>"), "held")
    hits = (held.select("u", "v", F.explode(F.arrays_zip("at", "a", "b")).alias("h")).select("u", "v", "h.*").distinct())
    parts = (hits.join(encoded, ["a", "b"]).groupBy("u", "v")
             .agg(F.collect_list(F.struct("at", "ids")).alias("parts")))

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = ChunkEncoder.load(tokenizer, ranks)
        for batch in batches:
            keys, texts, lists = batch["key"].tolist(), batch["text"].tolist(), batch["parts"].tolist()
            rows = []
            for k, t, cuts, found in zip(keys, texts, chunk_cuts(texts), lists):
                ready = {} if found is None else {p["at"]: np.frombuffer(p["ids"], dtype=coder.stored).astype(np.int64) for p in found}
                chunks = [t[x:y] for x, y in zip(cuts, cuts[1:])]
                ids = [ready[x] if x in ready else coder.ids(c) for x, c in zip(cuts, chunks)]
                rows.append(finish(coder, k, coder.join([c.encode() for c in chunks], ids)))
            yield pd.DataFrame(rows, columns=columns)

    joined = (held.where(F.col("text").isNotNull()).select("key", "u", "v", "text").join(parts, ["u", "v"], "left")
              .select("key", "text", "parts"))
    both = held.where(F.col("text").isNull()).select(*columns).unionByName(joined.mapInPandas(assemble, result))
    return both.select(F.col("key").cast(kind).alias(key), *columns[1:])
