"""Shortest-pack-first packing of tokenised documents over the histogram of their piece lengths.

Documents are cut into full pieces and one shorter last piece.  Pieces of one length are interchangeable, so the plan
works on counts by length (at most ``capacity`` numbers, whatever the corpus): as many empty packs are laid out as the
tokens fill, and lengths are placed longest first, always into the packs with the least in them.  A step moves a whole
count: so many packs of one pattern become packs of the pattern with one more length.  A length that fits into no pack
any more is cut at the shortest pack's room and what is left returns to the histogram.  The tokens beyond the last full
pack go to packs of the powers of two that sum to them, which need no padding either; so no sequence is padded.

Documents meet their patterns by rank within a length.  Tasks number the pieces they write; one row for each task and
length gives the ranks before them, so neither a length nor a document meets in one task.  Only pieces that the plan
cuts are read with their ids again.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.durable import stored

from .chunk_encoding import ChunkEncoder

CAPACITY = 1024
RESULT = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def plan_packs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int, int]]:
    """Steps ``(length, first rank, pieces, skip, tokens, first sequence, offset)``.

    Tokens ``skip`` to ``skip + tokens`` of the piece with rank ``first + i`` among the pieces of ``length`` go to
    ``offset`` in sequence ``first sequence + i``.  Every sequence ends full; the last ones may have the size of a
    power of two.
    """
    waiting = defaultdict(list)  # length: runs (length of the whole piece, first rank, pieces, tokens placed before)
    for length, n in counts.items():
        if n:
            waiting[length].append((length, 0, n, 0))
    full, rest = divmod(sum(length * n for length, n in counts.items()), capacity)
    packs = defaultdict(list)  # room: runs (first sequence, packs, tokens in each)
    if full:
        packs[capacity].append((0, full, 0))
    for size in (1 << bit for bit in range(capacity.bit_length()) if rest >> bit & 1):
        packs[size].append((full, 1, 0))
        full += 1
    steps, room = [], capacity

    def put(runs: list, run: tuple):
        """Adds a run, as part of the one before if it continues that."""
        if runs and runs[-1][0] + runs[-1][1] == run[0] and runs[-1][2] == run[2]:
            run = (runs[-1][0], runs.pop()[1] + run[1], run[2])
        runs.append(run)

    for length in range(max(waiting, default=0), 0, -1):
        while waiting[length]:
            whole, rank, pieces, skip = waiting[length].pop()
            while not packs[room]:
                room -= 1  # rooms only shrink, so the largest one does too
            sequence, n, offset = packs[room].pop()
            moved, tokens = min(pieces, n), min(length, room)
            steps.append((whole, rank, moved, skip, tokens, sequence, offset))
            if n > moved:
                packs[room].append((sequence + moved, n - moved, offset))
            if pieces > moved:
                waiting[length].append((whole, rank + moved, pieces - moved, skip))
            if tokens < room:
                put(packs[room - tokens], (sequence, moved, offset + tokens))
            if tokens < length:
                waiting[length - tokens].append((whole, rank, moved, skip + tokens))
    return steps


class Placement:
    """The plan by ranks: ``find`` gives the parts of pieces, in order."""

    def __init__(self, steps):
        table = np.array(steps, dtype=np.int64).reshape(-1, 7)
        self.cut_lengths = sorted({int(x) for x in table[table[:, 4] < table[:, 0], 0]})
        keys, parts = [], []
        for length in np.unique(table[:, 0]).tolist():
            own = table[table[:, 0] == length]
            edges = np.unique(np.concatenate([own[:, 1], own[:, 1] + own[:, 2]]))
            held = [[] for _ in edges[1:]]
            for row in own[np.argsort(own[:, 3], kind="stable")]:
                for i in range(*np.searchsorted(edges, [row[1], row[1] + row[2]])):
                    held[i].append((row[3], row[4], row[5] - row[1], row[6]))
            keys += [(length << 48) + int(rank) for rank in edges[:-1]]
            parts += held
        self.keys = np.array(keys, dtype=np.int64)
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.parts = np.array([x for p in parts for x in p], dtype=np.int64).reshape(-1, 4)

    def find(self, length: np.ndarray, rank: np.ndarray):
        """For each part: the piece's index, tokens skipped, tokens, sequence and offset."""
        at = np.searchsorted(self.keys, (length << 48) + rank, side="right") - 1
        n = self.sizes[at]
        owner = np.repeat(np.arange(len(at)), n)
        part = self.parts[np.repeat(self.firsts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return owner, part[:, 0], part[:, 1], part[:, 2] + rank[owner], part[:, 3]


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str, key="doc_id", text="text", capacity: int = CAPACITY,
                   end_id: int = 0) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one row per piece.

    A document is its text's ids and ``end_id``; a null or empty text is the end id alone.  Every input row is a
    document of its own, so ids may repeat or be null; other columns are ignored.  An empty table gives no pieces.
    ``ranks`` are the merge ranks of ``tokenizer``.  A document is one row of one task, however long.
    """
    spark = docs.sparkSession

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, seen, block = ChunkEncoder.load(tokenizer, ranks), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for k, t in zip(batch["key"].tolist(), batch["text"].tolist()):
                ids = np.append(coder.ids(t), end_id).astype("<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start:start + capacity]
                    size, data = len(part), part.tobytes()
                    rows.append((k, start, size, zlib.crc32(data), len(ids), block, seen[size], data if size < capacity else None))
                    seen[size] += 1
            yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "block", "nth", "ids"]
    # keys travel as strings: pandas would turn longs beside nulls into doubles
    source = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = stored(source.mapInPandas(pieces, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
                                             "block int, nth long, ids binary"), "pieces")
    # one row for each task and length; the numbers of a task hold because its rows are written
    counts = stored(held.groupBy("length", "block").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    placement = Placement(plan_packs(histogram, capacity))
    plan = spark.sparkContext.broadcast(placement)  # its size depends on the capacity, not on the corpus

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            owner, skip, tokens, sequence, offset = plan.value.find(batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64))
            out = pd.DataFrame({c: batch[c].to_numpy()[owner] for c in ("start", "ids_crc32", "doc_tokens")})
            out["doc_id"] = pd.Series(batch["doc_id"].to_numpy(object)[owner], dtype=object)
            out["start"] += skip
            if "ids" in batch:
                ids, whole = batch["ids"].tolist(), batch["length"].tolist()
                out["ids_crc32"] = [crc if n == whole[i] else zlib.crc32(ids[i][4 * s:4 * (s + n)])
                                    for i, s, n, crc in zip(owner.tolist(), skip.tolist(), tokens.tolist(), out["ids_crc32"].tolist())]
            yield out.assign(length=tokens, sequence_id=sequence, offset=offset)[[c.split()[0] for c in RESULT.split(", ")]]

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("nth")).alias("rank")]
    cut_up = F.col("length").isin(placement.cut_lengths)
    whole = held.where(~cut_up).join(firsts, ["length", "block"]).select(*columns).mapInPandas(place, RESULT)
    parted = held.where(cut_up).join(firsts, ["length", "block"]).select(*columns, "ids").mapInPandas(place, RESULT)
    return whole.unionByName(parted).withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))
