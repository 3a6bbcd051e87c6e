"""Jaccard join of word n-gram sets by signature trees.

Top level: sets of nearly equal size differ in at most ``d`` shingles if they reach the threshold, so of ``d + 1``
disjoint parts of the hash space at least one holds the same shingles in both.  With spare parts such a pair shares several,
so each document drops that many of its most frequent keys and the pair still meets in its rarest one: passages that stand in
many documents bring nobody together.  Documents whose keys have the same smallest document form a cell around it; cells
may overlap, and any pair outside all of them cannot overlap enough.  Below, the documents of a cell stand in a tree
whose nodes hold the OR of their shingles' bitmaps, the range of their sizes and how many shingles share bits.  A
dual traversal drops node pairs whose largest possible overlap is too small for their sizes, and node pairs that are
known to be connected; what is left is compared exactly.

Equal sets count once.  A cell with many shingles is split into chunks that are joined one by one together with a
few common documents; only documents that are then outside their cell's largest component meet all other chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.durable import cut, stored

from .bitmaps import bitmap_of
from .components import components
from .words import blocks, hash_windows, hash_words, mix

BUDGET = 400_000  # shingles of one task's trees
HUBS = 24  # documents of a split cell that go with every chunk
LEAF = 8
SPARE = 1 / 16  # spare parts for each shingle in which two sets may differ
FILTER_BITS = 25
ROWS = 1024  # documents whose sets are in a task's memory at once


def _slices(batches: Iterator[pd.DataFrame], rows: int = ROWS) -> Iterator[pd.DataFrame]:
    """The same rows in smaller frames."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at:at + rows]


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased; shorter texts are one shingle, empty ones none."""
    found = []
    for low, high in blocks(texts):
        words, first = hash_words(texts[low:high], lower=True)
        windows = hash_windows(words, n)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                found.append(np.unique(windows[a:b - n + 1]))
            elif b > a:
                found.append(mix(hash_windows(words[a:b], b - a) + np.uint64(b - a)))
            else:
                found.append(windows[:0])
    return found


def _class_tops(threshold: float, largest: int) -> list[int]:
    """Upper ends of size classes; sets that reach the threshold are at most one class apart."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, math.floor(tops[-1] / threshold)))
    return tops


def part_keys(shingles: np.ndarray, percent: int, tops: list[int], spare_share: float = SPARE) -> list[tuple[np.ndarray, int]]:
    """Keys of a set's parts and how many of the most frequent ones it may drop, for its own size class and the next.

    Beyond the ``d + 1`` parts there are spare ones: a pair shares ``spare + 1`` equal parts or more.  Empty parts need no
    key while they are at most the spare ones; what is left of the spare ones may be dropped.  At least one more key
    than either document drops is shared, so in any order common to all documents the last shared key is kept by both.
    """
    level = int(np.searchsorted(tops, len(shingles)))
    found = []
    for c in (level, level + 1):
        # |x| + |y| <= 2 * top and an overlap of at least percent / (100 + percent) of it
        differ = 2 * tops[c] * (100 - percent) // (100 + percent)
        spare = 2 + int(differ * spare_share)
        parts = differ + 1 + spare
        part = ((mix(shingles) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, dtype=np.uint64)
        np.add.at(sums, part, mix(shingles + np.uint64(0x1234567)))
        own = mix(sums + mix(np.arange(parts, dtype=np.uint64) + np.uint64(c << 32)))
        filled = np.bincount(part, minlength=parts) > 0
        empty = parts - int(filled.sum())
        found.append((own[filled], spare - empty) if empty <= spare else (own, 0))
    return found


class _Node:
    __slots__ = ("bits", "low", "high", "slack", "kids", "rows", "joined")

    def __init__(self, bits, low, high, slack, kids, rows):
        self.bits, self.low, self.high, self.slack, self.kids, self.rows, self.joined = bits, low, high, slack, kids, rows, False


class SignatureTree:
    """Dual join of the sets of one group; ``root`` holds what is known to be connected."""

    def __init__(self, sets: list[np.ndarray], percent: int, known: list[int] | None = None):
        self.sets, self.percent = sets, percent
        self.root = list(range(len(sets))) if known is None else list(known)
        self.links: list[tuple[int, int]] = []
        self.compared = 0
        width = 1 << max(10, int(4 * max(len(s) for s in sets)).bit_length())
        self.width = min(width, 1 << 16)
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0]) if len(sets[i]) else 0))
        level = [self._leaf(order[i:i + LEAF]) for i in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self._inner(level[i:i + LEAF]) for i in range(0, len(level), LEAF)]
        self.top = level[0]

    def _signature(self, i: int) -> np.ndarray:
        flags = np.zeros(self.width, dtype=bool)
        flags[(self.sets[i] & np.uint64(self.width - 1)).astype(np.int64)] = True
        return np.packbits(flags).view(np.uint64)

    def _leaf(self, rows):
        nodes = []
        for i in rows:
            bits = self._signature(i)
            size = len(self.sets[i])
            nodes.append(_Node(bits, size, size, size - int(np.bitwise_count(bits).sum()), None, (i,)))
        return self._inner(nodes)

    def _inner(self, kids):
        bits = kids[0].bits.copy()
        for k in kids[1:]:
            bits |= k.bits
        return _Node(bits, min(k.low for k in kids), max(k.high for k in kids), max(k.slack for k in kids), kids,
                     sum((k.rows for k in kids), ()))

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _united(self, *nodes) -> bool:
        """Whether all documents of the nodes are connected; a node found so is not asked again."""
        for node in nodes:
            if not node.joined:
                first = self._find(node.rows[0])
                node.joined = all(self._find(i) == first for i in node.rows[1:])
                if not node.joined:
                    return False
        return len({self._find(node.rows[0]) for node in nodes}) == 1

    def _possible(self, a, b) -> bool:
        """Whether some pair could reach the threshold by sizes and largest possible overlap."""
        p = self.percent
        if 100 * a.high < p * b.low or 100 * b.high < p * a.low:
            return False
        common = int(np.bitwise_count(a.bits & b.bits).sum())
        overlap = min(a.slack + common, b.slack + common, a.high, b.high)
        return (100 + p) * overlap >= p * (a.low + b.low)

    def join(self):
        self._self(self.top)
        return self.links

    def _self(self, node):
        if node.kids is None or self._united(node):
            return
        for i, kid in enumerate(node.kids):
            self._self(kid)
            for other in node.kids[:i]:
                self.cross(other, kid)

    def cross(self, a, b):
        if not self._possible(a, b) or self._united(a, b):
            return
        if a.kids is None and b.kids is None:
            self._compare(a.rows[0], b.rows[0])
        elif b.kids is None or (a.kids is not None and len(a.rows) >= len(b.rows)):
            for kid in a.kids:
                self.cross(kid, b)
        else:
            for kid in b.kids:
                self.cross(a, kid)

    def _compare(self, i: int, j: int):
        x, y = self.sets[i], self.sets[j]
        self.compared += 1
        both = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * both >= self.percent * (len(x) + len(y) - both):
            self.links.append((i, j))
            self.root[self._find(j)] = self._find(i)


def _labels(values) -> list[int]:
    """Equal values as the index of the first of them."""
    first: dict = {}
    return [first.setdefault(v, i) for i, v in enumerate(values)]


def jaccard_components(docs: DataFrame, key="doc_id", text="text", n: int = 3, percent: int = 90, budget: int = BUDGET,
                       spare_share: float = SPARE) -> DataFrame:
    """``key, n_shingles, component_id``, one row per input row.

    Documents link when 100 * intersection >= percent * union of their sets of distinct ``n``-word shingles (A-Z
    lower-cased; fewer words are one shingle).  Null, empty and white-space texts have no shingles and link with
    nothing; a null key links nothing and stays null; rows that share a key are one node; other columns are ignored.
    Shingles are compared by 64-bit hashes, whole sets by 128 bits.  A larger ``spare_share`` makes more keys and smaller cells;
    results are the same.
    """
    largest = 1 << 40
    tops = _class_tops(percent / 100, largest)
    body = F.coalesce(F.col(text), F.lit(""))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            sets = shingle_sets(batch["text"].tolist(), n)
            sums = [(int(s.sum().view(np.int64)), int(mix(s).sum().view(np.int64))) if len(s) else (0, 0) for s in sets]
            yield pd.DataFrame({"id": batch["id"].tolist(), "n": [len(s) for s in sets], "u": [a for a, _ in sums], "v": [b for _, b in sums]})

    def cell_keys(batches: Iterator[pd.DataFrame], wanted=None) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            batch = batch[leads.value.hits(batch["lead"].to_numpy(np.int64).view(np.uint64))]
            ids, sides, drops, keys = [], [], [], []
            for i, shingles in zip(batch["id"].tolist(), shingle_sets(batch["text"].tolist(), n)):
                if len(shingles) > 1:
                    for side, (own, drop) in enumerate(part_keys(shingles, percent, tops, spare_share)):
                        ids.append(i)
                        sides.append(side)
                        drops.append(drop)
                        keys.append((own if wanted is None else own[wanted.value.hits(own)]).view(np.int64))
            if ids:
                yield pd.DataFrame({"id": ids, "side": sides, "drop": drops, "keys": keys})

    source = docs.select(F.col(key).cast("string").alias("id"), body.alias("text"))
    base = stored(source.mapInPandas(describe, "id string, n long, u long, v long").withColumn("id", F.col("id").cast("long")), "base")
    reps = stored(base.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("n", "u", "v").agg(F.min("id").alias("rep")), "reps")
    context = docs.sparkSession.sparkContext

    # one document of each set gives keys; false hits of the bitmap only give keys that nobody needs
    leads = context.broadcast(bitmap_of(reps.select(F.xxhash64("rep").alias("h")), "h", FILTER_BITS, hashes=2))

    def entries(of):
        # the bitmap is asked in the same Python worker: a function before it would keep a second one for each task
        return (source.where(F.col("id").isNotNull()).select("id", "text", F.xxhash64(F.col("id").cast("long")).alias("lead"))
                .mapInPandas(of, "id string, side int, drop int, keys array<long>")
                .select(F.col("id").cast("long").alias("id"), "side", "drop", F.explode("keys").alias("k")))

    shared = stored(entries(cell_keys).groupBy("k").agg(F.count("*").alias("f")).where("f > 1"), "shared")
    # bitmaps of fixed size keep most rows out of the next two shuffles; their false hits fall out in the joins
    wanted = context.broadcast(bitmap_of(shared, "k", FILTER_BITS, hashes=2))
    # one document's keys of one class are in a window: as many as its text has parts
    order = Window.partitionBy("id", "side").orderBy(F.desc("f"), "k")
    rare = stored(entries(lambda batches: cell_keys(batches, wanted)).join(shared, "k").withColumn("place", F.row_number().over(order))
                  .where("place > drop").select("id", "k"), "rare")
    firsts = rare.groupBy("k").agg(F.min("id").alias("m"), F.max("id").alias("most")).where("m < most").select("k", "m")
    cells = stored(rare.join(firsts, "k").select("id", F.col("m").alias("cell")).distinct(), "cells")
    members = reps.select("rep", "n").join(cells, F.col("rep") == F.col("id")).select("rep", "n", "cell")
    sizes = (members.groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("docs"))
             .withColumn("chunks", F.ceil(F.col("total") / budget).cast("int")))
    members = cut(members.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")))
    inside = context.broadcast(bitmap_of(members.select(F.xxhash64("rep").alias("h")), "h", FILTER_BITS, hashes=2))

    @F.pandas_udf("boolean")
    def in_cell(hashes: pd.Series) -> pd.Series:
        return pd.Series(inside.value.hits(hashes.to_numpy(np.int64).view(np.uint64)))

    # texts of the documents in cells, once; small cells share a task
    texts = docs.select(F.col(key).cast("long").alias("rep"), body.alias("text")).where(F.col("rep").isNotNull()).where(in_cell(F.xxhash64("rep")))
    held = stored(texts.join(members.select("rep").distinct(), "rep"), "held")
    small = members.where("chunks = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bins = max(1, math.ceil(small / budget))
    hub = (F.pmod(F.xxhash64("rep", F.lit(5)), F.col("docs")) < HUBS) | (F.col("rep") == F.col("cell"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    first = held.join(members, "rep").select("rep", "text", "cell", F.when(F.col("chunks") == 1, F.lit(-1)).otherwise(F.col("cell")).alias("g"),
                        F.explode(F.when(F.col("chunks") == 1, F.array(F.pmod(F.xxhash64("cell"), F.lit(bins)).cast("int")))
                                  .when(hub, every).otherwise(F.array("chunk"))).alias("h"))

    def within(group: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        once = group.drop_duplicates("rep")  # a document may stand in several cells
        sets = dict(zip(once["rep"].tolist(), shingle_sets(once["text"].tolist(), n)))
        for _, cell in group.groupby("cell"):
            ids = cell["rep"].tolist()
            tree = SignatureTree([sets[i] for i in ids], percent, _labels(ids))
            for i, j in tree.join():
                a.append(ids[i])
                b.append(ids[j])
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    edges = cut(first.groupBy("g", "h").applyInPandas(within, "a long, b long"))
    # split cells: whoever is not in the largest component of its cell meets every chunk
    split = members.where("chunks > 1")
    if split.limit(1).count():
        known = components(edges)
        placed = split.join(known, F.col("rep") == F.col("node"), "left").select("rep", "n", "cell", "chunks", "chunk",
                                                                             F.coalesce("component", "rep").alias("c"))
        counted = placed.groupBy("cell", "c").agg(F.count("*").alias("m"))
        best = counted.groupBy("cell").agg(F.max_by("c", F.struct("m", -F.col("c"))).alias("best"))
        placed = cut(placed.join(best, "cell"))
        rest = placed.where("c != best")
        open_cells = cut(rest.groupBy("cell").agg(F.ceil(F.sum("n") / budget).cast("int").alias("parts")))
        # parts of the rest, each with every chunk
        mine = rest.join(open_cells, "cell").select("rep", "cell", "c", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("parts")).cast("int").alias("p"),
                                                    F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("q"), F.lit(True).alias("mine"))
        theirs = placed.join(open_cells, "cell").select("rep", "cell", "c", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"),
                                                        F.col("chunk").alias("q"), F.lit(False).alias("mine"))

        def across(group: pd.DataFrame) -> pd.DataFrame:
            a, b = [], []
            x, y = group[group["mine"]], group[~group["mine"]]
            if len(x) and len(y):
                ids = x["rep"].tolist() + y["rep"].tolist()
                tree = SignatureTree(shingle_sets(x["text"].tolist() + y["text"].tolist(), n), percent,
                                     _labels(x["c"].tolist() + y["c"].tolist()))
                for i, j in tree.join():
                    a.append(ids[i])
                    b.append(ids[j])
            return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

        edges = edges.unionByName(mine.unionByName(theirs).join(held, "rep").groupBy("cell", "p", "q").applyInPandas(across, "a long, b long"))
    linked = components(edges)
    classes = (reps.select("n", "u", "v", "rep").join(linked, F.col("rep") == F.col("node"), "left")
               .select("n", "u", "v", F.coalesce("component", "rep").alias("c")))
    result = base.select("id", "n", "u", "v").join(classes, ["n", "u", "v"], "left")
    return result.select(F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"),
                         F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("component_id"))
