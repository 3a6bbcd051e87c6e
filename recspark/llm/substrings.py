"""Removal of repeated passages by fixed-block anchors.

Every document is a reference: its non-overlapping blocks of ``WINDOW // 2 + 1`` words are indexed by hash with the
smallest and largest document that holds them.  Every document is probed with the block at every word.  A repeated
window holds a whole block of the document it repeats, so each repeat is hit at least once; a hit is extended to
all windows around it, and these are compared over all documents: what joins up are the maximal exact repeats.

Probing uses bitmaps of fixed size instead of a shuffle of all windows.  False hits only add windows to compare;
a third bitmap, of the indexed blocks that were hit at all, rules out nearly all of them, however full the first is.
Windows themselves are matched exactly, by 64-bit hashes, in one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from recspark.operators.durable import stored

from .bitmaps import bitmaps_of
from .words import SPLIT, blocks, hash_windows, hash_words, inside

WINDOW = 13
MOST_BITS = 30  # of a bitmap: 128 MB
ROW_BITS = 24  # of the bitmap of changed rows: 2 MB


def _plain(batch: pd.DataFrame) -> pd.DataFrame:
    """The rows as Python objects: filtered string columns of pandas can be chunked, which Spark does not take back."""
    return pd.DataFrame({c: pd.Series(batch[c].tolist(), dtype=object) for c in batch.columns})


def _map(frame: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for a function on pandas batches, with every column built as one Arrow array of its type."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for found in function(batch.to_pandas() for batch in batches):
            columns = []
            for field in kind:
                values = pa.array(found[field.name].tolist(), type=field.type)
                columns.append(values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values)
            yield pa.RecordBatch.from_arrays(columns, schema=kind)

    return frame.mapInArrow(run, schema)


def _windows(texts: list[str], block: int, window: int):
    """Per slice of the texts: first words, block hashes, offsets in their text, and whether runs stay in a text."""
    for low, high in blocks(texts):
        words, first = hash_words(texts[low:high])
        anchors = hash_windows(words, block)
        offset = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        yield low, high, words, first, anchors, offset[: len(anchors)], inside(first, block)


def remove_repeats(docs: DataFrame, key="doc_id", text="text", keep=(), window: int = WINDOW) -> DataFrame:
    """``key, keep columns, n_words, n_removed, kept_text``, one row per input row.

    A word is removed if some window of ``window`` words of its document that covers it also starts in a document
    with a smaller key.  Words stay unchanged and are joined by one space.  Null and empty texts have no words; a
    document shorter than the window, or with a null key, loses nothing; equal rows lose the same.
    """
    block = window // 2 + 1
    names = [f"k{i}" for i in range(len(keep))]
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(key).cast("string").alias("id"), *[F.col(c).cast("string").alias(k) for c, k in zip(keep, names)], body.alias("text"))
    scanned = source.where(F.col("id").isNotNull()).select("id", "text")

    def reference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, own = batch["text"].tolist(), []
            for low, high, words, first, anchors, offset, whole in _windows(texts, block, window):
                at = np.flatnonzero(whole & (offset % block == 0))
                own += [np.unique(h).view(np.int64).tolist() for h in np.split(anchors[at], np.searchsorted(at, first[1:-1]))]
            yield pd.DataFrame({"h": own})

    # one row per document and block, so that counts are numbers of documents
    blocks_of = _map(scanned, reference, "h array<long>").select(F.explode("h").alias("h"))
    index = blocks_of.groupBy("h").agg(F.count("*").alias("documents"))
    chars = scanned.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(10 * max(1, chars // (6 * block))))))
    context = docs.sparkSession.sparkContext
    any_block, several = (context.broadcast(b) for b in bitmaps_of(index, "h", {"any": None, "several": F.col("documents") > 1}, bits, hashes=3))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for low, high, words, first, anchors, offset, whole in _windows(batch["text"].tolist(), block, window):
                aligned = offset % block == 0
                hit = whole & np.where(aligned, several.value.hits(anchors), any_block.value.hits(anchors))
                found.append(np.unique(anchors[hit]).view(np.int64).tolist())
            yield pd.DataFrame({"h": found})

    hits = _map(scanned.select("text"), probe, "h array<long>").select(F.explode("h").alias("h"))
    probed = context.broadcast(*bitmaps_of(hits, "h", {"all": None}, bits, hashes=3))
    several.unpersist()
    any_block.unpersist()

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for low, high, words, first, anchors, offset, whole in _windows(batch["text"].tolist(), block, window):
                own = anchors[whole & (offset[: len(whole)] % block == 0)]
                found.append(np.unique(own[probed.value.hits(own)]).view(np.int64).tolist())
            yield pd.DataFrame({"h": found})

    # a true hit is an indexed block that was hit; a false hit of the index is one of these only by chance again
    indexed = _map(scanned.select("text"), met, "h array<long>").select(F.explode("h").alias("h"))
    met_block = context.broadcast(*bitmaps_of(indexed, "h", {"all": None}, bits, hashes=3))

    def candidates(texts: list[str]):
        """For each text the starts of windows around a hit, and their hashes."""
        for low, high, words, first, anchors, offset, whole in _windows(texts, block, window):
            aligned = offset % block == 0
            hit = np.zeros(len(words), dtype=np.int64)
            hit[: len(anchors)] = whole & np.where(aligned, probed.value.hits(anchors), met_block.value.hits(anchors))
            runs = hash_windows(words, window)
            sums = np.concatenate([[0], np.cumsum(hit)])
            reach = window - block + 1  # block starts inside a window
            near = (sums[reach:len(runs) + reach] - sums[: len(runs)] > 0) & inside(first, window)
            at = np.flatnonzero(near)
            bounds = np.searchsorted(at, first)
            for i in range(high - low):
                own = at[bounds[i]:bounds[i + 1]]
                yield low + i, own - first[i], runs[own]

    def untouched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            alone = np.array([len(c[1]) == 0 for c in candidates(texts)], dtype=bool) | batch["id"].isna().to_numpy()
            rest = _plain(batch[alone])
            words = [SPLIT.findall(t) for t in rest["text"]]
            yield rest.drop(columns="text").assign(n_words=[len(w) for w in words], n_removed=0, kept_text=[" ".join(w) for w in words])

    def touched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            some = np.array([len(c[1]) > 0 for c in candidates(texts)], dtype=bool) & batch["id"].notna().to_numpy()
            yield _plain(batch[some])

    def starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(candidates(batch["text"].tolist()))
            yield pd.DataFrame({"id": batch["id"].tolist(), "r": batch["r"].tolist(), "at": [a.tolist() for _, a, _ in found],
                                "w": [w.view(np.int64).tolist() for _, _, w in found]})

    kinds = "id string" + "".join(f", {k} string" for k in names)
    # rows are numbered before they are written: the numbers are part of the table
    held = stored(_map(source, touched, f"{kinds}, text string").withColumn("id", F.col("id").cast("long"))
                  .withColumn("r", F.monotonically_increasing_id()).withColumn("mark", F.xxhash64("r")), "held")
    rows = (_map(held.select("id", "r", "text"), starts, "id long, r long, at array<int>, w array<long>")
            .select("id", "r", F.explode(F.arrays_zip("at", "w")).alias("x")).select("id", "r", "x.at", "x.w"))
    # windows are dealt once: minima joined back would be a second shuffle as large; a key with many rows spills
    rows = rows.withColumn("low", F.min("id").over(Window.partitionBy("w")))
    # written, so that the shuffles of windows are gone before texts are joined
    repeats = stored(rows.where("id > low").groupBy("r").agg(F.collect_list("at").alias("at")), "repeats")

    changed = context.broadcast(*bitmaps_of(repeats.select(F.xxhash64("r").alias("h")), "h", {"all": None}, ROW_BITS))

    def hit(batch: pd.DataFrame) -> np.ndarray:
        return changed.value.hits(batch["mark"].to_numpy(dtype=np.int64).view(np.uint64))

    def losing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _plain(batch[hit(batch)])

    def whole_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from cut_out(batch[~hit(batch)].assign(at=None) for batch in batches)

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for t, at in zip(batch["text"], batch["at"]):
                words = SPLIT.findall(t)
                change = np.zeros(len(words) + 1, dtype=np.int64)
                if at is not None:
                    at = np.asarray(at, dtype=np.int64)
                    change[at] += 1  # starts are distinct
                    np.subtract.at(change, at + window, 1)
                gone = np.cumsum(change)[:-1] > 0
                totals.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(" ".join(w for w, g in zip(words, gone) if not g))
            yield _plain(batch[["id", *names]]).assign(n_words=totals, n_removed=removed, kept_text=kept)

    result = f"{kinds}, n_words long, n_removed long, kept_text string"
    held = held.withColumn("id", F.col("id").cast("string"))
    # only texts that may lose something meet their windows
    some = _map(held, losing, f"{kinds}, text string, r long, mark long").join(repeats, "r", "left")
    parts = [_map(source, untouched, result), _map(held.select("id", *names, "text", "mark"), whole_texts, result),
             _map(some.select("id", *names, "text", "at"), cut_out, result)]
    both = reduce(DataFrame.unionByName, parts)
    return both.select(F.col("id").cast(docs.schema[key].dataType).alias(key),
                       *[F.col(k).cast(docs.schema[c].dataType).alias(c) for c, k in zip(keep, names)], "n_words", "n_removed", "kept_text")
