"""Divergence of the sources of a language, counted in minimal perfect hash tables.

A first pass finds the terms of each language that stand in enough documents, by an exact count in Spark.  They are dealt
to shards of some thousand terms, and a task makes a minimal perfect hash of each: levels of bits, in which a term takes
a place that no other term of its level wants and is numbered by the bits before it.  A perfect hash gives foreign terms
a number too, so the terms themselves are stored in slot order and compared.  The shards are broadcast, as many at a
time as ``ROUND_BYTES`` allow; a pass over the texts adds its counts to dense slots of each language and source and hands
on what is not zero.  More terms take more rounds, so neither the driver nor a task holds a whole large vocabulary.

Distances between sources are summed shard by shard over dense blocks of counts.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.durable import stored
from recspark.operators.ordering import top_k

MIN_DOCS, TOP_TERMS, SMOOTHING, SCALE = 30, 50, 5, (31_250, 32_000)  # both scales together are 10^9
SHARD_TERMS, ROUND_BYTES, TERM_BYTES, BLOCK_SOURCES = 8192, 64_000_000, 60, 64
TASK_TERMS, TASK_CELLS = 500_000, 8_000_000  # terms or slots that a task holds before it hands them on
ROOM, LEVELS = 2, 40  # bits per term of a level; more levels than terms of different hashes ever need
SEED = 42  # of Spark's xxhash64, so that both sides deal terms alike

# Terms are runs of A-Z, a-z and characters beyond ASCII, so in UTF-8 runs of these bytes; A-Z are lower-cased.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


def hashes_of(terms) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, seed=SEED) for t in terms], dtype=np.uint64)


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    h = (hashes ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA5A3564E27F8862B)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 of n distinct terms; ``terms`` holds them in slot order."""

    def __init__(self, levels: list, terms: list[bytes], placed: int):
        self.levels, self.terms, self.placed = levels, terms, placed
        self.rest = {t: placed + i for i, t in enumerate(terms[placed:])}  # only terms that share a 64-bit hash

    @classmethod
    def build(cls, terms: list[bytes]) -> PerfectHash:
        hashes, left, levels, order = hashes_of(terms), np.arange(len(terms)), [], []
        while len(left) and len(levels) < LEVELS:
            size = max(64, -(-ROOM * len(left) // 64) * 64)
            at = _places(hashes[left], len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=np.uint8)
            bits[at[alone]] = 1
            words = np.packbits(bits, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            levels.append((size, words, len(order) + np.cumsum(ones) - ones))
            order += left[alone][np.argsort(at[alone])].tolist()
            left = left[~alone]
        return cls(levels, [terms[i] for i in [*order, *left.tolist()]], len(order))

    def slots(self, hashes: np.ndarray, terms: list[bytes]) -> np.ndarray:
        """The slot of each term, -1 for terms that are not stored."""
        found, left = np.full(len(terms), -1, dtype=np.int64), np.arange(len(terms))
        for level, (size, words, before) in enumerate(self.levels):
            at = _places(hashes[left], level, size)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            lower = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[left[hit]] = before[at[hit] >> 6] + np.bitwise_count(lower)
            left = left[~hit]
        for i in np.flatnonzero(found >= 0).tolist():
            if self.terms[found[i]] != terms[i]:
                found[i] = -1
        for i in left.tolist() if self.rest else ():
            found[i] = self.rest.get(terms[i], -1)
        return found


def rates(counts, total, vocabulary) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 V)) by two divisions, exact within 64 bits up to 10^14 occurrences."""
    whole = np.asarray(total + SMOOTHING * vocabulary, dtype=np.int64)
    q, r = np.divmod((np.asarray(counts, dtype=np.int64) + SMOOTHING) * SCALE[0], whole)
    return 1 + q * SCALE[1] + r * SCALE[1] // whole


def rate(count: str, total: str, vocabulary: str) -> Column:
    """The same for columns."""
    part, whole = f"((({count}) + {SMOOTHING}L) * {SCALE[0]}L)", f"({total} + {SMOOTHING}L * {vocabulary})"
    return F.expr(f"1L + ({part} div {whole}) * {SCALE[1]}L + (({part} % {whole}) * {SCALE[1]}L) div {whole}")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term`` (UTF-8 bytes) of the terms that stand in at least ``min_docs`` documents of the language."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}

        def hand_on():
            rows = [(lang, t, n) for lang, c in seen.items() for t, n in c.items()]
            seen.clear()
            return pd.DataFrame(rows, columns=["lang", "term", "n"], dtype=object)

        for batch in batches:
            for i, (lang, text) in enumerate(zip(batch["lang"].tolist(), batch["text"].tolist())):
                seen.setdefault(lang, Counter()).update(set(terms_of(text)))
                if i % 256 == 255 and sum(map(len, seen.values())) > TASK_TERMS:
                    yield hand_on()
        yield hand_on()

    counts = docs.select("lang", "text").mapInPandas(count, "lang string, term binary, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


def make_shards(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``lang, shard, shards, levels, placed, terms``: a perfect hash per row, its terms in slot order."""
    def build(group: pd.DataFrame) -> pd.DataFrame:
        table = PerfectHash.build(sorted(group["term"].tolist()))
        return pd.DataFrame({**{c: [group[c].iloc[0]] for c in ("lang", "shard", "shards")},
                             "levels": [pickle.dumps(table.levels)], "placed": [table.placed], "terms": [table.terms]})

    sizes = kept.groupBy("lang").agg(F.ceil(F.count("*") / shard_terms).cast("int").alias("shards"))
    dealt = kept.join(sizes, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))
    # dealt anew: Spark would keep all shards of a language where the join on it left them
    return dealt.repartition("lang", "shard").groupBy("lang", "shard").applyInPandas(
        build, "lang string, shard int, shards int, levels binary, placed int, terms array<binary>")


def _recount_round(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Occurrences of the terms of ``shards``, whose size the caller bounds."""
    tables, numbers = {}, {}
    for r in shards.collect():
        tables[r["lang"], r["shard"]] = PerfectHash(pickle.loads(r["levels"]), [bytes(t) for t in r["terms"]], r["placed"])
        numbers[r["lang"]] = r["shards"]
    held = docs.sparkSession.sparkContext.broadcast((tables, numbers))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, numbers = held.value
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def hand_on():
            keys, at, n = [], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for key, slots in dense.items():
                at.append(np.flatnonzero(slots))
                n.append(slots[at[-1]])
                keys += [key] * len(at[-1])
            dense.clear()
            return pd.DataFrame(keys, columns=["lang", "source", "shard"], dtype=object).assign(slot=np.concatenate(at), n=np.concatenate(n))

        for batch in batches:
            # not pandas' groupby, which takes strings that differ after a NUL for equal
            groups: dict[tuple[str, str], Counter] = {}
            for lang, source, text in zip(batch["lang"].tolist(), batch["source"].tolist(), batch["text"].tolist()):
                if lang in numbers:
                    groups.setdefault((lang, source), Counter()).update(terms_of(text))
            for (lang, source), said in groups.items():
                terms, n = list(said), np.fromiter(said.values(), dtype=np.int64, count=len(said))
                hashes = hashes_of(terms)
                home = hashes.view(np.int64) % numbers[lang]
                for shard in np.unique(home).tolist():
                    table, own = tables.get((lang, shard)), np.flatnonzero(home == shard)
                    if table is None:
                        continue  # of another round
                    slot = table.slots(hashes[own], [terms[i] for i in own.tolist()])
                    cells = dense.setdefault((lang, source, shard), np.zeros(len(table.terms), dtype=np.int64))
                    cells[slot[slot >= 0]] += n[own][slot >= 0]  # distinct terms have distinct slots
                if sum(map(len, dense.values())) > TASK_CELLS:
                    yield hand_on()
        yield hand_on()

    return docs.select("lang", "source", "text").mapInPandas(count, "lang string, source string, shard int, slot int, n long")


def recount(docs: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``lang, source, shard, slot, n``: how often each kept term occurs in each source, where it does."""
    # one row of three numbers for each shard of some thousand terms
    sizes = shards.select("lang", "shard", F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.length(t) + TERM_BYTES).alias("bytes"))
    rounds, room = [], -1
    for r in sizes.orderBy("lang", "shard").collect():
        if r["bytes"] > room:
            rounds.append([])
            room = max(round_bytes, r["bytes"])
        rounds[-1].append((r["lang"], r["shard"]))
        room -= r["bytes"]
    spark, found = docs.sparkSession, []
    for wanted in rounds or [[]]:
        keys = spark.createDataFrame(wanted, "lang string, shard int")
        found.append(_recount_round(docs, shards.join(F.broadcast(keys), ["lang", "shard"], "left_semi")))
    return reduce(DataFrame.unionByName, found).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def _distances(groups: DataFrame, spaces: DataFrame, cells: DataFrame, block_sources: int) -> DataFrame:
    """``lang, source, item, value``: summed differences between every two sources of a language.

    ``groups``: lang, source, total, vocabulary; ``spaces``: lang, shard, size, one row at least per language.
    """
    lists = (cells.groupBy("lang", "shard", "source")
             .agg(F.collect_list(F.struct("slot", "n")).alias("c")).select("lang", "shard", "source", "c.slot", "c.n"))
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / block_sources).cast("int").alias("blocks"))
    rows = (groups.join(blocks, "lang").withColumn("mine", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
            .join(spaces, "lang").join(lists, ["lang", "shard", "source"], "left")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("mine", kind="stable").reset_index(drop=True)
        lang, size, same = group["lang"].iloc[0], int(group["size"].iloc[0]), bool((group["i"] == group["j"]).iloc[0])
        names, first = group["source"].tolist(), int((group["mine"] == group["i"]).sum())
        table = np.zeros((len(names), size), dtype=np.int64)
        for row, (slot, n) in enumerate(zip(group["slot"], group["n"])):
            if slot is not None:
                table[row, np.asarray(slot, dtype=np.int64)] = n
        if size:
            table = rates(table, group["total"].to_numpy(np.int64)[:, None], group["vocabulary"].to_numpy(np.int64)[:, None])
        a, b, value = [], [], []
        for row in range(first):
            start = row + 1 if same else first
            a += [names[row]] * (len(names) - start)
            b += names[start:]
            value += np.abs(table[start:] - table[row]).sum(axis=1).tolist()
        # plain objects: pandas' own strings may reach Arrow in several chunks
        return pd.DataFrame({"lang": pd.Series([lang] * len(a), dtype=object), "a": pd.Series(a, dtype=object),
                             "b": pd.Series(b, dtype=object), "value": np.array(value, dtype=np.int64)})

    sums = (rows.repartition("lang", "shard", "i", "j").groupBy("lang", "shard", "i", "j").applyInPandas(compare, "lang string, a string, b string, value long")
            # a shard's sources come in any order, so a pair may be (a, b) in one and (b, a) in the next
            .groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("value")))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return sums.select("lang", F.explode(ways).alias("w"), "value").select("lang", "w.source", "w.item", "value")


def audit(docs: DataFrame, text="text", lang="lang", source="source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
          shard_terms: int = SHARD_TERMS, round_bytes: int = ROUND_BYTES, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every language and source that occurs.

    Part ``pair``: the distance to each other source of the language, largest first.  Part ``term``: the ``top`` kept terms
    that are most above their rate in the whole language.  Equal values are ordered by ``item`` in UTF-8.  Null texts,
    languages and sources are empty strings; a source without terms takes part with counts of zero, a language without
    kept terms has distances of 0; other columns are ignored; repeated rows count each; an empty table gives no rows.
    """
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    docs = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).alias("text"))
    shards = stored(make_shards(kept_terms(docs, min_docs), shard_terms), "shards")
    cells = stored(recount(docs, shards, round_bytes), "cells")
    spaces = shards.select("lang", "shard", F.size("terms").alias("size"))
    named = docs.groupBy("lang", "source").agg(F.lit(True).alias("named")).drop("named")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabularies = spaces.groupBy("lang").agg(F.sum("size").alias("vocabulary"))
    groups = stored(named.join(totals, ["lang", "source"], "left").join(vocabularies, "lang", "left")
                    .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary")), "groups")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    spaces = langs.select("lang").join(spaces, "lang", "left").select(
        "lang", F.coalesce("shard", F.lit(0)).alias("shard"), F.coalesce("size", F.lit(0)).alias("size"))
    pairs = _distances(groups, spaces, cells, block_sources)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # one row per other source
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))

    said = cells.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("said"))
    words = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    terms = (cells.join(said, ["lang", "shard", "slot"]).join(groups, ["lang", "source"]).join(langs, "lang")
             .withColumn("p", rate("n", "total", "vocabulary")).withColumn("q", rate("said", "`all`", "vocabulary")).where("p > q")
             .join(words, ["lang", "shard", "slot"])
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value")))
    terms = top_k(terms, ["lang", "source"], [F.desc("value"), F.col("item")], top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
