"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, connected components.

Equal vectors count as one with a multiplicity.  The signs of ``bits`` hyperplanes give a vector's bucket in each
table; within a bucket all cosines are computed in double precision, in blocks of bounded size: a large bucket is
split into parts and every pair of parts is one group of rows.  A pair that also meets in an earlier table is left
to that one, so every found pair counts once.  The number of bits follows the logarithm of the number of vectors
and the number of tables follows from the wanted recall at the threshold, by formula at every size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.durable import cut

from .components import components

PART = 1500  # vectors of one part of a bucket


def parameters(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Hyperplanes per table, and tables so that a pair at the threshold is missed with probability ``1 - recall``."""
    same = 1 - math.acos(min(1.0, threshold)) / math.pi
    bits = min(30, max(6, math.ceil(math.log2(max(2, rows) / 32))))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - same ** bits))
    return bits, tables


def _local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable, for the nodes of one group."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def near_duplicates(vectors: DataFrame, key="vec_id", vector="embedding", threshold: float = 0.9, recall: float = 0.995,
                    seed: int = 11) -> DataFrame:
    """``key, n_links, component_id, kept``, one row per input row; ``key`` is a whole number, unique among its rows.

    Null vectors, zero vectors and vectors with a null, infinite or NaN component have no links and are their own
    component, as have empty arrays; vectors of different lengths are never compared; a null key links nothing and
    is kept.  Other columns are ignored.
    """
    # an id of the content: equal arrays are equal vectors (-0.0 and 0.0 differ there and still have cosine 1)
    usable = (F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists("v", lambda x: x != 0))
    source = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    source = source.withColumn("content", F.when(F.coalesce(usable, F.lit(False)) & F.col("id").isNotNull(),
                                                 F.sha2(F.concat_ws(" ", F.transform("v", lambda x: x.cast("string"))), 256)))
    distinct = cut(source.where(F.col("content").isNotNull()).groupBy("content")
                   .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v")))
    rows = distinct.count()
    bits, tables = parameters(rows, threshold, recall)
    powers = (1 << np.arange(bits)).astype(np.int64)

    @F.pandas_udf("array<long>")
    def signatures(batch: pd.Series) -> pd.Series:
        found = [None] * len(batch)
        sizes = batch.map(len).to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            planes = np.random.default_rng([seed, int(size)]).standard_normal((int(size), tables * bits))
            signs = (np.stack(batch.iloc[at].to_list()) @ planes > 0).reshape(len(at), tables, bits)
            for i, s in zip(at, (signs @ powers) * 4096 + int(size) % 4096):
                found[i] = s
        return pd.Series(found)

    signed = cut(distinct.select("rep", "copies", "v", signatures("v").alias("signs")))
    placed = signed.select("rep", "copies", "v", "signs", F.posexplode("signs").alias("t", "sign"))
    # only buckets with company are compared; their sizes say into how many parts they are split
    sizes = (signed.select(F.posexplode("signs").alias("t", "sign")).groupBy("t", "sign").agg(F.count("*").alias("n"))
             .where("n > 1").withColumn("parts", F.ceil(F.col("n") / PART).cast("int")).drop("n"))
    own = F.pmod(F.xxhash64("rep", "t"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    blocks = (placed.join(sizes, ["t", "sign"]).withColumn("own", own)
              .withColumn("other", F.explode(others))
              .select("rep", "copies", "v", "signs", "t", "sign", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        t, p, q = int(group["t"].iloc[0]), int(group["p"].iloc[0]), int(group["q"].iloc[0])
        group = group.sort_values("rep", ignore_index=True)  # the local root is the smallest id
        rep, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        signs, part = np.stack(group["signs"].to_list()), group["own"].to_numpy()
        links = np.zeros(len(group), dtype=np.int64)
        edges_a, edges_b = [], []
        lengths = group["v"].map(len).to_numpy()
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            x = np.stack(group["v"].iloc[at].to_list())
            x = x / np.abs(x).max(axis=1, keepdims=True)  # far from overflow
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            for low in range(0, len(at), 512):
                cosine = x[low:low + 512] @ x.T
                a, b = np.nonzero(cosine >= threshold)
                a, b = at[a + low], at[b]
                once = (a < b) if p == q else (part[a] == p) & (part[b] == q)
                a, b = a[once], b[once]
                for step in range(0, len(a), 1 << 16):  # pairs of an earlier table are counted there
                    i, j = a[step:step + (1 << 16)], b[step:step + (1 << 16)]
                    if t:
                        new = ~(signs[i, :t] == signs[j, :t]).any(axis=1)
                        i, j = i[new], j[new]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    edges_a.append(i)
                    edges_b.append(j)
        if not edges_a:
            return pd.DataFrame({"rep": rep[:0], "links": links[:0], "root": rep[:0]})
        root = _local_components(len(group), np.concatenate(edges_a), np.concatenate(edges_b))
        some = links > 0
        return pd.DataFrame({"rep": rep[some], "links": links[some], "root": rep[root[some]]})

    found = cut(blocks.groupBy("t", "sign", "p", "q").applyInPandas(compare, "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    told = (distinct.select("content", "rep", "copies").join(links, "rep", "left").join(member, "rep", "left")
            .select("content", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c")))
    return (source.select("id", "content").join(told, "content", "left")
            .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))))
