"""Synthetic user, item and history tables drawn from what given tables hold, row by row on the executors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import normal
from ..operators.joins import lookup_join, salted_join
from ..operators.ordering import running_totals, with_position


DIGITS = 6  # of the moments, so that the order of sums cannot change what is drawn from them


def strata_moments(df: DataFrame, stratum: str, columns) -> DataFrame:
    """``stratum, n, first_id, last_id`` and ``mean_c, std_c`` of every column: what a generated table is drawn from.

    Ids are dealt to the strata in ranges, in the order of their names.
    """
    found = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"), *[a for c in columns for a in (
        F.round(F.avg(c), DIGITS).alias(f"mean_{c}"), F.round(F.stddev_pop(c), DIGITS).alias(f"std_{c}"))])
    placed = running_totals(found, [stratum], {"__end": "n"})
    return placed.withColumns({"first_id": F.col("__end") - F.col("n"), "last_id": F.col("__end") - 1}).drop("__end")


def like_strata(df: DataFrame, key: str, stratum: str, columns, seed=42) -> DataFrame:
    """``key, stratum`` of the rows with Gaussian columns drawn from the moments of their stratum.

    Draws are hashes of the key.  A null stratum is a stratum; a column without values stays null.
    """
    columns = list(columns)
    known = df.select(key, F.col(stratum).alias(stratum), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("__s"),
                      F.col(stratum).isNull().alias("__null"))
    moments = strata_moments(df, stratum, columns).select(
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("__s"), F.col(stratum).isNull().alias("__null"),
        *[f"{m}_{c}" for c in columns for m in ("mean", "std")])
    both = lookup_join(known, moments, ["__s", "__null"], [key])
    return both.select(key, stratum, *[(F.col(f"mean_{c}") + F.col(f"std_{c}") * normal(f"like.{seed}.{c}", key)).alias(c) for c in columns])


def aligned_feedback(pairs: DataFrame, users: DataFrame, items: DataFrame, user_column: str, item_column: str) -> DataFrame:
    """Distinct pairs with feedback 1 where the user's and the item's column lie on the same side of their averages.

    ``users`` and ``items`` are generated tables; pairs of ids that they lack are left out.
    """
    def side(df, key, column, name):
        middle = df.agg(F.round(F.avg(column), DIGITS).alias("__m"))
        return df.crossJoin(F.broadcast(middle)).select(key, (F.col(column) > F.col("__m")).alias(name))  # a single row

    both = salted_join(pairs.select("user_idx", "item_idx").distinct(), side(users, "user_idx", user_column, "__u"), ["user_idx"], ["item_idx"])
    both = salted_join(both, side(items, "item_idx", item_column, "__i"), ["item_idx"], ["user_idx"])
    return both.select("user_idx", "item_idx", (F.col("__u") == F.col("__i")).cast("bigint").alias("relevance"))


def copula_table(df: DataFrame, key: str, columns, seed=42) -> DataFrame:
    """A synthetic table with the columns' own distributions and rank correlation.

    Gaussian copula by ranks: real values are paired with equally ranked normal draws to
    learn the correlation, correlated normal draws are ranked, and each rank takes the real
    value of that rank.  Ranks come from distributed sorts, one per column; only the
    correlation matrix (columns x columns) reaches the driver.
    """
    columns = list(columns)
    ids = with_position(df.select(key), [key], "row").select(key, "row")
    noise = ids.select("row", *[normal(f"copula.{seed}.{c}", "row").alias(c) for c in columns])
    scores = ids
    for c in columns:
        values = with_position(df.select(key, F.col(c).alias("v")), ["v", key], "at").select(key, "at")
        ranks = with_position(noise.select("row", F.col(c).alias("z")), ["z", "row"], "at").select("at", F.col("z").alias(f"z_{c}"))
        scores = scores.join(values.join(ranks, "at").drop("at"), key)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    found = scores.agg(*[F.corr(f"z_{a}", f"z_{b}").alias(f"r{i}") for i, (a, b) in enumerate(pairs)]).first() if pairs else []
    matrix = np.eye(len(columns))
    for (a, b), r in zip(pairs, found):
        i, j = columns.index(a), columns.index(b)
        matrix[i, j] = matrix[j, i] = 0.0 if r is None else r
    lower = np.linalg.cholesky(matrix + 1e-9 * np.eye(len(columns)))
    fresh = ids.select("row", *[normal(f"copula.{seed}.new.{c}", "row").alias(c) for c in columns])
    out = ids.select("row")
    for i, c in enumerate(columns):
        mix = F.lit(0.0)
        for j in range(i + 1):
            mix = mix + F.lit(float(lower[i, j])) * F.col(columns[j])
        ranked = with_position(fresh.select("row", mix.alias("z")), ["z", "row"], "at").select("row", "at")
        values = with_position(df.select(key, F.col(c).alias("v")), ["v", key], "at").select("at", F.col("v").alias(c))
        out = out.join(ranked.join(values, "at").drop("at"), "row")
    return out.withColumnRenamed("row", "synthetic_id")
