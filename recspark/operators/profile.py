"""Statistics of interaction logs and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import cut


def interaction_stats(log: DataFrame, by=()) -> DataFrame:
    """Totals and per-user statistics, in one job for all ``by`` groups."""
    users = log.groupBy(*by, "user_idx").agg(F.count(F.lit(1)).alias("n"))
    per_user = users.groupBy(*by).agg(
        F.sum("n").alias("total_interactions"), F.count(F.lit(1)).alias("unique_users"),
        F.round(F.avg("n"), 6).alias("avg_per_user"), F.max("n").alias("max_per_user"),
        F.count_if(F.col("n") > 1).alias("users_with_multiple"),
        F.round(F.avg(F.when(F.col("n") > 1, F.lit(100.0)).otherwise(F.lit(0.0))), 6).alias("pct_with_multiple"))
    per_item = log.select(*by, "item_idx").distinct().groupBy(*by).agg(
        F.count(F.lit(1)).alias("unique_items"))
    if by:
        return per_user.join(per_item, list(by))
    return per_user.crossJoin(F.broadcast(per_item))  # a single row


def sequence_lengths(log: DataFrame) -> DataFrame:
    users = log.groupBy("user_idx").agg(F.count(F.lit(1)).alias("length"))
    return users.groupBy("length").agg(F.count(F.lit(1)).alias("users"))


def suitability(stats: DataFrame) -> DataFrame:
    """Rate logs for sequence models by mean length and share of repeat users."""
    avg, pct = F.col("avg_per_user"), F.col("pct_with_multiple")
    rating = (F.when((avg >= 2.5) & (pct >= 30), F.lit("Good"))
              .when((avg >= 2.0) & (pct >= 20), F.lit("Moderate")).otherwise(F.lit("Poor")))
    return stats.withColumn("rating", rating).withColumn("score", F.round(avg * pct / 100, 6))


def group_share(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    return (counts.crossJoin(F.broadcast(total))  # a single row
            .select(column, "n", F.round(F.lit(100.0) * F.col("n") / F.col("__total"), 6).alias("pct")))


def coverage(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Density of the user-item matrix and the share of users and items that occur."""
    rows = log.agg(F.count(F.lit(1)).alias("interactions"))
    active_users = log.select("user_idx").distinct().agg(F.count(F.lit(1)).alias("active_users"))
    active_items = log.select("item_idx").distinct().agg(F.count(F.lit(1)).alias("active_items"))
    n_users = users.agg(F.count(F.lit(1)).alias("users"))
    n_items = items.agg(F.count(F.lit(1)).alias("items"))
    one = rows
    for part in (active_users, active_items, n_users, n_items):
        one = one.crossJoin(F.broadcast(part))  # single rows
    pct = lambda a, b: F.round(F.lit(100.0) * F.col(a) / F.col(b), 6)
    return one.select(
        "interactions", "users", "items",
        F.round(F.lit(100.0) * F.col("interactions") / (F.col("users").cast("double") * F.col("items")), 6).alias("density_pct"),
        pct("active_users", "users").alias("user_coverage_pct"),
        pct("active_items", "items").alias("item_coverage_pct"))


def histogram(df: DataFrame, column: str, bins: int, by=()) -> DataFrame:
    """Counts per equal-width bin between the column's minimum and maximum."""
    span = df.agg(F.min(column).cast("double").alias("__lo"), F.max(column).cast("double").alias("__hi"))
    at = F.floor((F.col(column) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins)
    at = F.when(F.col("__hi") > F.col("__lo"), F.least(at, F.lit(bins - 1))).otherwise(F.lit(0))
    return (df.filter(F.col(column).isNotNull()).crossJoin(F.broadcast(span))  # a single row
            .groupBy(*by, at.cast("bigint").alias("bin")).agg(
                F.count(F.lit(1)).alias("n"),
                F.round(F.min(F.col("__lo") + F.lit(0.0)), 6).alias("low"),
                F.round(F.max(F.col("__hi") + F.lit(0.0)), 6).alias("high")))


def correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every pair of columns, as (x, y, r), from one aggregate."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), 6).alias(f"{a}|{b}")
                    for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("r"))
                     for a, b in pairs])
    return wide.select(F.explode(rows).alias("c")).select("c.*")


def cross_counts(df: DataFrame, row: str, column: str, n: str | None = None) -> DataFrame:
    """Pivot of counts, or of sums of ``n``, with zeros for missing combinations.

    The columns are the values found in ``column``; nulls, if any, are counted in column ``null``.
    """
    counts = cut(df.groupBy(row, column).agg((F.count(F.lit(1)) if n is None else F.sum(n)).alias("n")))
    values = sorted((r[0] for r in counts.select(column).distinct().collect()), key=lambda v: (v is None, v))
    return counts.groupBy(row).agg(*[
        F.coalesce(F.sum(F.when(F.col(column).eqNullSafe(F.lit(v)), F.col("n"))), F.lit(0)).alias("null" if v is None else str(v))
        for v in values])
