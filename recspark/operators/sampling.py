"""Row samples, quotas and item selection, reproducible on any data layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..recommenders.random_pick import random_unseen
from .joins import lookup_join
from .ordering import rank_in_key, with_position

# Up to this many items form a shared set: a sorted limit is merged in one task.
SHARED_ITEMS = 10_000
# Pairs that a task compares with drawn ones.
PAIR_ROWS = 500_000
# Draws fall into this many buckets to find the one in which a sample ends.
DRAW_BUCKETS = 1 << 16


class SeedSequence:
    """A new salt for each call, fixed by the initial seed."""

    def __init__(self, seed: int):
        self.seed, self.calls = seed, 0

    def next(self) -> str:
        self.calls += 1
        return f"{self.seed}.{self.calls}"


def bernoulli_rows(df: DataFrame, fraction: float, salt, keys) -> DataFrame:
    """Each row with probability ``fraction``."""
    return df.filter(uniform(f"bernoulli.{salt}", *keys) < F.lit(float(fraction)))


def require_rows(df: DataFrame, n: int = 1) -> DataFrame:
    """Raise unless the table has at least ``n`` rows."""
    if df.select(F.lit(1)).limit(n).count() < n:
        raise ValueError(f"fewer than {n} rows")
    return df


def _smallest_draws(drawn: DataFrame, by, quota: DataFrame, keys) -> DataFrame:
    """The ``quota`` rows with the smallest ``__u`` of every ``by`` group.

    A histogram of the draws tells in which bucket each group's sample ends.  Rows of
    earlier buckets are taken as they are; only the last bucket, a thin slice of the table,
    is ranked.
    """
    by = list(by)
    drawn = drawn.withColumn("__b", F.floor(F.col("__u") * DRAW_BUCKETS).cast("int"))
    counts = drawn.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    # one row per group
    ends = (counts.join(quota, by).filter(F.col("__before") < F.col("quota")).groupBy(*by)
            .agg(F.max(F.struct("__b", (F.col("quota") - F.col("__before")).alias("need"))).alias("__end")))
    cuts = ends.select(*by, F.col("__end.__b").alias("__cut"), F.col("__end.need").alias("__need"))
    marked = lookup_join(drawn, cuts, by, keys)
    columns = [c for c in drawn.columns if c not in ("__u", "__b")]
    sure = marked.filter(F.col("__b") < F.col("__cut")).select(*columns)
    edge = rank_in_key(marked.filter(F.col("__b") == F.col("__cut")), by, ["__u", *keys], "__rank")
    return sure.unionByName(edge.filter(F.col("__rank") <= F.col("__need")).select(*columns))


def exact_rows(df: DataFrame, n: int, salt, keys) -> DataFrame:
    """Exactly ``n`` random rows; more than there are is an error."""
    if n > df.count():
        raise ValueError("more rows requested than there are")
    quota = df.sparkSession.range(1).select(F.lit(0).alias("__all"), F.lit(n).cast("bigint").alias("quota"))
    drawn = df.withColumn("__u", uniform(f"exact.{salt}", *keys)).withColumn("__all", F.lit(0))
    return _smallest_draws(drawn, ["__all"], quota, keys).drop("__all")


def shares(df: DataFrame, stratum: str) -> DataFrame:
    """Rows and weight of every stratum; the weights sum to 1."""
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("__total"))
    return (counts.crossJoin(F.broadcast(total))  # a single row
            .select(stratum, "rows", (F.col("rows") / F.col("__total")).alias("weight")))


def quotas(weights: DataFrame, stratum: str, total: int, mode="floor") -> DataFrame:
    """Rows to take per stratum.

    ``floor`` truncates and gives the remainder to the last stratum; ``round`` rounds each,
    halves to the even number.
    """
    exact = F.col("weight") * F.lit(total)
    if mode == "round":
        return weights.withColumn("quota", F.bround(exact).cast("bigint"))
    whole = weights.withColumn("__q", F.floor(exact + F.lit(1e-9)).cast("bigint"))
    sums = whole.agg(F.sum("__q").alias("__sum"), F.max(stratum).alias("__last"))
    rest = F.when(F.col(stratum) == F.col("__last"), F.lit(total) - F.col("__sum")).otherwise(F.lit(0))
    return (whole.crossJoin(F.broadcast(sums))  # a single row
            .withColumn("quota", F.col("__q") + rest).drop("__q", "__sum", "__last"))


def quota_sample(df: DataFrame, stratum: str, quota: DataFrame, salt, keys) -> DataFrame:
    """``quota`` random rows of every stratum, however uneven the strata are."""
    drawn = df.withColumn("__u", uniform(f"quota.{salt}", *keys))
    return _smallest_draws(drawn, [stratum], quota.select(stratum, "quota"), keys)


def composite_rows(df: DataFrame, stratum: str, fraction: float, weights: dict, salt, keys) -> DataFrame:
    """Bernoulli sample whose strata follow ``weights`` instead of their sizes.

    One pass over the table instead of a union of samples; a stratum that would have to
    give more rows than it has is an error.
    """
    sizes = {r[stratum]: r["rows"] for r in
             df.filter(F.col(stratum).isin(list(weights))).groupBy(stratum)
             .agg(F.count(F.lit(1)).alias("rows")).collect()}  # one row per weight
    total = sum(sizes.values())
    rate = F.lit(0.0)
    for name, weight in weights.items():
        size, wanted = sizes.get(name, 0), int(total * fraction * weight)
        if wanted > size:
            raise ValueError(f"not enough rows in {name}")
        rate = F.when(F.col(stratum) == name, F.lit(wanted / size if size else 0.0)).otherwise(rate)
    return df.filter(uniform(f"composite.{salt}", *keys) < rate)


def shared_items(users: DataFrame, items: DataFrame, k: int, salt) -> DataFrame:
    """One random set of ``k`` items, given to every user."""
    for table, key in ((users, "user_idx"), (items, "item_idx")):
        if key not in table.columns:
            raise ValueError(f"no column {key}")
    if k > SHARED_ITEMS:
        raise ValueError(f"a shared set holds at most {SHARED_ITEMS} items")
    chosen = (items.select("item_idx").orderBy(uniform(f"shared.{salt}", "item_idx"), "item_idx").limit(k)
              .agg(F.sort_array(F.collect_list("item_idx")).alias("__set")))  # k values
    return users.select("user_idx").crossJoin(F.broadcast(chosen)).select(
        "user_idx", F.explode("__set").alias("item_idx"))


def own_items(users: DataFrame, items: DataFrame, k: int, seed: int) -> DataFrame:
    """``k`` random items drawn separately for each user."""
    return random_unseen(users, items, None, k, seed).select("user_idx", "item_idx")


def candidates(users: DataFrame, items: DataFrame, log: DataFrame | None, select) -> tuple[DataFrame, DataFrame | None]:
    """The pairs that ``select(users, items)`` proposes, and the part of the log that belongs to these users.

    There is no log before the first interaction: None stays None.
    """
    pairs = select(users, items)
    return pairs, None if log is None else log.join(users.select("user_idx").distinct(), "user_idx", "left_semi")


def labelled_ids(df: DataFrame, key: str, label) -> DataFrame:
    """The key as text behind a label, so that ids of several generated tables cannot meet; null stays null."""
    label = F.col(label) if isinstance(label, str) and label in df.columns else F.lit(label)
    return df.withColumn(key, F.concat(label, F.lit("_"), F.col(key).cast("string")))


def composite_table(df: DataFrame, stratum: str, total: int, salt, keys, weights: DataFrame | None = None) -> DataFrame:
    """``total`` rows made up of the strata by their weights (their own shares by default), rounded per stratum.

    A stratum gives its rows with the smallest draws; one that would have to give more than it has is an error.
    """
    sizes = shares(df, stratum)
    wanted = quotas(sizes if weights is None else weights, stratum, total, "round")
    short = wanted.join(sizes.select(stratum, F.col("rows").alias("__rows")), stratum, "left").where(F.col("quota") > F.coalesce("__rows", F.lit(0)))
    if not short.isEmpty():
        raise ValueError("a stratum has too few rows")
    return quota_sample(df, stratum, wanted, salt, keys)


def negative_pairs(log: DataFrame, items: DataFrame, salt) -> DataFrame:
    """One random item per interacted pair, kept where the user has not interacted with it."""
    pairs = log.select("user_idx", "item_idx").distinct()
    placed = with_position(items.select("item_idx"), ["item_idx"])
    total = items.agg(F.count(F.lit(1)).alias("__n"))
    # parts by counted rows: Spark merges small shuffle files, whose rows are ten times wider in memory
    parts = max(log.sparkSession.sparkContext.defaultParallelism, -(-log.count() // PAIR_ROWS))
    drawn = pairs.crossJoin(F.broadcast(total)).select(  # a single row
        "user_idx", F.floor(uniform(f"negative.{salt}", "user_idx", "item_idx") * F.col("__n"))
        .cast("bigint").alias("pos"))
    chosen = drawn.join(placed, "pos").select("user_idx", "item_idx").repartition(parts, "user_idx", "item_idx").distinct()
    return chosen.join(pairs.repartition(parts, "user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")


