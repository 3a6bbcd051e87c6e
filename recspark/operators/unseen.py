"""Picking items a user has not seen, without enumerating user-item pairs.

Items carry a dense position (by score, or by id).  "The r-th unseen item of a user" is
then arithmetic on the positions the user has seen: it sits at ``r`` plus the number of
seen positions before it.  So top-k by a shared score is r = 0..k-1, a random pick is a
random r, and the work is linear in the log instead of users x items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_POSITIONS = 4096


def unseen_positions(seen: DataFrame, wanted: DataFrame, keys, rank="nth", pos="pos",
                     width=BUCKET_POSITIONS, one_bucket=False) -> DataFrame:
    """Map each ``wanted`` row (keys, rank) to the position of that unseen item.

    ``seen`` holds (keys, pos), repeats allowed.  Seen positions are folded into buckets of
    ``width``, so no group exceeds ``width`` entries however long one user's history is.
    The result may lie past the last item when a user has too few unseen ones; joining to
    the item positions drops those rows.  ``one_bucket`` says that all seen positions are below
    ``width``; then one join does.
    """
    keys = list(keys)
    if one_bucket:
        taken = seen.groupBy(*keys).agg(F.sort_array(F.collect_set(F.col(pos).cast("int"))).alias("__taken"))
        before = F.size(F.filter("__taken", lambda x, j: x - j <= F.col(rank)))
        return (wanted.join(taken, keys, "left")
                .withColumn(pos, F.col(rank) + F.when(F.col("__taken").isNull(), F.lit(0)).otherwise(before))
                .drop("__taken"))
    buckets = (seen.select(*keys, F.expr(f"{pos} div {width}").alias("__b"),
                           (F.col(pos) % width).cast("int").alias("__in"))
               .groupBy(*keys, "__b")
               .agg(F.sort_array(F.collect_set("__in")).alias("__taken")))
    earlier = (Window.partitionBy(*keys).orderBy("__b")
               .rowsBetween(Window.unboundedPreceding, -1))
    filled = buckets.select(
        *keys, "__b",
        F.coalesce(F.sum(F.size("__taken").cast("bigint")).over(earlier), F.lit(0)).alias("__gone"))
    # free slots before the bucket, in bucket order; one entry per touched bucket
    index = filled.groupBy(*keys).agg(F.collect_list(F.struct(
        (F.col("__b") * width - F.col("__gone")).alias("free"),
        F.col("__b").alias("b"), F.col("__gone").alias("gone"))).alias("__index"))
    home = F.array_max(F.filter("__index", lambda e: e["free"] <= F.col(rank)))
    placed = (wanted.join(index, keys, "left").withColumn("__home", home)
              .withColumn("__b", F.col("__home.b"))
              .withColumn("__base", F.col(rank) + F.coalesce(F.col("__home.gone"), F.lit(0)))
              .drop("__index", "__home"))
    taken_before = F.size(F.filter(
        "__taken", lambda x, j: x - j <= F.col("__base") - F.col("__b") * width))
    shift = F.when(F.col("__taken").isNull(), F.lit(0)).otherwise(taken_before)
    return (placed.join(buckets, [*keys, "__b"], "left")
            .withColumn(pos, F.col("__base") + shift)
            .drop("__b", "__base", "__taken"))


def first_ranks(k: int) -> Column:
    """The ranks 0..k-1, one row each."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))


def random_ranks(free, draws) -> Column:
    """Distinct ranks out of ``0..free-1`` in random order, one per uniform in ``draws``.

    Draw j picks among the ``free - j`` ranks that are left; stepping over the ranks taken
    so far, in ascending order, turns that into a rank.  Fewer come back where ``free`` is
    smaller than the number of draws.
    """
    free, draws = (F.col(c) if isinstance(c, str) else c for c in (free, draws))

    def take(picked, u):
        left = free - F.size(picked)
        rank = F.aggregate(F.sort_array(picked), F.floor(u * left).cast("bigint"),
                           lambda at, taken: F.when(at >= taken, at + 1).otherwise(at))
        return F.when(left > 0, F.concat(picked, F.array(rank))).otherwise(picked)

    return F.aggregate(draws, F.array().cast("array<bigint>"), take)
