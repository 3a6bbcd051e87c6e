"""Recommendation lists: enrichment with features, responses and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import bernoulli, binarise, log_discount, noise
from .joins import salted_join
from .ordering import rank_in_key, top_k


def enrich(recs: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """Left-join features to a list; columns the list already has are kept as they are."""
    if users is not None:
        extra = [c for c in users.columns if c == "user_idx" or c not in recs.columns]
        recs = recs.join(users.select(*extra), "user_idx", "left")
    if items is not None:
        extra = [c for c in items.columns if c == "item_idx" or c not in recs.columns]
        recs = salted_join(recs, items.select(*extra), ["item_idx"], ["user_idx"], "left")
    return recs


def draw_responses(recs: DataFrame, seed=42, mu=0.1, sigma=0.05, model="noise", weight=1.0) -> DataFrame:
    """Append a purchase probability, a drawn 0/1 response and its revenue.

    ``model="noise"`` uses Gaussian noise alone; ``"additive"`` adds it to ``weight`` times
    the predicted relevance and clips to [0, 1].
    """
    keys = ("user_idx", "item_idx")
    p = noise(mu, sigma, f"response.{seed}.noise", *keys)
    if model == "additive":
        p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(float(weight)) * F.col("relevance") + p))
    elif model != "noise":
        raise ValueError(f"unknown response model: {model}")
    return (recs.withColumn("probability", p)
            .withColumn("response", bernoulli("probability", f"response.{seed}.buy", *keys))
            .withColumn("revenue", F.col("response") * F.col("price")))


def with_rank(df: DataFrame, user="user_idx", relevance="relevance", item="item_idx") -> DataFrame:
    """Append a rank by falling relevance unless the table has one."""
    if "rank" in df.columns:
        return df
    return rank_in_key(df, [user], [F.desc(relevance), F.asc(item)], "rank")


def purchase_lists(log: DataFrame, length: int | None = None) -> DataFrame:
    """Every user's items by money spent, all or the first ``length``: (user_idx, item_idx, relevance, response, revenue, rank)."""
    spent = log.groupBy("user_idx", "item_idx").agg(
        F.round(F.sum("amount"), 4).alias("relevance"), F.max("relevance").alias("response"),
        F.round(F.sum(F.col("relevance") * F.col("amount")), 4).alias("revenue"))
    order = [F.desc("relevance"), F.asc("item_idx")]
    best = rank_in_key(spent, ["user_idx"], order) if length is None else top_k(spent, ["user_idx"], order, length)
    return best.withColumn("rank", F.col("rank").cast("bigint"))


LISTS_SQL = ("lists AS (SELECT *, row_number() OVER (PARTITION BY user_idx"
                   " ORDER BY relevance DESC, item_idx) AS rank FROM (SELECT user_idx, item_idx,"
                   " round(sum(amount), 4) AS relevance, max(relevance) AS response,"
                   " round(sum(relevance * amount), 4) AS revenue FROM log GROUP BY user_idx, item_idx))")


def training_log(log: DataFrame) -> DataFrame:
    """Binary feedback for a fit: drawn responses where the log has them, else relevance."""
    source = "response" if "response" in log.columns else "relevance"
    return log.withColumn("relevance", binarise(source)).drop("response")


__all__ = ["enrich", "draw_responses", "with_rank", "purchase_lists",
           "training_log", "log_discount", "LISTS_SQL"]
