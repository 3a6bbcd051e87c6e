"""Reports over the log: density sweeps and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..operators.profile import correlations


def density_sweep(log: DataFrame, densities, labels, salt) -> DataFrame:
    """Interaction statistics at several densities, cumulative by period.

    Pairs join a density by one draw, so a sparser log is part of every denser one.  The
    log folds to one row per user and period before it is spread over densities and later
    periods.
    """
    cells = F.array(*[F.struct(F.lit(float(d)).alias("density"), F.lit(p).alias("upto"))
                      for d in densities for p in labels])
    drawn = log.select("user_idx", "item_idx", "period",
                       uniform(f"density.{salt}", "user_idx", "item_idx").alias("u"))

    def spread(keyed, count_items):
        key = "item_idx" if count_items else "user_idx"
        per = keyed.groupBy(key, "period").agg(
            *[F.count_if(F.col("u") < d).alias(f"n{i}") for i, d in enumerate(densities)])
        pick = F.lit(0)
        for i, d in enumerate(densities):
            pick = F.when(F.col("c.density") == d, F.col(f"n{i}")).otherwise(pick)
        out = per.withColumn("c", F.explode(F.filter(cells, lambda c: c["upto"] >= F.col("period"))))
        return (out.select(key, "c.density", "c.upto", pick.alias("n")).groupBy("density", "upto", key)
                .agg(F.sum("n").alias("n")).filter(F.col("n") > 0))

    users = spread(drawn, False).groupBy("density", "upto").agg(
        F.sum("n").alias("total_interactions"), F.count(F.lit(1)).alias("unique_users"),
        F.round(F.avg("n"), 6).alias("avg_per_user"), F.max("n").alias("max_per_user"),
        F.round(F.avg(F.when(F.col("n") > 1, F.lit(100.0)).otherwise(F.lit(0.0))), 6).alias("pct_with_multiple"))
    items = spread(drawn, True).groupBy("density", "upto").agg(F.count(F.lit(1)).alias("unique_items"))
    return users.join(items, ["density", "upto"])


def trajectory(results: DataFrame, metric: str) -> DataFrame:
    """One metric by model and period."""
    return results.select("model", "iter", F.col(metric).alias("value"))


def metric_correlations(results: DataFrame, metrics) -> DataFrame:
    return correlations(results, metrics)


# Metric names, descriptions and whether larger is better.
METRICS = (
    ("revenue", "total revenue of the purchases", True),
    ("discounted_revenue", "revenue weighted by the log discount of the rank", True),
    ("conversion_rate", "share of recommendations that were bought", True),
    ("precision_at_k", "share of the first k items that were bought", True),
    ("recall_at_k", "share of the relevant items among the first k", True),
    ("ndcg_at_k", "discounted gain over the best possible order", True),
    ("mrr", "mean reciprocal rank of the first purchase", True),
    ("hit_rate", "share of users with a purchase among the first k", True),
)


def metric_registry(spark) -> DataFrame:
    return spark.createDataFrame(METRICS, "metric string, description string, higher_is_better boolean")
