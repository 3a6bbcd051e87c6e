"""Ranking metrics of recommendation lists, all from one pass per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import geometric_discount, log_discount

RANKING = ("precision_at_k", "ndcg_at_k", "mrr", "hit_rate", "discounted_revenue", "revenue",
           "conversion_rate", "geometric_dcg")


def _gain(responses):
    """Sum of responses over log2 of their 1-based place plus one."""
    return F.aggregate(
        F.transform(responses, lambda x, i: x / F.log2(i + F.lit(2.0))), F.lit(0.0), lambda a, x: a + x)


def per_user(lists: DataFrame, k: int, by=(), denominator="rows") -> DataFrame:
    """One row per user with the parts that the metrics average."""
    inside = F.col("rank") <= k
    response = F.col("response").cast("double")
    counted = F.sum(F.when(inside, response))
    base = F.count(F.when(inside, response)) if denominator == "rows" else F.lit(float(k))
    users = lists.groupBy(*by, "user_idx").agg(
        (counted / base).alias("precision"),
        # no more than k entries, as ranks are unique per user
        F.sort_array(F.collect_list(F.when(inside, F.struct("rank", response.alias("r"))))).alias("head"),
        F.min(F.when(response > 0, F.col("rank"))).alias("first_hit"),
        F.max(F.when(inside, (response > 0).cast("int"))).alias("hit"),
        F.sum(F.when(inside, F.col("revenue") * log_discount("rank"))).alias("discounted"),
        F.sum("revenue").alias("revenue"),
        F.sum(response).alias("responses"), F.count(response).alias("rows"),
        F.sum(F.when(inside, F.col("relevance") * geometric_discount("rank"))).alias("geometric"))
    gains = F.transform("head", lambda x: x["r"])
    best = _gain(F.sort_array(gains, asc=False))
    return users.select(
        *by, "user_idx", "precision", F.when(best > 0, _gain(gains) / best).alias("ndcg"),
        F.coalesce(F.lit(1.0) / F.col("first_hit"), F.lit(0.0)).alias("rr"),
        "hit", "discounted", "revenue", "responses", "rows", "geometric")


def ranking_metrics(lists: DataFrame, k: int, by=(), denominator="rows", digits=6) -> DataFrame:
    """One row of metrics per ``by`` group.

    Precision divides by the rows present (or by k), users without any positive response
    do not enter NDCG, and the reciprocal rank looks past k.
    """
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), digits)
    total = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0.0)), 4)
    parts = per_user(lists, k, by, denominator)
    return parts.groupBy(*by).agg(
        mean("precision").alias("precision_at_k"), mean("ndcg").alias("ndcg_at_k"),
        mean("rr").alias("mrr"), mean("hit").alias("hit_rate"),
        total("discounted").alias("discounted_revenue"), total("revenue").alias("revenue"),
        F.round(F.coalesce(F.sum("responses") / F.sum("rows"), F.lit(0.0)), digits).alias("conversion_rate"),
        mean("geometric").alias("geometric_dcg"))


def ranking_metrics_sql(lists: str, k: int, by: str = "") -> tuple[str, str]:
    """The same metrics as SQL: a list of CTEs over table ``lists`` and a final select."""
    b = f"{by}, " if by else ""
    part = f"PARTITION BY {b}user_idx"
    ctes = (
        f"heads AS (SELECT *, row_number() OVER ({part} ORDER BY rank) AS place,"
        f" row_number() OVER ({part} ORDER BY response DESC, rank) AS ideal FROM {lists} WHERE rank <= {k}),"
        f" gains AS (SELECT {b}user_idx, avg(response) AS precision, max(response) AS hit,"
        f" sum(response / log2(place + 1)) / nullif(sum(response / log2(ideal + 1)), 0) AS ndcg,"
        f" sum(revenue / log2(rank + 1)) AS discounted,"
        f" sum(relevance * pow(cast(0.85 as double), rank - 1)) AS geometric"
        f" FROM heads GROUP BY {b}user_idx),"
        f" alls AS (SELECT {b}user_idx, coalesce(1 / min(CASE WHEN response > 0 THEN rank END), 0) AS rr,"
        f" sum(revenue) AS revenue, sum(response) AS responses, count(response) AS n"
        f" FROM {lists} GROUP BY {b}user_idx)")
    select = (
        f"SELECT {b}round(coalesce(avg(precision), 0), 6) AS precision_at_k,"
        " round(coalesce(avg(ndcg), 0), 6) AS ndcg_at_k, round(avg(rr), 6) AS mrr,"
        " round(coalesce(avg(cast(hit > 0 as int)), 0), 6) AS hit_rate,"
        " round(coalesce(sum(discounted), 0), 4) AS discounted_revenue,"
        " round(coalesce(sum(revenue), 0), 4) AS revenue,"
        " round(sum(responses) / cast(sum(n) as double), 6) AS conversion_rate,"
        " round(coalesce(avg(geometric), 0), 6) AS geometric_dcg"
        f" FROM alls LEFT JOIN gains USING ({b}user_idx)" + (f" GROUP BY {by}" if by else ""))
    return ctes, select


def recall_at_k(lists: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Mean share of each user's relevant items that appear among the first k."""
    relevant = truth.select("user_idx", "item_idx").distinct()
    needed = relevant.groupBy("user_idx").agg(F.count(F.lit(1)).alias("relevant"))
    hits = (lists.filter(F.col("rank") <= k).select("user_idx", "item_idx")
            .join(relevant, ["user_idx", "item_idx"]).groupBy("user_idx")
            .agg(F.count(F.lit(1)).alias("hits")))
    share = F.coalesce("hits", F.lit(0)) / F.col("relevant")
    return needed.join(hits, "user_idx", "left").agg(
        F.round(F.avg(share), 6).alias("recall_at_k"), F.count(F.lit(1)).alias("users"))


def metrics_long(wide: DataFrame, keys, metrics=RANKING[:6]) -> DataFrame:
    """Wide metric rows to (keys, metric, value)."""
    return wide.unpivot(list(keys), [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
