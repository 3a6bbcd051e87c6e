"""Aggregations over the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import elements
from ..operators.lists import LISTS_SQL, purchase_lists
from ..operators.profile import (correlations, coverage, cross_counts, group_share, histogram,
                                 interaction_stats, sequence_lengths, suitability)
from ..recommenders.content import user_profiles, vector_width
from ..recommenders.hybrid import blend
from ..recommenders.shared_score import item_counts, smoothed_popularity, ucb_score
from ..sources import views as V
from .registry import query
from .relational import segment_category_log

# Part types of the supplied schema, for the SQL; the queries take them from the data.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

STATS_SQL = ("cast(sum(n) as bigint) AS total_interactions, cast(count(*) as bigint) AS unique_users,"
             " round(avg(n), 6) AS avg_per_user, cast(max(n) as bigint) AS max_per_user,"
             " cast(count(CASE WHEN n > 1 THEN 1 END) as bigint) AS users_with_multiple,"
             " round(100.0 * count(CASE WHEN n > 1 THEN 1 END) / cast(count(*) as double), 6) AS pct_with_multiple")


@query("agg1_item_popularity", V.with_views(
    "SELECT item_idx, round((sum(relevance) + 1.0) / (count(relevance) + 2.0), 9) AS relevance FROM log GROUP BY item_idx",
    "log"))
def item_popularity(spark, path):
    return item_counts(V.log(spark, path)).select(
        "item_idx", F.round(smoothed_popularity(F.col("pos"), F.col("total")), 9).alias("relevance"))


@query("agg2_ucb_score", V.with_views(
    "SELECT item_idx, round(sum(relevance) / cast(count(*) as double)"
    " + sqrt(ln(cast(2 as double) * (SELECT count(*) FROM log)) / count(*)), 9) AS relevance FROM log GROUP BY item_idx", "log"))
def ucb(spark, path):
    log = V.log(spark, path)
    rows = log.agg(F.count(F.lit(1)).alias("n"))
    return item_counts(log).crossJoin(F.broadcast(rows)).select(  # a single row
        "item_idx", F.round(ucb_score(F.col("pos"), F.col("total"), F.col("n")), 9).alias("relevance"))


def _profile_sql():
    dims = ", ".join(f"CASE WHEN sum(relevance) > 0 THEN round(sum(relevance * cast(vec[{i + 1}] as double))"
                     f" / sum(relevance), 6) ELSE 0.0 END AS d{i}" for i in range(64))
    return V.with_views(f"SELECT user_idx, cast(count(*) as bigint) AS interactions, cast(sum(relevance) as double)"
                        f" AS relevance_sum, {dims} FROM log JOIN item_vec USING (item_idx) GROUP BY user_idx",
                        "log", "item_vec")


@query("agg3_user_profile", _profile_sql())
def profile(spark, path):
    vectors = V.item_vectors(spark, path)
    width = vector_width(V.table(spark, path, "embeddings").select(F.col("embedding").alias("vec")))
    return user_profiles(V.log(spark, path), vectors, width).select(
        "user_idx", "interactions", "relevance_sum",
        *elements("vec", width, 6))


@query("agg4_distinct_seen", V.with_views(
    "SELECT user_idx, cast(count(DISTINCT item_idx) as bigint) AS seen FROM log GROUP BY user_idx", "log"))
def distinct_seen(spark, path):
    return V.log(spark, path).groupBy("user_idx").agg(F.count_distinct("item_idx").alias("seen"))


@query("agg5_longest_history", V.with_views(
    "SELECT cast(coalesce(max(seen), 0) as bigint) AS longest FROM"
    " (SELECT count(DISTINCT item_idx) AS seen FROM log GROUP BY user_idx)", "log"))
def longest_history(spark, path):
    seen = V.log(spark, path).groupBy("user_idx").agg(F.count_distinct("item_idx").alias("seen"))
    return seen.agg(F.coalesce(F.max("seen"), F.lit(0)).cast("bigint").alias("longest"))


@query("agg6_blend", V.with_views(
    "SELECT user_idx, item_idx, relevance, models, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_idx"
    " ORDER BY relevance DESC, item_idx) AS rank FROM (SELECT user_idx, item_idx, round(sum(part), 9) AS relevance,"
    " string_agg(model, ',' ORDER BY model) AS models FROM ("
    " SELECT user_idx, item_idx, 1.0 / rank * cast(0.7 as double) AS part, '0' AS model FROM lists WHERE rank <= 10"
    " UNION ALL SELECT user_idx, item_idx, 1.0 / r2 * cast(0.3 as double) AS part, '1' AS model FROM (SELECT *,"
    " row_number() OVER (PARTITION BY user_idx ORDER BY revenue DESC, item_idx) AS r2 FROM lists) WHERE r2 <= 10)"
    " GROUP BY user_idx, item_idx)) WHERE rank <= 5", "log", extra=LISTS_SQL))
def blended(spark, path):
    from ..operators.ordering import top_k
    lists = purchase_lists(V.log(spark, path))
    spend = lists.filter("rank <= 10").select("user_idx", "item_idx", (F.lit(1.0) / F.col("rank")).alias("relevance"))
    earned = top_k(lists, ["user_idx"], [F.desc("revenue"), F.asc("item_idx")], 10, "r2").select(
        "user_idx", "item_idx", (F.lit(1.0) / F.col("r2")).alias("relevance"))
    return blend([(spend, 0.7), (earned, 0.3)], 5)


@query("agg7_total_revenue", V.with_views(
    "SELECT round(coalesce(sum(relevance * amount), 0), 4) AS revenue FROM log", "log"))
def total_revenue(spark, path):
    return V.log(spark, path).agg(
        F.round(F.coalesce(F.sum(F.col("relevance") * F.col("amount")), F.lit(0.0)), 4).alias("revenue"))


@query("agg8_interaction_stats", V.with_views(
    f"SELECT {STATS_SQL}, (SELECT cast(count(DISTINCT item_idx) as bigint) FROM log) AS unique_items"
    " FROM (SELECT user_idx, count(*) AS n FROM log GROUP BY user_idx)", "log"))
def stats(spark, path):
    return interaction_stats(V.log(spark, path))


@query("agg9_sequence_lengths", V.with_views(
    "SELECT length, cast(count(*) as bigint) AS users FROM (SELECT user_idx, cast(count(*) as bigint) AS length"
    " FROM log GROUP BY user_idx) GROUP BY length", "log"))
def lengths(spark, path):
    return sequence_lengths(V.log(spark, path))


@query("agg10_segment_share", V.with_views(
    "SELECT segment, cast(count(*) as bigint) AS n, round(100.0 * count(*) / cast((SELECT count(*) FROM users) as double), 6)"
    " AS pct FROM users GROUP BY segment", "users"))
def segment_share(spark, path):
    return group_share(V.users(spark, path), "segment")


@query("agg10_category_share", V.with_views(
    "SELECT category, cast(count(*) as bigint) AS n, round(100.0 * count(*) / cast((SELECT count(*) FROM items) as double), 6)"
    " AS pct FROM items GROUP BY category", "items"))
def category_share(spark, path):
    return group_share(V.items(spark, path), "category")


@query("agg11_density_coverage", V.with_views(
    "SELECT cast(i as bigint) AS interactions, cast(u as bigint) AS users, cast(t as bigint) AS items,"
    " round(100.0 * i / (cast(u as double) * t), 6) AS density_pct, round(100.0 * au / cast(u as double), 6) AS user_coverage_pct,"
    " round(100.0 * ai / cast(t as double), 6) AS item_coverage_pct FROM (SELECT (SELECT count(*) FROM log) AS i,"
    " (SELECT count(*) FROM users) AS u, (SELECT count(*) FROM items) AS t, (SELECT count(DISTINCT user_idx) FROM log) AS au,"
    " (SELECT count(DISTINCT item_idx) FROM log) AS ai)", "log", "users", "items"))
def density_coverage(spark, path):
    return coverage(V.log(spark, path), V.users(spark, path), V.items(spark, path))


@query("agg12_user_counts", V.with_views("SELECT user_idx, cast(count(*) as bigint) AS n FROM log GROUP BY user_idx", "log"))
def user_counts(spark, path):
    return V.log(spark, path).groupBy("user_idx").agg(F.count(F.lit(1)).alias("n"))


@query("agg12_item_counts", V.with_views("SELECT item_idx, cast(count(*) as bigint) AS n FROM log GROUP BY item_idx", "log"))
def counts_by_item(spark, path):
    return V.log(spark, path).groupBy("item_idx").agg(F.count(F.lit(1)).alias("n"))


@query("agg13_relevance_distribution", V.with_views(
    "SELECT relevance, cast(count(*) as bigint) AS n FROM log GROUP BY relevance", "log"))
def relevance_distribution(spark, path):
    return V.log(spark, path).groupBy("relevance").agg(F.count(F.lit(1)).alias("n"))


@query("agg14_segment_category_pivot", V.with_views(
    "SELECT segment, " + ", ".join(f"cast(count(CASE WHEN category = '{c}' THEN 1 END) as bigint) AS \"{c}\"" for c in CATEGORIES)
    + " FROM log JOIN users USING (user_idx) JOIN items USING (item_idx) GROUP BY segment", "log", "users", "items"))
def segment_category_pivot(spark, path):
    return cross_counts(segment_category_log(spark, path), "segment", "category", "n")


@query("agg14_pivot_by_brand", V.with_views(
    "SELECT brand, " + ", ".join(f"cast(count(CASE WHEN category = '{c}' THEN 1 END) as bigint) AS \"{c}\"" for c in CATEGORIES)
    + " FROM items GROUP BY brand", "items"))
def pivot_by_brand(spark, path):
    return cross_counts(V.items(spark, path), "brand", "category")


def _histogram_sql(source, column, bins, by=""):
    b = f"{by}, " if by else ""
    return (f"SELECT {b}bin, cast(count(*) as bigint) AS n, round(min(lo), 6) AS low, round(max(hi), 6) AS high FROM"
            f" (SELECT {b}lo, hi, cast(CASE WHEN hi > lo THEN least(floor(({column} - lo) / (hi - lo) * {bins}), {bins - 1})"
            f" ELSE 0 END as bigint) AS bin FROM {source}, (SELECT cast(min({column}) as double) AS lo,"
            f" cast(max({column}) as double) AS hi FROM {source})) GROUP BY {b}bin")


@query("agg15_price_histogram", V.with_views(_histogram_sql("items", "price", 30), "items"))
def price_histogram(spark, path):
    return histogram(V.items(spark, path), "price", 30)


@query("agg15_balance_histogram_by_segment", V.with_views(_histogram_sql("users", "acctbal", 20, "segment"), "users"))
def balance_histogram(spark, path):
    return histogram(V.users(spark, path), "acctbal", 20, ["segment"])


@query("agg16_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for a, b in [("l_quantity", "l_quantity"), ("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"),
                 ("l_extendedprice", "l_extendedprice"), ("l_extendedprice", "l_discount"), ("l_discount", "l_discount")]))
def attribute_correlations(spark, path):
    return correlations(V.table(spark, path, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("agg17_score_share", V.with_views(
    "SELECT item_idx, round(s / (SELECT sum(s) FROM t), 12) AS probability FROM t", "log",
    extra="t AS (SELECT item_idx, (sum(relevance) + cast(1 as double)) / (count(*) + cast(2 as double)) AS s FROM log GROUP BY item_idx)"))
def score_share(spark, path):
    scores = item_counts(V.log(spark, path)).select("item_idx", smoothed_popularity(F.col("pos"), F.col("total")).alias("s"))
    total = scores.agg(F.sum("s").alias("total"))
    return scores.crossJoin(F.broadcast(total)).select(  # a single row
        "item_idx", F.round(F.col("s") / F.col("total"), 12).alias("probability"))


@query("agg20_suitability", V.with_views(
    "SELECT iter, avg_per_user, pct_with_multiple, CASE WHEN avg_per_user >= 2.5 AND pct_with_multiple >= 30 THEN 'Good'"
    " WHEN avg_per_user >= 2.0 AND pct_with_multiple >= 20 THEN 'Moderate' ELSE 'Poor' END AS rating,"
    " round(avg_per_user * pct_with_multiple / 100, 6) AS score FROM (SELECT iter, " + STATS_SQL +
    " FROM (SELECT iter, user_idx, count(*) AS n FROM log GROUP BY iter, user_idx) GROUP BY iter)", "log"))
def suitable(spark, path):
    return suitability(interaction_stats(V.log(spark, path), ["iter"])).select(
        "iter", "avg_per_user", "pct_with_multiple", "rating", "score")


@query("agg20_best_period", V.with_views(
    "SELECT iter FROM (SELECT iter, avg(n) * count(CASE WHEN n > 1 THEN 1 END) / cast(count(*) as double) AS s FROM"
    " (SELECT iter, user_idx, count(*) AS n FROM log GROUP BY iter, user_idx) GROUP BY iter) ORDER BY round(s, 6) DESC, iter LIMIT 1",
    "log"))
def best_period(spark, path):
    rated = suitability(interaction_stats(V.log(spark, path), ["iter"]))
    return rated.orderBy(F.desc("score"), "iter").limit(1).select("iter")


