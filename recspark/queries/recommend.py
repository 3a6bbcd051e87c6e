"""Recommenders, evaluated over all users and all items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.durable import scratch_path
from ..recommenders import (BanditRecommender, ContentRecommender, HybridRecommender, KernelRecommender,
                            ForestRecommender, LinearRecommender, PopularityRecommender,
                            PriceBanditRecommender, RandomRecommender)
from ..recommenders.state import load_model, save_model
from ..sources import views as V
from .registry import query
from .samples import random_pick_sql

K = 5
UNSEEN = ("seen AS (SELECT DISTINCT user_idx, item_idx FROM log), unseen AS (SELECT user_idx, item_idx FROM"
          " (SELECT user_idx, item_idx FROM users CROSS JOIN items) ANTI JOIN seen USING (user_idx, item_idx))")


def shared_sql(score: str, tie: str = "ASC", k: int = K) -> str:
    """CTEs: every user's best unseen items by a shared score, by brute force over all pairs."""
    return (f"{UNSEEN}, n AS (SELECT count(*) AS n FROM log), c AS (SELECT item_idx, sum(relevance) AS pos,"
            " cast(count(relevance) as double) AS total FROM log GROUP BY item_idx),"
            f" scores AS (SELECT item_idx, {score} AS relevance FROM items LEFT JOIN c USING (item_idx), n),"
            " best AS (SELECT * FROM (SELECT user_idx, item_idx, relevance, row_number() OVER (PARTITION BY user_idx"
            f" ORDER BY relevance DESC, item_idx {tie}) AS rank FROM unseen JOIN scores USING (item_idx)) WHERE rank <= {k})")


POPULARITY = "coalesce((pos + 1.0) / (total + 2.0), 0.5)"
UCB = "coalesce(pos / total + sqrt(ln(2.0 * n) / total), 1 + sqrt(ln(2.0 * n)))"
PRICED = f"0.7 * {UCB} + 0.3 * price / (SELECT max(price) FROM items)"
OUT = "SELECT user_idx, item_idx, round(relevance, 6) AS relevance, rank FROM best"


def _tables(spark, path):
    return V.log(spark, path), V.users(spark, path), V.items(spark, path)


def _out(recs):
    return recs.select("user_idx", "item_idx", F.round("relevance", 6).alias("relevance"), "rank")


def _run(model, spark, path, k=K, **features):
    log, users, items = _tables(spark, path)
    model.fit(log, users, features.get("item_features", items))
    return _out(model.predict(log, k, users, items, **features))


@query("rec1_random", V.with_views(
    "SELECT user_idx, item_idx, round(relevance, 6) AS relevance, rank FROM picks JOIN (SELECT *, row_number() OVER"
    " (PARTITION BY user_idx ORDER BY item_idx) - 1 AS nth FROM unseen) USING (user_idx, nth)", "log", "users", "items",
    extra=f"{UNSEEN}, base AS (SELECT user_idx, (SELECT count(*) FROM items) - count(item_idx) AS free FROM users"
          f" LEFT JOIN seen USING (user_idx) GROUP BY user_idx), {random_pick_sql(K, 42)}"))
def random_recs(spark, path):
    return _run(RandomRecommender(), spark, path)


@query("rec2_popularity", V.with_views(OUT, "log", "users", "items", extra=shared_sql(POPULARITY)))
def popularity_recs(spark, path):
    return _run(PopularityRecommender(), spark, path)


@query("rec2_popularity_unfiltered", V.with_views(
    "SELECT user_idx, item_idx, round(relevance, 6) AS relevance, rank FROM users, (SELECT *, row_number() OVER"
    " (ORDER BY relevance DESC, item_idx) AS rank FROM scores) WHERE rank <= 5", "log", "users", "items",
    extra=shared_sql(POPULARITY)))
def popularity_with_seen(spark, path):
    log, users, items = _tables(spark, path)
    return _out(PopularityRecommender().fit(log).predict(log, K, users, items, filter_seen_items=False))


@query("rec2_popularity_unfitted", V.with_views(
    "SELECT user_idx, item_idx, 0.5::double AS relevance, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_idx"
    " ORDER BY item_idx) AS rank FROM unseen) WHERE rank <= 5", "log", "users", "items", extra=UNSEEN))
def popularity_unfitted(spark, path):
    log, users, items = _tables(spark, path)
    return _out(PopularityRecommender().predict(log, K, users, items))


def content_sql(k=K, threshold="0"):
    dims = ", ".join(f"CASE WHEN sum(relevance) > 0 THEN sum(relevance * cast(vec[{i + 1}] as double)) / sum(relevance)"
                     " ELSE 0.0 END" for i in range(64))
    return ("prof AS (SELECT user_idx, p, sqrt(list_dot_product(p, p)) AS np FROM (SELECT user_idx,"
            f" [{dims}] AS p FROM log JOIN item_vec USING (item_idx) GROUP BY user_idx)),"
            " iv AS (SELECT item_idx, v, sqrt(list_dot_product(v, v)) AS nv FROM (SELECT item_idx, cast(vec as double[]) AS v"
            " FROM item_vec)), content AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx"
            " ORDER BY relevance DESC, item_idx) AS rank FROM (SELECT user_idx, item_idx,"
            " round(coalesce(list_dot_product(p, v) / nullif(np * nv, 0), 0), 9) AS relevance FROM unseen JOIN prof"
            f" USING (user_idx) JOIN iv USING (item_idx)) WHERE relevance >= {threshold}) WHERE rank <= {k})")


CONTENT_OUT = "SELECT user_idx, item_idx, round(relevance, 6) AS relevance, rank FROM content"


@query("rec3_content", V.with_views(CONTENT_OUT, "log", "users", "items", "item_vec", extra=f"{UNSEEN}, {content_sql()}"))
def content_recs(spark, path):
    return _run(ContentRecommender(), spark, path, item_features=V.item_vectors(spark, path))


@query("flt1_similarity_threshold", V.with_views(
    CONTENT_OUT, "log", "users", "items", "item_vec", extra=f"{UNSEEN}, {content_sql(threshold='0.3')}"))
def similar_enough(spark, path):
    return _run(ContentRecommender(similarity_threshold=0.3), spark, path, item_features=V.item_vectors(spark, path))


@query("rec4_hybrid", V.with_views(
    "SELECT user_idx, item_idx, round(relevance, 6) AS relevance, rank FROM (SELECT *, row_number() OVER (PARTITION BY"
    " user_idx ORDER BY relevance DESC, item_idx) AS rank FROM (SELECT user_idx, item_idx, round(sum(part), 9) AS relevance"
    " FROM (SELECT user_idx, item_idx, relevance * cast(0.75 as double) AS part FROM content UNION ALL"
    " SELECT user_idx, item_idx, relevance * cast(0.25 as double) FROM best) GROUP BY user_idx, item_idx)) WHERE rank <= 5",
    "log", "users", "items", "item_vec", extra=f"{shared_sql(POPULARITY, k=10)}, {content_sql(k=10)}"))
def hybrid_recs(spark, path):
    model = HybridRecommender([ContentRecommender(), PopularityRecommender()], [3, 1])
    return _run(model, spark, path, item_features=V.item_vectors(spark, path))


@query("rec5_bandit", V.with_views(OUT, "log", "users", "items", extra=shared_sql(UCB, "DESC")))
def bandit_recs(spark, path):
    return _run(BanditRecommender(), spark, path)


@query("rec7_bandit_pairs", V.with_views(
    "SELECT user_idx, item_idx, round(relevance, 6) AS relevance FROM seen JOIN scores USING (item_idx)",
    "log", "users", "items", extra=shared_sql(UCB)))
def bandit_pairs(spark, path):
    log, users, items = _tables(spark, path)
    pairs = log.select("user_idx", "item_idx").distinct()
    return BanditRecommender().fit(log).score_pairs(pairs, items).select(
        "user_idx", "item_idx", F.round("relevance", 6).alias("relevance"))


@query("rec10_price_bandit", V.with_views(OUT, "log", "users", "items", extra=shared_sql(PRICED, "DESC")))
def price_bandit_recs(spark, path):
    return _run(PriceBanditRecommender(), spark, path)


def _reloaded(model, spark, path):
    """Lists of a model that was fitted, saved, and loaded from its newest committed version."""
    log, users, items = _tables(spark, path)
    folder = scratch_path(spark, "model")
    save_model(type(model)().fit(log.limit(0), users, items), spark, folder)
    save_model(model.fit(log, users, items), spark, folder)
    return _out(load_model(spark, folder).predict(log, K, users, items))


@query("snk4_reloaded_popularity", V.with_views(OUT, "log", "users", "items", extra=shared_sql(POPULARITY)))
def reloaded_popularity(spark, path):
    return _reloaded(PopularityRecommender(), spark, path)


@query("snk4_reloaded_price_bandit", V.with_views(OUT, "log", "users", "items", extra=shared_sql(PRICED, "DESC")))
def reloaded_price_bandit(spark, path):
    return _reloaded(PriceBanditRecommender(), spark, path)


def _classifier(model, spark, path):
    log, users, items = _tables(spark, path)
    model.fit(log, users, items)
    return _out(model.predict(log, K, users, items, user_features=users))


@query("rec8_kernel_classifier")
def kernel_recs(spark, path):
    return _classifier(KernelRecommender(), spark, path)


@query("rec9_logistic_regression")
def logistic_recs(spark, path):
    return _classifier(LinearRecommender(), spark, path)


@query("doc3_forest")
def forest_recs(spark, path):
    return _classifier(ForestRecommender(), spark, path)


@query("doc14_cold_start_fill", V.with_views(
    "SELECT user_idx, item_idx, round(coalesce(r.relevance, c.relevance), 6) AS relevance FROM content c LEFT JOIN"
    " (SELECT item_idx, (sum(relevance) + 1.0) / (count(*) + 2.0) AS relevance FROM log"
    " GROUP BY item_idx) r USING (item_idx)", "log", "users", "items", "item_vec", extra=f"{UNSEEN}, {content_sql()}"))
def cold_fill(spark, path):
    """Content lists whose score is the item's popularity where it has one."""
    from ..operators.joins import salted_join
    from ..recommenders.shared_score import item_counts, smoothed_popularity
    log, users, items = _tables(spark, path)
    vectors = V.item_vectors(spark, path)
    recs = ContentRecommender().fit(log, users, vectors).predict(log, K, users, items, item_features=vectors)
    early = item_counts(log).select(
        "item_idx", smoothed_popularity(F.col("pos"), F.col("total")).alias("early"))
    return salted_join(recs, early, ["item_idx"], ["user_idx"], "left").select(
        "user_idx", "item_idx", F.round(F.coalesce("early", "relevance"), 6).alias("relevance"))
