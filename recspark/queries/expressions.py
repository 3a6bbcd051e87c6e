"""Scalar, array and response expressions."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.arrays import angular, cosine, dot_label, norm, unit
from ..functions.draws import normal, normal_sql, uniform, uniform_sql
from ..functions.scoring import (bernoulli, expected_revenue, geometric_discount,
                                 log_discount, noise, parametric, utility)
from ..functions.stages import BernoulliStage, NoiseStage, RevenueStage
from ..operators.lists import LISTS_SQL, enrich, purchase_lists
from ..operators.ordering import top_k
from ..sources import views as V
from .registry import query

LINES = "SELECT l_orderkey, l_linenumber, {} FROM lineitem"
_P = "(l_discount * cast(5 as double))"


def _lines(spark, path, *columns):
    return V.table(spark, path, "lineitem").select("l_orderkey", "l_linenumber", *columns)


@query("rng_uniform", LINES.format(f"{uniform_sql('rng', 'l_orderkey', 'l_linenumber')} AS u"))
def uniform_draw(spark, path):
    return _lines(spark, path, uniform("rng", "l_orderkey", "l_linenumber").alias("u"))


@query("rng_normal", LINES.format(f"round({normal_sql('rng', 'l_orderkey', 'l_linenumber')}, 9) AS z"))
def normal_draw(spark, path):
    return _lines(spark, path, F.round(normal("rng", "l_orderkey", "l_linenumber"), 9).alias("z"))


@query("fn1_bernoulli", LINES.format(
    f"CASE WHEN {uniform_sql('fn1', 'l_orderkey', 'l_linenumber')} <= {_P} THEN 1 ELSE 0 END AS response"))
def bernoulli_response(spark, path):
    p = F.col("l_discount") * 5.0
    return _lines(spark, path, bernoulli(p, "fn1", "l_orderkey", "l_linenumber").alias("response"))


@query("fn2_noise", LINES.format(
    f"round(greatest(0.0, {normal_sql('fn2', 'l_orderkey', 'l_linenumber', mean='0.1', std=0.05)}), 9) AS noisy"))
def gaussian_noise(spark, path):
    return _lines(spark, path, F.round(noise(0.1, 0.05, "fn2", "l_orderkey", "l_linenumber"), 9).alias("noisy"))


@query("fn3_parametric", LINES.format(
    "round(cast(0.5 as double) * l_quantity + cast(0.25 as double) * l_extendedprice - cast(2 as double) * l_tax, 6) AS response"))
def parametric_response(spark, path):
    weights = {"l_quantity": 0.5, "l_extendedprice": 0.25, "l_tax": -2.0}
    return V.table(spark, path, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(parametric(weights), 6).alias("response"))


PAIR_SQL = ("p AS (SELECT DISTINCT user_idx, item_idx FROM log), v AS (SELECT user_idx, item_idx,"
            " cast(u.vec as double[]) AS a, cast(i.vec as double[]) AS b FROM p JOIN user_vec u USING (user_idx)"
            " JOIN item_vec i USING (item_idx))")


def _pair_vectors(spark, path):
    """Interacted pairs with the user's and the item's vector and their lengths, found once per vector.

    Pairs are dealt with the vectors' numbers; the vectors come last.
    """
    pairs = V.log(spark, path).select("user_idx", "item_idx").distinct()
    u = V.user_slots(spark, path).withColumnRenamed("__vec", "__u")
    i = V.item_slots(spark, path).withColumnRenamed("__vec", "__i")
    vectors = V.vectors(spark, path).select("__vec", F.col("vec").cast("array<double>").alias("vec"), norm("vec").alias("length"))
    return (pairs.join(u, "user_idx").join(i, "item_idx")
            .join(vectors.toDF("__u", "a", "length_a"), "__u").join(vectors.toDF("__i", "b", "length_b"), "__i").drop("__u", "__i"))


@query("fn4_angular_similarity", V.with_views(
    "SELECT user_idx, item_idx, round(1 - acos(greatest(-1.0, least(1.0, list_dot_product(a, b) /"
    f" (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))))) / {math.pi!r}, 6) AS similarity FROM v",
    "log", "user_vec", "item_vec", extra=PAIR_SQL))
def angular_similarity(spark, path):
    return _pair_vectors(spark, path).select("user_idx", "item_idx", F.round(angular("a", "b"), 6).alias("similarity"))


@query("fn5_cosine_similarity", V.with_views(
    "SELECT user_idx, item_idx, round(coalesce(list_dot_product(a, b) / nullif(sqrt(list_dot_product(a, a))"
    " * sqrt(list_dot_product(b, b)), 0), 0), 6) AS similarity FROM v", "log", "user_vec", "item_vec", extra=PAIR_SQL))
def cosine_similarity(spark, path):
    return _pair_vectors(spark, path).select("user_idx", "item_idx", F.round(cosine("a", "b", "length_a", "length_b"), 6).alias("similarity"))


@query("fn6_revenue", V.with_views(
    "SELECT user_idx, item_idx, response * price AS revenue FROM lists JOIN items USING (item_idx)", "log", "items",
    extra=LISTS_SQL))
def revenue(spark, path):
    lists = purchase_lists(V.log(spark, path)).select("user_idx", "item_idx", "response")
    return enrich(lists, items=V.items(spark, path).select("item_idx", "price")).select(
        "user_idx", "item_idx", (F.col("response") * F.col("price")).alias("revenue"))


@query("fn7_log_discount", LINES.format("round(1 / log2(l_linenumber + cast(1 as double)), 9) AS discount"))
def discount(spark, path):
    return _lines(spark, path, F.round(log_discount("l_linenumber"), 9).alias("discount"))


@query("fn8_dot_label", V.with_views(
    "SELECT user_idx, item_idx, CASE WHEN list_dot_product(a, b) > 0 THEN 1 ELSE 0 END AS label FROM v",
    "log", "user_vec", "item_vec", extra=PAIR_SQL))
def label_by_dot(spark, path):
    return _pair_vectors(spark, path).select("user_idx", "item_idx", dot_label("a", "b").alias("label"))


@query("fn9_utility",
       "SELECT l_orderkey, l_linenumber, round((sin(p) + 1) * exp(p - 1) * ln(1 + x) * cos(x / 100)"
       f" * (1 + tan(p * {math.pi / 4!r})), 6) AS utility FROM (SELECT *, {_P} AS p, l_extendedprice / 100 AS x FROM lineitem)")
def price_utility(spark, path):
    return _lines(spark, path, F.round(utility(F.col("l_discount") * 5.0, F.col("l_extendedprice") / 100.0), 6).alias("utility"))


@query("fn10_expected_revenue", LINES.format(f"round({_P} * l_extendedprice, 6) AS expected"))
def expected(spark, path):
    return _lines(spark, path, F.round(expected_revenue(F.col("l_discount") * 5.0, "l_extendedprice"), 6).alias("expected"))


@query("fn11_array_ops",
       "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: cast(x as double) * 2)), 6) AS doubled,"
       " cast(len(embedding) as int) AS width, round(list_sum(list_transform(embedding,"
       " lambda x: cast(x as double) * cast(x as double))), 6) AS energy FROM embeddings")
def array_ops(spark, path):
    v = F.col("embedding")
    doubled = F.aggregate(F.transform(v, lambda x: x.cast("double") * 2.0), F.lit(0.0), lambda a, x: a + x)
    squares = F.aggregate(F.arrays_zip(v.alias("x"), v.alias("y")), F.lit(0.0),
                          lambda a, e: a + e.getField("x").cast("double") * e.getField("y").cast("double"))
    return V.table(spark, path, "embeddings").select(
        "vec_id", F.round(doubled, 6).alias("doubled"), F.size(v).alias("width"), F.round(squares, 6).alias("energy"))


@query("fn12_vector_array_roundtrip", "SELECT vec_id, cast(embedding[1] as double) AS first, cast(embedding[64] as double) AS last FROM embeddings")
def roundtrip(spark, path):
    vec = array_to_vector(F.transform("embedding", lambda x: x.cast("double")))
    back = V.table(spark, path, "embeddings").select("vec_id", vector_to_array(vec).alias("v"))
    return back.select("vec_id", F.get("v", F.lit(0)).alias("first"), F.element_at("v", -1).alias("last"))


@query("fn13_geometric_discount", LINES.format("round(pow(cast(0.85 as double), l_linenumber - 1), 9) AS discount"))
def geometric(spark, path):
    return _lines(spark, path, F.round(geometric_discount("l_linenumber"), 9).alias("discount"))


@query("fn14_unit_vectors",
       "SELECT vec_id, round(embedding[1] / n, 6) AS first, round(embedding[32] / n, 6) AS middle FROM (SELECT *,"
       " sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))) AS n FROM embeddings)")
def unit_vectors(spark, path):
    v = V.table(spark, path, "embeddings").select("vec_id", unit("embedding").alias("v"))
    return v.select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(31)), 6).alias("middle"))


@query("fn15_position_weighted_score", V.with_views(
    "SELECT user_idx, item_idx, round(relevance / log2(rank + 1), 6) AS score FROM lists", "log", extra=LISTS_SQL))
def position_weighted(spark, path):
    return purchase_lists(V.log(spark, path)).select(
        "user_idx", "item_idx", F.round(F.col("relevance") * log_discount("rank"), 6).alias("score"))


@query("fe4_response_pipeline", V.with_views(
    "SELECT user_idx, item_idx, round(probability, 9) AS probability, response, response * price AS revenue FROM"
    f" (SELECT *, CASE WHEN {uniform_sql('fe4.buy', 'user_idx', 'item_idx')} <= probability THEN 1 ELSE 0 END AS response FROM"
    f" (SELECT *, greatest(0.0, {normal_sql('fe4.noise', 'user_idx', 'item_idx', mean='0.1', std=0.05)}) AS probability"
    " FROM (SELECT user_idx, item_idx FROM lists) JOIN items USING (item_idx)))", "items", "log", extra=LISTS_SQL))
def response_pipeline(spark, path):
    lists = purchase_lists(V.log(spark, path)).select("user_idx", "item_idx")
    priced = enrich(lists, items=V.items(spark, path).select("item_idx", "price"))
    keys = ["user_idx", "item_idx"]
    pipeline = PipelineModel([NoiseStage(outputCol="probability", salt="fe4.noise", keys=keys, mu=0.1, sigma=0.05),
                              BernoulliStage(inputCol="probability", outputCol="response", salt="fe4.buy", keys=keys),
                              RevenueStage(inputCol="response", outputCol="revenue")])
    return pipeline.transform(priced).select(*keys, F.round("probability", 9).alias("probability"), "response", "revenue")


@query("prj2_training_log", V.with_views(
    "SELECT user_idx, item_idx, CASE WHEN response > 0 THEN 1 ELSE 0 END AS relevance FROM lists", "log", extra=LISTS_SQL))
def training(spark, path):
    from ..operators.lists import training_log
    return training_log(purchase_lists(V.log(spark, path))).select("user_idx", "item_idx", "relevance")


@query("doc4_expected_revenue_ranking", V.with_views(
    "SELECT user_idx, item_idx, round(value, 6) AS value, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_idx"
    " ORDER BY round(value, 6) DESC, item_idx) AS rank FROM (SELECT user_idx, item_idx, price * (pos + 1.0) / (n + 2.0) AS value"
    " FROM (SELECT user_idx, item_idx, sum(relevance) AS pos, count(*) AS n FROM log GROUP BY user_idx, item_idx)"
    " JOIN items USING (item_idx))) WHERE rank <= 5", "log", "items"))
def revenue_ranking(spark, path):
    pairs = V.log(spark, path).groupBy("user_idx", "item_idx").agg(
        ((F.sum("relevance") + 1.0) / (F.count(F.lit(1)) + 2.0)).alias("p"))
    valued = enrich(pairs, items=V.items(spark, path).select("item_idx", "price")).select(
        "user_idx", "item_idx", F.round(F.col("price") * F.col("p"), 6).alias("value"))
    best = top_k(valued, ["user_idx"], [F.desc("value"), F.asc("item_idx")], 5)
    return best.withColumn("rank", F.col("rank").cast("bigint"))

