"""Projections, filters, joins, windows, set operations."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.scoring import binarise
from ..operators.joins import salted_join
from ..operators.lists import LISTS_SQL, enrich, purchase_lists, with_rank
from ..operators.ordering import rank_in_key, top_k, with_position
from ..recommenders.content import as_vector
from ..recommenders.shared_score import item_counts, smoothed_popularity, ucb_score
from ..sources import views as V
from .registry import query

POP_SQL = ("pop AS (SELECT item_idx, (sum(relevance) + cast(1 as double)) / (count(relevance) + cast(2 as double))"
           " AS relevance FROM log GROUP BY item_idx)")


@query("prj1_log_projection", V.with_views(
    "SELECT user_idx, item_idx, order_id, line, cast(trunc(amount) as bigint) AS relevance FROM log", "log"))
def log_projection(spark, path):
    return V.log(spark, path).select(
        "user_idx", "item_idx", "order_id", "line", F.col("amount").cast("bigint").alias("relevance"))


@query("prj2_binarise", V.with_views(
    "SELECT user_idx, item_idx, order_id, line, CASE WHEN relevance > 0 THEN 1 ELSE 0 END AS relevance FROM log", "log"))
def binarised(spark, path):
    return V.log(spark, path).select("user_idx", "item_idx", "order_id", "line",
                                     binarise("relevance").alias("relevance"))


@query("prj3_prefix_select", "SELECT c_custkey, c_acctbal, c_nationkey FROM customer")
def prefix_select(spark, path):
    named = V.users(spark, path).toDF("c_custkey", "segment", "user_attr_0", "user_attr_1")
    attrs = [c for c in named.columns if c.startswith("user_attr_")]
    return named.select("c_custkey", *attrs).toDF("c_custkey", "c_acctbal", "c_nationkey")


@query("prj5_constant", "SELECT p_partkey AS item_idx, cast(0.25 as double) AS response FROM part")
def constant(spark, path):
    return V.items(spark, path).select("item_idx", F.lit(0.25).alias("response"))


@query("prj6_vector_element", "SELECT c_custkey AS user_idx, c_acctbal AS element FROM customer")
def vector_element(spark, path):
    # through the ML vector type and back, as a pipeline stage would see it
    vectors = VectorAssembler(inputCols=["acctbal", "nation"], outputCol="v").transform(V.users(spark, path))
    return vectors.select("user_idx", F.get(vector_to_array("v"), F.lit(0)).alias("element"))


@query("prj7_default_fill", V.with_views(
    "SELECT item_idx, round(coalesce(pop.relevance, 0.5), 9) AS relevance FROM items LEFT JOIN"
    " (SELECT item_idx, (sum(relevance) + 1.0) / (count(*) + 2.0) AS relevance FROM log"
    " GROUP BY item_idx) pop USING (item_idx)", "items", "log"))
def default_fill(spark, path):
    counts = item_counts(V.log(spark, path))
    scores = counts.select("item_idx", smoothed_popularity(F.col("pos"), F.col("total")).alias("relevance"))
    return (V.items(spark, path).select("item_idx").join(scores, "item_idx", "left")
            .select("item_idx", F.round(F.coalesce("relevance", F.lit(0.5)), 9).alias("relevance")))


@query("flt2_segment_filter", V.with_views("SELECT user_idx, acctbal FROM users WHERE segment = 'BUILDING'", "users"))
def segment_filter(spark, path):
    return V.users(spark, path).filter(F.col("segment") == "BUILDING").select("user_idx", "acctbal")


@query("flt3_binary_check", V.with_views(
    "SELECT cast(count(*) as bigint) AS rows, cast(count(CASE WHEN relevance NOT IN (0, 1) THEN 1 END) as bigint)"
    " AS invalid FROM log", "log"))
def binary_check(spark, path):
    return V.log(spark, path).agg(F.count(F.lit(1)).alias("rows"),
                                  F.count_if(~F.col("relevance").isin(0, 1)).alias("invalid"))


@query("flt4_top_k_filter", V.with_views(
    "SELECT user_idx, item_idx, rank FROM lists WHERE rank <= 5", "log", extra=LISTS_SQL))
def top_k_filter(spark, path):
    return purchase_lists(V.log(spark, path), 5).select("user_idx", "item_idx", "rank")


@query("flt5_min_history", V.with_views(
    "SELECT user_idx, item_idx, order_id, line FROM log WHERE user_idx IN"
    " (SELECT user_idx FROM log GROUP BY user_idx HAVING count(*) >= 40)", "log"))
def min_history(spark, path):
    log = V.log(spark, path)
    regular = log.groupBy("user_idx").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 40)
    return salted_join(log, regular.select("user_idx"), ["user_idx"], ["item_idx"], "left_semi").select(
        "user_idx", "item_idx", "order_id", "line")


@query("jn1_catalogue_positions", V.with_views(
    "SELECT item_idx, relevance, row_number() OVER (ORDER BY relevance DESC, item_idx) - 1 AS pos FROM"
    " (SELECT item_idx, round(coalesce(pop.relevance, 0.5), 9) AS relevance FROM items LEFT JOIN pop USING (item_idx))",
    "items", "log", extra=POP_SQL))
def catalogue_positions(spark, path):
    """The item order that stands in for a users x items candidate table."""
    counts = item_counts(V.log(spark, path))
    scores = V.items(spark, path).select("item_idx").join(counts, "item_idx", "left").select(
        "item_idx", F.round(F.coalesce(smoothed_popularity(F.col("pos"), F.col("total")), F.lit(0.5)), 9).alias("relevance"))
    return with_position(scores, [F.desc("relevance"), F.asc("item_idx")])


@query("jn2_new_pairs", V.with_views(
    "SELECT DISTINCT user_idx, item_idx FROM log l WHERE iter >= '2000' AND NOT EXISTS (SELECT 1 FROM log o"
    " WHERE o.user_idx = l.user_idx AND o.item_idx = l.item_idx AND o.iter < '2000')", "log"))
def new_pairs(spark, path):
    log = V.log(spark, path)
    before = log.filter(F.col("iter") < "2000").select("user_idx", "item_idx").distinct()
    return (log.filter(F.col("iter") >= "2000").select("user_idx", "item_idx").distinct()
            .join(before, ["user_idx", "item_idx"], "left_anti"))


@query("jn3_log_of_users", V.with_views(
    "SELECT user_idx, item_idx, order_id, line FROM log WHERE user_idx IN"
    " (SELECT user_idx FROM users WHERE segment = 'MACHINERY')", "log", "users"))
def log_of_users(spark, path):
    chosen = V.users(spark, path).filter(F.col("segment") == "MACHINERY").select("user_idx")
    return salted_join(V.log(spark, path), chosen, ["user_idx"], ["item_idx"], "left_semi").select(
        "user_idx", "item_idx", "order_id", "line")


@query("jn4_enrich", V.with_views(
    "SELECT user_idx, item_idx, rank, segment, category, price FROM lists LEFT JOIN users USING (user_idx)"
    " LEFT JOIN items USING (item_idx)", "log", "users", "items", extra=LISTS_SQL))
def enriched(spark, path):
    return enrich(purchase_lists(V.log(spark, path)), V.users(spark, path), V.items(spark, path)).select(
        "user_idx", "item_idx", "rank", "segment", "category", "price")


@query("jn5_log_features", V.with_views(
    "SELECT user_idx, item_idx, order_id, line, relevance, acctbal, nation, category, price FROM log"
    " JOIN users USING (user_idx) JOIN items USING (item_idx)", "log", "users", "items"))
def log_features(spark, path):
    log = V.log(spark, path).select("user_idx", "item_idx", "order_id", "line", "relevance")
    with_users = salted_join(log, V.users(spark, path).select("user_idx", "acctbal", "nation"), ["user_idx"], ["order_id"])
    return salted_join(with_users, V.items(spark, path).select("item_idx", "category", "price"), ["item_idx"], ["order_id"])


@query("jn6_all_items_stats", V.with_views(
    "SELECT item_idx, category, cast(coalesce(sum(relevance), 0) as bigint) AS pos, cast(count(relevance) as bigint) AS total"
    " FROM items LEFT JOIN (SELECT * FROM log) USING (item_idx) GROUP BY item_idx, category",
    "items", "log"))
def all_items_stats(spark, path):
    counts = item_counts(V.log(spark, path))
    return (counts.join(V.items(spark, path).select("item_idx", "category"), "item_idx", "right")
            .fillna(0, ["pos", "total"]))


@query("jn7_pair_scores", V.with_views(
    "SELECT user_idx, item_idx, round(relevance, 9) AS relevance FROM (SELECT DISTINCT user_idx, item_idx FROM log)"
    " LEFT JOIN pop USING (item_idx)", "log", extra=POP_SQL))
def pair_scores(spark, path):
    log = V.log(spark, path)
    scores = item_counts(log).select("item_idx", smoothed_popularity(F.col("pos"), F.col("total")).alias("relevance"))
    return salted_join(log.select("user_idx", "item_idx").distinct(), scores, ["item_idx"], ["user_idx"], "left").select(
        "user_idx", "item_idx", F.round("relevance", 9).alias("relevance"))


@query("jn8_all_users_log", V.with_views(
    "SELECT user_idx, cast(count(item_idx) as bigint) AS events FROM users LEFT JOIN"
    " (SELECT * FROM log) USING (user_idx) GROUP BY user_idx", "users", "log"))
def all_users_log(spark, path):
    # counted before the outer join: a heavy user arrives as one row
    counts = V.log(spark, path).groupBy("user_idx").agg(
        F.count("item_idx").alias("events"))
    return counts.join(V.users(spark, path).select("user_idx"), "user_idx", "right").fillna(0, ["events"])


@query("jn9_segment_category_counts", V.with_views(
    "SELECT segment, category, cast(count(*) as bigint) AS n FROM log JOIN users USING (user_idx)"
    " JOIN items USING (item_idx) GROUP BY segment, category", "log", "users", "items"))
def segment_category_counts(spark, path):
    return segment_category_log(spark, path).groupBy("segment", "category").agg(F.sum("n").alias("n"))


def segment_category_log(spark, path):
    """Pairs with their segment, category and number of events."""
    pairs = V.log(spark, path).groupBy("user_idx", "item_idx").agg(F.count(F.lit(1)).alias("n"))
    with_users = salted_join(pairs, V.users(spark, path).select("user_idx", "segment"), ["user_idx"], ["item_idx"])
    return salted_join(with_users, V.items(spark, path).select("item_idx", "category"), ["item_idx"], ["user_idx"])


@query("win1_user_top_k", V.with_views(
    "SELECT user_idx, item_idx, relevance, rank FROM lists WHERE rank <= 10", "log", extra=LISTS_SQL))
def user_top_k(spark, path):
    return purchase_lists(V.log(spark, path), 10).select("user_idx", "item_idx", "relevance", "rank")


@query("win2_item_rank", V.with_views(
    "SELECT item_idx, rank FROM (SELECT item_idx, row_number() OVER (ORDER BY s DESC, item_idx DESC) AS rank FROM"
    " (SELECT item_idx, round(sum(relevance) / cast(count(*) as double)"
    " + sqrt(ln(cast(2 as double) * (SELECT count(*) FROM log)) / count(*)), 9) AS s FROM log GROUP BY item_idx))", "log"))
def item_rank(spark, path):
    log = V.log(spark, path)
    rows = log.agg(F.count(F.lit(1)).alias("n"))
    scored = item_counts(log).crossJoin(F.broadcast(rows)).select(  # a single row
        "item_idx", F.round(ucb_score(F.col("pos"), F.col("total"), F.col("n")), 9).alias("s"))
    return with_position(scored, [F.desc("s"), F.desc("item_idx")]).select(
        "item_idx", (F.col("pos") + 1).alias("rank"))


@query("win3_rank_if_missing", V.with_views(
    "SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY r DESC, item_idx) AS rank FROM"
    " (SELECT user_idx, item_idx, round(sum(amount), 4) AS r FROM log GROUP BY user_idx, item_idx)", "log"))
def rank_if_missing(spark, path):
    spent = V.log(spark, path).groupBy("user_idx", "item_idx").agg(F.round(F.sum("amount"), 4).alias("relevance"))
    return with_rank(spent).select("user_idx", "item_idx", "rank")


@query("win4_head_per_segment", V.with_views(
    "SELECT segment, user_idx, acctbal FROM (SELECT *, row_number() OVER (PARTITION BY segment"
    " ORDER BY acctbal DESC, user_idx) AS r FROM users) WHERE r <= 7", "users"))
def head_per_segment(spark, path):
    return top_k(V.users(spark, path), ["segment"], [F.desc("acctbal"), F.asc("user_idx")], 7).select(
        "segment", "user_idx", "acctbal")


@query("win5_ideal_order", V.with_views(
    "SELECT user_idx, item_idx, row_number() OVER (PARTITION BY user_idx ORDER BY response DESC, rank) AS ideal"
    " FROM lists", "log", extra=LISTS_SQL))
def ideal_order(spark, path):
    lists = purchase_lists(V.log(spark, path)).select("user_idx", "item_idx", "response", "rank")
    return rank_in_key(lists, ["user_idx"], [F.desc("response"), F.asc("rank")], "ideal").select(
        "user_idx", "item_idx", "ideal")


@query("srt1_result_order", V.with_views(
    "SELECT iter, round(sum(relevance * amount), 4) AS revenue FROM log GROUP BY iter ORDER BY revenue DESC, iter", "log"))
def result_order(spark, path):
    return (V.log(spark, path).groupBy("iter").agg(
        F.round(F.sum(F.col("relevance") * F.col("amount")), 4).alias("revenue")).orderBy(F.desc("revenue"), "iter"))


@query("srt2_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_n(spark, path):
    return V.table(spark, path, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("set1_union_by_name", V.with_views(
    "SELECT user_idx, item_idx, relevance, 0 AS model FROM lists UNION ALL SELECT user_idx, item_idx,"
    " revenue AS relevance, 1 AS model FROM lists", "log", extra=LISTS_SQL))
def union_by_name(spark, path):
    lists = purchase_lists(V.log(spark, path))
    a = lists.select("user_idx", "item_idx", "relevance", F.lit(0).alias("model"))
    b = lists.select(F.lit(1).alias("model"), F.col("revenue").alias("relevance"), "item_idx", "user_idx")
    return a.unionByName(b)


@query("set2_distinct_pairs", V.with_views("SELECT DISTINCT user_idx, item_idx FROM log", "log"))
def distinct_pairs(spark, path):
    return V.log(spark, path).select("user_idx", "item_idx").distinct()


@query("fe3_vector_assembly", "SELECT p_partkey AS item_idx, p_retailprice AS a, cast(p_size as double) AS b FROM part")
def vector_assembly(spark, path):
    named = V.items(spark, path).select("item_idx", F.col("price").alias("item_attr_0"), F.col("size").alias("item_attr_1"))
    vec = as_vector(named, "item_attr_")
    return vec.select("item_idx", F.get("vec", F.lit(0)).alias("a"), F.get("vec", F.lit(1)).alias("b"))
