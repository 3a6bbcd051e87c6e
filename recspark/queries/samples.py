"""Samples, quotas, selectors and synthetic tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.draws import PAIR_PRIME, normal_sql, residue_sql, uniform_sql
from ..operators.sampling import (bernoulli_rows, candidates, composite_rows, composite_table, exact_rows,
                                  labelled_ids, negative_pairs, own_items, quota_sample, quotas, shared_items, shares)
from ..operators.weighted import draw_sizes, weighted_draw
from ..plans.synth import aligned_feedback, copula_table, like_strata, strata_moments
from ..recommenders.shared_score import item_counts, ucb_score, ucb_unseen
from ..sources import views as V
from .registry import query


@query("smp1_bernoulli_sample", V.with_views(
    f"SELECT user_idx, segment FROM users WHERE {uniform_sql('bernoulli.7', 'user_idx')} < cast(0.1 as double)", "users"))
def bernoulli_sample(spark, path):
    return bernoulli_rows(V.users(spark, path), 0.1, 7, ["user_idx"]).select("user_idx", "segment")


@query("smp2_exact_sample",
       f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {uniform_sql('exact.7', 'o_orderkey')}, o_orderkey"
       " LIMIT (SELECT cast(count(*) * cast(0.9 as double) as bigint) FROM orders)")
def exact_sample(spark, path):
    orders = V.table(spark, path, "orders").select("o_orderkey", "o_custkey")
    return exact_rows(orders, round(orders.count() * 0.9), 7, ["o_orderkey"])


COMPOSITE = {"BUILDING": 0.5, "MACHINERY": 0.3, "HOUSEHOLD": 0.2}


@query("smp3_composite_sample", V.with_views(
    "SELECT user_idx, segment FROM users JOIN s USING (segment) WHERE "
    f"{uniform_sql('composite.7', 'user_idx')} < floor(total * cast(0.4 as double) * w) / n", "users",
    extra="w AS (SELECT 'BUILDING' AS segment, cast(0.5 as double) AS w UNION ALL SELECT 'MACHINERY', 0.3 UNION ALL"
          " SELECT 'HOUSEHOLD', 0.2), s AS (SELECT segment, any_value(w) AS w, cast(count(*) as double) AS n,"
          " sum(count(*)) OVER () AS total FROM users JOIN w USING (segment) GROUP BY segment)"))
def composite_sample(spark, path):
    return composite_rows(V.users(spark, path), "segment", 0.4, COMPOSITE, 7, ["user_idx"]).select("user_idx", "segment")


QUOTA_SQL = ("w AS (SELECT segment, count(*) / cast((SELECT count(*) FROM users) as double) AS weight FROM users GROUP BY segment),"
             " t AS (SELECT count(*) // 3 AS total FROM users), q AS (SELECT segment, floor(weight * total + 1e-9) +"
             " CASE WHEN segment = (SELECT max(segment) FROM w) THEN total - (SELECT sum(floor(weight * total + 1e-9)) FROM w, t)"
             " ELSE 0 END AS quota FROM w, t)")


@query("smp4_quotas", V.with_views("SELECT segment, cast(quota as bigint) AS quota FROM q", "users", extra=QUOTA_SQL))
def quota_table(spark, path):
    users = V.users(spark, path)
    return quotas(shares(users, "segment"), "segment", users.count() // 3).select("segment", "quota")


@query("smp4_quota_sample", V.with_views(
    "SELECT user_idx, segment FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY "
    f"{uniform_sql('quota.7', 'user_idx')}, user_idx) AS r FROM users) JOIN q USING (segment) WHERE r <= quota",
    "users", extra=QUOTA_SQL))
def sample_by_quota(spark, path):
    users = V.users(spark, path).select("user_idx", "segment")
    quota = quotas(shares(users, "segment"), "segment", users.count() // 3)
    return quota_sample(users, "segment", quota, 7, ["user_idx"])


@query("smp5_default_weights", V.with_views(
    "SELECT segment, cast(count(*) as bigint) AS rows, round(count(*) / cast((SELECT count(*) FROM users) as double), 9)"
    " AS weight FROM users GROUP BY segment", "users"))
def default_weights(spark, path):
    return shares(V.users(spark, path), "segment").withColumn("weight", F.round("weight", 9))


@query("smp6_shared_items", V.with_views(
    "SELECT user_idx, item_idx FROM users, (SELECT item_idx FROM items ORDER BY "
    f"{uniform_sql('shared.7', 'item_idx')}, item_idx LIMIT 5)", "users", "items"))
def random_shared(spark, path):
    return shared_items(V.users(spark, path), V.items(spark, path), 5, 7)


def random_pick_sql(k, seed, free="free"):
    """Ranks of a random k-subset of 0..free-1, drawn one after the other, as CTE columns."""
    cols, levels = [], "base0 AS (SELECT *, cast([] as bigint[]) AS picked FROM base)"
    for j in range(k):
        draw = uniform_sql(f"random.{seed}.item.{j}", "user_idx")
        pick = f"cast(floor({draw} * ({free} - {j})) as bigint)"
        step = (f"list_reduce(list_sort(picked), lambda a, t: CASE WHEN a >= t THEN a + 1 ELSE a END, {pick})")
        levels += (f", base{j + 1} AS (SELECT * EXCLUDE (picked), CASE WHEN {free} > {j} THEN"
                   f" list_append(picked, {step}) ELSE picked END AS picked FROM base{j})")
        cols.append(f"pow({uniform_sql(f'random.{seed}.score.{j}', 'user_idx')}, 1.0 / greatest({free} - {j}, 1))")
    scores = ", ".join("*".join(cols[:j + 1]) for j in range(k))
    return (levels + f", picks AS (SELECT user_idx, unnest(picked) AS nth, unnest([{scores}][1:len(picked)]) AS relevance,"
            f" unnest(range(1, {k + 1})[1:len(picked)]) AS rank FROM base{k})")


@query("smp6_own_items", V.with_views(
    "SELECT user_idx, item_idx FROM picks JOIN (SELECT item_idx, row_number() OVER (ORDER BY item_idx) - 1 AS nth FROM items) USING (nth)",
    "users", "items", extra="base AS (SELECT user_idx, (SELECT count(*) FROM items) AS free FROM users), " + random_pick_sql(5, 7)))
def random_own(spark, path):
    return own_items(V.users(spark, path), V.items(spark, path), 5, 7)


@query("smp7_weighted_draw", V.with_views(
    "SELECT user_idx, item_idx, round(weight / (SELECT sum(weight) FROM s), 12) AS relevance, rank FROM"
    " (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY -ln(((a * b % P + c * d % P) % P + cast(0.5 as double))"
    " / P) / weight, item_idx) AS rank FROM us, its) WHERE rank <= n".replace("P", str(PAIR_PRIME)).replace(
        str(PAIR_PRIME) + "ARTITION", "PARTITION"),
    "users", "items", "log", extra=
    "s AS (SELECT item_idx, coalesce(sum(relevance) / cast(count(relevance) as double) + sqrt(ln(2.0 * (SELECT count(*) FROM log))"
    " / count(relevance)), 1 + sqrt(ln(2.0 * (SELECT count(*) FROM log)))) AS weight FROM items LEFT JOIN log USING (item_idx)"
    f" GROUP BY item_idx), its AS (SELECT item_idx, weight, {residue_sql('clock.7.b', 'item_idx')} AS b,"
    f" {residue_sql('clock.7.d', 'item_idx')} AS d FROM s), us AS (SELECT user_idx, least(5 + count(DISTINCT item_idx),"
    f" (SELECT count(*) FROM items)) AS n, {residue_sql('clock.7.a', 'user_idx')} AS a, {residue_sql('clock.7.c', 'user_idx')} AS c"
    " FROM users LEFT JOIN log USING (user_idx) GROUP BY user_idx)"))
def weighted(spark, path):
    log, users, items = V.log(spark, path), V.users(spark, path), V.items(spark, path)
    rows = log.agg(F.count(F.lit(1)).alias("n"))
    weights = (items.select("item_idx").join(item_counts(log), "item_idx", "left")
               .crossJoin(F.broadcast(rows))  # a single row
               .select("item_idx", F.coalesce(ucb_score(F.col("pos"), F.col("total"), F.col("n")),
                                              ucb_unseen(F.col("n"))).alias("weight")))
    drawn = weighted_draw(draw_sizes(users, log, items, 5), weights, 7)
    return drawn.withColumn("relevance", F.round("relevance", 12))


@query("smp9_negative_pairs", V.with_views(
    "SELECT DISTINCT user_idx, i.item_idx FROM p JOIN (SELECT item_idx, row_number() OVER (ORDER BY item_idx) - 1 AS pos"
    f" FROM items) i ON i.pos = cast(floor({uniform_sql('negative.7', 'user_idx', 'p.item_idx')} * (SELECT count(*) FROM items))"
    " as bigint) WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.user_idx = p.user_idx AND q.item_idx = i.item_idx)",
    "log", "items", extra="p AS (SELECT DISTINCT user_idx, item_idx FROM log)"))
def negatives(spark, path):
    return negative_pairs(V.log(spark, path), V.items(spark, path), 7)


# ---- synthetic tables drawn from the supplied ones -----------------------------------

def _moments_sql(rows, stratum, columns):
    return (f"SELECT {stratum}, count(*) AS n, " + ", ".join(
        f"round(avg({c}), 6) AS mean_{c}, round(stddev_pop({c}), 6) AS std_{c}" for c in columns) + f" FROM {rows} GROUP BY {stratum}")


def _like_sql(rows, key, stratum, columns):
    draws = ", ".join(f"mean_{c} + std_{c} * {normal_sql(f'like.42.{c}', key)} AS {c}" for c in columns)
    return f"SELECT {key}, {stratum}, {draws} FROM {rows} JOIN ({_moments_sql(rows, stratum, columns)}) USING ({stratum})"


USER_COLUMNS, ITEM_COLUMNS = ("acctbal", "nation"), ("price", "size")
LIKE_USERS, LIKE_ITEMS = _like_sql("users", "user_idx", "segment", USER_COLUMNS), _like_sql("items", "item_idx", "category", ITEM_COLUMNS)


def _like_users(spark, path):
    return like_strata(V.users(spark, path), "user_idx", "segment", USER_COLUMNS)


def _like_items(spark, path):
    return like_strata(V.items(spark, path), "item_idx", "category", ITEM_COLUMNS)


@query("gen1_users", V.with_views(f"SELECT user_idx, segment, round(acctbal, 4) AS acctbal, round(nation, 4) AS nation FROM ({LIKE_USERS})", "users"))
def generated_users(spark, path):
    """Users with the columns of their segment, drawn anew."""
    return _like_users(spark, path).withColumns({c: F.round(c, 4) for c in USER_COLUMNS})


@query("gen2_items", V.with_views(f"SELECT item_idx, category, round(price, 4) AS price, round(size, 4) AS size FROM ({LIKE_ITEMS})", "items"))
def generated_items(spark, path):
    return _like_items(spark, path).withColumns({c: F.round(c, 4) for c in ITEM_COLUMNS})


@query("gen3_history", V.with_views(
    f"SELECT user_idx, item_idx, cast(CASE WHEN (u.acctbal > (SELECT round(avg(acctbal), 6) FROM u)) = (i.price > (SELECT round(avg(price), 6)"
    " FROM i)) THEN 1 ELSE 0 END as bigint) AS relevance FROM (SELECT DISTINCT user_idx, item_idx FROM log) JOIN u USING (user_idx)"
    " JOIN i USING (item_idx)", "log", "users", "items", extra=f"u AS ({LIKE_USERS}), i AS ({LIKE_ITEMS})"))
def generated_history(spark, path):
    """The log's pairs with feedback that follows the generated users and items."""
    return aligned_feedback(V.log(spark, path), _like_users(spark, path), _like_items(spark, path), "acctbal", "price")


@query("gen7_segment_generators", V.with_views(
    "SELECT segment, n, cast(sum(n) OVER (ORDER BY segment) - n as bigint) AS first_id, cast(sum(n) OVER (ORDER BY segment) - 1 as bigint)"
    f" AS last_id, mean_acctbal, std_acctbal, mean_nation, std_nation FROM ({_moments_sql('users', 'segment', USER_COLUMNS)})", "users"))
def segment_generators(spark, path):
    """What each segment's generator draws from, and its ids."""
    return strata_moments(V.users(spark, path), "segment", USER_COLUMNS)


@query("gen4_resampled_table", V.with_views(
    f"SELECT user_idx, segment, acctbal FROM users ORDER BY {uniform_sql('exact.gen4', 'user_idx')}, user_idx"
    " LIMIT (SELECT count(*) // 2 FROM users)", "users"))
def resampled(spark, path):
    users = V.users(spark, path).select("user_idx", "segment", "acctbal")
    return exact_rows(users, users.count() // 2, "gen4", ["user_idx"])


@query("gen5_composite_sizes", V.with_views(
    "SELECT segment, cast(round_even(weight * total, 0) as bigint) AS quota FROM (SELECT segment, count(*) /"
    " cast((SELECT count(*) FROM users) as double) AS weight, (SELECT count(*) // 4 FROM users) AS total FROM users GROUP BY segment)",
    "users"))
def composite_sizes(spark, path):
    users = V.users(spark, path)
    return quotas(shares(users, "segment"), "segment", users.count() // 4, "round").select("segment", "quota")


@query("gen5_composite_table", V.with_views(
    "SELECT user_idx, segment, acctbal FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY "
    f"{uniform_sql('quota.gen5', 'user_idx')}, user_idx) AS r FROM users) JOIN q USING (segment) WHERE r <= quota", "users",
    extra="q AS (SELECT segment, cast(round_even(weight * total, 0) as bigint) AS quota FROM (SELECT segment, count(*) /"
          " cast((SELECT count(*) FROM users) as double) AS weight, (SELECT count(*) // 4 FROM users) AS total FROM users GROUP BY segment))"))
def composite(spark, path):
    users = V.users(spark, path).select("user_idx", "segment", "acctbal")
    return composite_table(users, "segment", users.count() // 4, "gen5", ["user_idx"])


@query("prj8_labelled_ids", V.with_views("SELECT segment || '_' || user_idx AS user_idx, acctbal FROM users", "users"))
def ids_by_segment(spark, path):
    return labelled_ids(V.users(spark, path), "user_idx", "segment").select("user_idx", "acctbal")


@query("jn10_candidates_with_log", V.with_views(
    "SELECT user_idx, item_idx, cast(coalesce(times, 0) as bigint) AS times, cast(coalesce(events, 0) as bigint) AS events FROM"
    " (SELECT user_idx, item_idx FROM users, (SELECT item_idx FROM items ORDER BY "
    f"{uniform_sql('shared.7', 'item_idx')}, item_idx LIMIT 5) WHERE segment = 'BUILDING') LEFT JOIN (SELECT user_idx, item_idx, count(*)"
    " AS times FROM log GROUP BY ALL) USING (user_idx, item_idx) LEFT JOIN (SELECT user_idx, count(*) AS events FROM log GROUP BY ALL)"
    " USING (user_idx)", "users", "items", "log"))
def candidates_with_log(spark, path):
    """A segment's candidate pairs with what its users' log says of the pair and of the user."""
    users = V.users(spark, path).filter(F.col("segment") == "BUILDING")
    pairs, log = candidates(users, V.items(spark, path), V.log(spark, path), lambda u, i: shared_items(u, i, 5, 7))
    times = log.groupBy("user_idx", "item_idx").agg(F.count(F.lit(1)).alias("times"))
    events = times.groupBy("user_idx").agg(F.sum("times").alias("events"))
    return pairs.join(times, ["user_idx", "item_idx"], "left").join(events, "user_idx", "left").fillna(0, ["times", "events"])


@query("gen6_copula_table")
def copula(spark, path):
    return copula_table(V.table(spark, path, "customer"), "c_custkey", ["c_acctbal", "c_nationkey"])
