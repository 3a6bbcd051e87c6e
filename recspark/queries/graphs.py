"""Neighbours, sequences and graph views of the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import elements
from ..functions.draws import uniform_sql
from ..operators.graph import (decayed_edges, edges, link_scores, normalised_edges, projection_degrees,
                               propagate, random_walks, sampled_neighbour_mean, two_hop_scores)
from ..operators.neighbours import nearest, neighbour_scores, vote
from ..operators.sampling import bernoulli_rows
from ..operators.sequences import last_sequences, next_states, ngram_counts, ngram_probabilities
from ..operators.statistics import ranking_curve_areas
from ..recommenders.content import vector_width
from ..sources import views as V
from .registry import query

WIDTH = 64
VECTORS = "e AS (SELECT vec_id, label, cast(embedding as double[]) AS v FROM embeddings)"


def _vectors(spark, path):
    return V.table(spark, path, "embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")


def _nearest_sql(score, k=10):
    return (f"WITH {VECTORS}, n AS (SELECT * FROM (SELECT a.vec_id, b.vec_id AS neighbour, round({score}, 9) AS score,"
            f" row_number() OVER (PARTITION BY a.vec_id ORDER BY round({score}, 9) DESC, b.vec_id) AS rank"
            f" FROM e a JOIN e b ON a.vec_id <> b.vec_id) WHERE rank <= {k})")


COSINE = "list_cosine_similarity(a.v, b.v)"
OUT = " SELECT vec_id, neighbour, round(score, 6) AS score, rank FROM n"


def _near(spark, path, metric):
    return nearest(_vectors(spark, path), "vec_id", 10, metric).withColumn("score", F.round("score", 6))


@query("doc1_knn_cosine", _nearest_sql(COSINE) + OUT)
def knn_cosine(spark, path):
    return _near(spark, path, "cosine")


@query("doc1_knn_euclidean", _nearest_sql("-list_distance(a.v, b.v)") + OUT)
def knn_euclidean(spark, path):
    return _near(spark, path, "euclidean")


@query("doc1_knn_manhattan", _nearest_sql("-list_sum(list_transform(list_zip(a.v, b.v), lambda z: abs(z[1] - z[2])))") + OUT)
def knn_manhattan(spark, path):
    return _near(spark, path, "manhattan")


@query("doc1_knn_vote", _nearest_sql(COSINE) +
       " SELECT vec_id, predicted, votes FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, predicted) AS r FROM"
       " (SELECT n.vec_id, label AS predicted, cast(count(*) as bigint) AS votes FROM n JOIN e ON e.vec_id = n.neighbour GROUP BY ALL)) WHERE r = 1")
def knn_vote(spark, path):
    vectors = _vectors(spark, path)
    return vote(nearest(vectors, "vec_id", 10), vectors, "vec_id", "label")


@query("doc1_user_knn_recommend", V.with_views(
    "SELECT user_idx, item_idx, relevance, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC,"
    " item_idx) AS rank FROM (SELECT user_idx, item_idx, floor((sum(cast(round(score * 1e9) AS BIGINT)) + 500) / 1000.0) / 1e6 AS relevance FROM n JOIN liked USING (neighbour)"
    " ANTI JOIN (SELECT DISTINCT user_idx, item_idx FROM log) USING (user_idx, item_idx) GROUP BY user_idx, item_idx)) WHERE rank <= 5",
    "log", "user_vec", extra="uv AS (SELECT user_idx, cast(vec as double[]) AS v FROM user_vec), liked AS (SELECT DISTINCT user_idx"
    " AS neighbour, item_idx FROM log WHERE relevance > 0), n AS (SELECT * FROM (SELECT a.user_idx, b.user_idx AS neighbour,"
    f" round({COSINE}, 9) AS score, row_number() OVER (PARTITION BY a.user_idx ORDER BY round({COSINE}, 9) DESC, b.user_idx) AS r"
    " FROM uv a JOIN uv b ON a.user_idx <> b.user_idx) WHERE r <= 10)"))
def user_knn(spark, path):
    near = nearest(V.user_vectors(spark, path), "user_idx", 10)
    return neighbour_scores(near, V.log(spark, path), 5)


# ---- sequences: events as (user_idx, ts, event_id, state) ----------------------------

EVENTS = "ev AS (SELECT user_id AS user_idx, ts, event_id, event_type AS state FROM events)"


def _events(spark, path):
    return V.table(spark, path, "events").select(
        F.col("user_id").alias("user_idx"), "ts", "event_id", F.col("event_type").alias("state"))


@query("doc5_last_sequences",
       f"WITH {EVENTS} SELECT user_idx, array_to_string(list_concat(list_resize(cast([] as varchar[]), 50 - len(s), '<pad>'), s), ' ')"
       " AS states, cast(len(s) as bigint) AS steps FROM (SELECT user_idx, list(state ORDER BY ts, event_id) AS s FROM (SELECT *,"
       " row_number() OVER (PARTITION BY user_idx ORDER BY ts DESC, event_id DESC) AS r FROM ev) WHERE r <= 50 GROUP BY user_idx)")
def sequences(spark, path):
    return last_sequences(_events(spark, path), 50, pad="<pad>").select(
        "user_idx", F.array_join("states", " ").alias("states"), "steps")


def _context_sql(order):
    lags = ", ".join(f"lag(state, {i}) OVER w AS p{i}" for i in range(1, order + 1))
    context = " || '>' || ".join(f"p{i}" for i in range(order, 0, -1))
    return (f"c{order} AS (SELECT {order} AS ord, {context} AS context, state AS next FROM (SELECT *, {lags} FROM ev"
            f" WINDOW w AS (PARTITION BY user_idx ORDER BY ts, event_id)) WHERE p{order} IS NOT NULL)")


for _order in (1, 2, 3):
    query(f"doc6_ngram_counts_{_order}", f"WITH {EVENTS}, {_context_sql(_order)} SELECT context, next, cast(count(*) as bigint) AS n"
          f" FROM c{_order} GROUP BY context, next")(
        lambda spark, path, order=_order: ngram_counts(_events(spark, path), order))


@query("doc6_ngram_probabilities",
       f"WITH {EVENTS}, {_context_sql(2)}, g AS (SELECT context, next, cast(count(*) as bigint) AS n FROM c2 GROUP BY context, next)"
       " SELECT context, next, n, round((n + 0.5) / (sum(n) OVER (PARTITION BY context) + 0.5::double *"
       " (SELECT count(DISTINCT state) FROM ev)), 9) AS p FROM g")
def ngram_probability(spark, path):
    events = _events(spark, path)
    states = events.select(F.col("state").alias("next"))
    return ngram_probabilities(ngram_counts(events, 2), states, 0.5).withColumn("p", F.round("p", 9))


@query("doc6_backoff_next",
       f"WITH {EVENTS}, {_context_sql(1)}, {_context_sql(2)}, {_context_sql(3)}, g AS (SELECT ord, context, next, count(*) AS n FROM"
       " (SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3) GROUP BY ALL), best AS (SELECT * FROM (SELECT *,"
       " row_number() OVER (PARTITION BY ord, context ORDER BY n DESC, next) AS r FROM g) WHERE r = 1), tails AS (SELECT user_idx,"
       " list(state ORDER BY ts, event_id) AS s FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY ts DESC, event_id DESC)"
       " AS r FROM ev) WHERE r <= 3 GROUP BY user_idx), ask AS (SELECT user_idx, o AS ord, array_to_string(s[len(s) - o + 1:], '>') AS context"
       " FROM tails, (SELECT unnest([1, 2, 3]) AS o) WHERE o <= len(s))"
       " SELECT user_idx, ord AS \"order\", context, next FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY ord DESC) AS z"
       " FROM ask JOIN best USING (ord, context)) WHERE z = 1")
def backoff(spark, path):
    return next_states(_events(spark, path), 3)


# ---- graph ---------------------------------------------------------------------------

@query("doc7_edges", V.with_views(
    "SELECT user_idx, item_idx, cast(count(*) as bigint) AS frequency, round(sum(amount), 4) AS amount,"
    " cast(date_diff('day', max(ts), (SELECT max(ts) FROM log)) as bigint) AS age_days FROM log GROUP BY user_idx, item_idx", "log"))
def bipartite(spark, path):
    return edges(V.log(spark, path))


@query("doc8_decayed_edges", V.with_views(
    "SELECT user_idx, item_idx, round(sum(exp(-0.001::double * date_diff('day', ts, (SELECT max(ts) FROM log)))), 9) AS weight"
    " FROM log GROUP BY user_idx, item_idx", "log"))
def decayed(spark, path):
    return decayed_edges(V.log(spark, path), 0.001)


def _propagate_sql():
    def gather(name, adj_key, key, source, skey):
        dims = ", ".join(f"sum(w * v[{i + 1}])" for i in range(WIDTH))
        return f"{name} AS (SELECT a.{key}, [{dims}] AS v FROM adj a JOIN {source} s ON s.{skey} = a.{adj_key} GROUP BY a.{key})"
    dims = ", ".join(f"round((u0.v[{i + 1}] + coalesce(u1.v[{i + 1}], 0) + coalesce(u2.v[{i + 1}], 0)) / 3, 6) AS d{i}"
                     for i in range(WIDTH))
    # kept as a table: a limit around the joins would make DuckDB start them over and over
    return V.with_views(
        "SELECT * FROM result", "log", "user_vec", "item_vec", extra=
        "p AS (SELECT DISTINCT user_idx, item_idx FROM log), adj AS (SELECT user_idx, item_idx, 1 / sqrt(cast(du as double) * di) AS w"
        " FROM p JOIN (SELECT user_idx, count(*) AS du FROM p GROUP BY 1) USING (user_idx) JOIN (SELECT item_idx, count(*) AS di FROM p"
        " GROUP BY 1) USING (item_idx)), u0 AS (SELECT user_idx, cast(vec as double[]) AS v FROM user_vec),"
        " i0 AS (SELECT item_idx, cast(vec as double[]) AS v FROM item_vec), "
        + ", ".join([gather("u1", "item_idx", "user_idx", "i0", "item_idx"), gather("i1", "user_idx", "item_idx", "u0", "user_idx"),
                     gather("u2", "item_idx", "user_idx", "i1", "item_idx")])
        + f", result AS MATERIALIZED (SELECT user_idx, {dims} FROM u0 LEFT JOIN u1 USING (user_idx) LEFT JOIN u2 USING (user_idx))")


@query("doc9_propagation", _propagate_sql())
def propagation(spark, path):
    width = vector_width(_vectors(spark, path))
    users, _ = propagate(V.log(spark, path), V.user_vectors(spark, path), V.item_vectors(spark, path), width, both=False)
    return users.select("user_idx", *elements("vec", width, 6))


@query("doc9_normalised_edges", V.with_views(
    "SELECT user_idx, item_idx, round(1 / sqrt(cast(du as double) * di), 9) AS w FROM p JOIN (SELECT user_idx, count(*) AS du FROM p"
    " GROUP BY 1) USING (user_idx) JOIN (SELECT item_idx, count(*) AS di FROM p GROUP BY 1) USING (item_idx)", "log",
    extra="p AS (SELECT DISTINCT user_idx, item_idx FROM log)"))
def normalised(spark, path):
    return normalised_edges(V.log(spark, path)).withColumn("w", F.round("w", 9))


@query("doc10_neighbour_mean", V.with_views(
    "SELECT user_idx, cast(count(*) as bigint) AS neighbours, " + ", ".join(f"round(avg(cast(vec[{i + 1}] as double)), 6) AS d{i}" for i in range(WIDTH))
    + f" FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY {uniform_sql('neighbour.7', 'user_idx', 'item_idx')}, item_idx)"
    " AS r FROM (SELECT DISTINCT user_idx, item_idx FROM log)) JOIN item_vec USING (item_idx) WHERE r <= 10 GROUP BY user_idx", "log", "item_vec"))
def neighbour_mean(spark, path):
    width = vector_width(_vectors(spark, path))
    means = sampled_neighbour_mean(V.log(spark, path), V.item_vectors(spark, path), 10, width, 7)
    return means.select("user_idx", "neighbours", *elements("vec", width, 6))


WALK_STEPS = 4


def _walk_sql():
    ctes = ("p AS (SELECT DISTINCT user_idx, item_idx FROM log),"
            " un AS (SELECT user_idx AS here, item_idx AS there, row_number() OVER (PARTITION BY user_idx ORDER BY item_idx) AS nth,"
            " count(*) OVER (PARTITION BY user_idx) AS deg FROM p),"
            " it AS (SELECT item_idx AS here, user_idx AS there, row_number() OVER (PARTITION BY item_idx ORDER BY user_idx) AS nth,"
            " count(*) OVER (PARTITION BY item_idx) AS deg FROM p),"
            " w0 AS (SELECT user_idx, user_idx AS here, 'u' || user_idx AS path FROM users)")
    for s in range(WALK_STEPS):
        side, label = ("un", "i") if s % 2 == 0 else ("it", "u")
        ctes += (f", w{s + 1} AS (SELECT w.user_idx, e.there AS here, path || ' {label}' || e.there AS path FROM w{s} w JOIN {side} e"
                 f" ON e.here = w.here AND e.nth = cast(floor({uniform_sql(f'walk.7.{s}', 'w.user_idx')} * e.deg) as bigint) + 1)")
    ctes += f", result AS MATERIALIZED (SELECT user_idx, path FROM w{WALK_STEPS})"
    return V.with_views("SELECT * FROM result", "log", "users", extra=ctes)


@query("doc11_random_walks", _walk_sql())
def walks(spark, path):
    out = random_walks(V.log(spark, path), V.users(spark, path), WALK_STEPS, 7)
    return out.select("user_idx", F.array_join("path", " ").alias("path"))


LINKS = ("p AS (SELECT user_idx, item_idx, max(relevance) AS label FROM log GROUP BY ALL), ls AS (SELECT user_idx, item_idx, label,"
         " list_dot_product(a, b) AS dot, list_cosine_similarity(a, b) AS cosine FROM (SELECT p.*, cast(u.vec as double[]) AS a,"
         " cast(i.vec as double[]) AS b FROM p JOIN user_vec u USING (user_idx) JOIN item_vec i USING (item_idx)))")


def _links(spark, path):
    pairs = V.log(spark, path).groupBy("user_idx", "item_idx").agg(F.max("relevance").alias("label"))
    return link_scores(pairs, V.user_vectors(spark, path), V.item_vectors(spark, path))


@query("doc12_link_scores", V.with_views(
    "SELECT user_idx, item_idx, label, round(dot, 6) AS dot, round(cosine, 6) AS cosine FROM ls", "log", "user_vec", "item_vec", extra=LINKS))
def links(spark, path):
    return _links(spark, path).select("user_idx", "item_idx", "label", F.round("dot", 6).alias("dot"),
                                      F.round("cosine", 6).alias("cosine"))


@query("doc12_link_auc", V.with_views(
    "SELECT round(sum(n * (tp - p + p / 2.0) / (SELECT sum(p) FROM f)::double / (SELECT sum(n) FROM f)::double), 6) AS area_under_roc"
    " FROM (SELECT *, sum(p) OVER (ORDER BY s DESC) AS tp FROM f)", "log", "user_vec", "item_vec",
    extra=LINKS + ", f AS (SELECT round(cosine, 6) AS s, count(CASE WHEN label > 0 THEN 1 END) AS p,"
                  " count(CASE WHEN label = 0 THEN 1 END) AS n FROM ls GROUP BY 1)"))
def link_auc(spark, path):
    scored = _links(spark, path).select(F.round("cosine", 6).alias("s"), "label")
    return ranking_curve_areas(scored, "s", "label").select("area_under_roc")


@query("doc13_projection_degrees", V.with_views(
    "SELECT a.item_idx, cast(count(DISTINCT a.user_idx) as bigint) AS users, cast(sum(du - 1) as bigint) AS shared_weight FROM p a"
    " JOIN (SELECT user_idx, count(*) AS du FROM p GROUP BY 1) USING (user_idx) GROUP BY a.item_idx", "log",
    extra="p AS (SELECT DISTINCT user_idx, item_idx FROM log)"))
def projection(spark, path):
    return projection_degrees(V.log(spark, path))


@query("doc13_two_hop", V.with_views(
    "SELECT item_idx, round(avg(taste), 6) AS score FROM p JOIN (SELECT user_idx, avg(price) AS taste FROM p JOIN items USING (item_idx)"
    " GROUP BY user_idx) USING (user_idx) GROUP BY item_idx", "log", "items", extra="p AS (SELECT DISTINCT user_idx, item_idx FROM log)"))
def two_hop(spark, path):
    prices = V.items(spark, path).select("item_idx", F.col("price").alias("weight"))
    return two_hop_scores(V.log(spark, path), prices)


@query("doc17_edge_dropout", V.with_views(
    "SELECT user_idx, item_idx FROM (SELECT DISTINCT user_idx, item_idx FROM log) WHERE "
    f"{uniform_sql('bernoulli.drop', 'user_idx', 'item_idx')} < 0.8::double", "log"))
def dropout(spark, path):
    pairs = V.log(spark, path).select("user_idx", "item_idx").distinct()
    return bernoulli_rows(pairs, 0.8, "drop", ["user_idx", "item_idx"])
