"""Scored batches, walk-forward backtests and model comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.draws import normal_sql, uniform_sql
from ..operators.metrics import RANKING, ranking_metrics_sql
from ..plans.backtest import (backtest, compare, periods, phase_averages, score_batch,
                              train_test, walk_forward)
from ..plans.report import density_sweep, metric_correlations, trajectory
from ..recommenders import PopularityRecommender
from ..sources import views as V
from ..operators.durable import scratch_path, stored
from ..sources.tables import IterationLog
from .recommend import POPULARITY, shared_sql
from .registry import query

K, TEST = 5, 5
WALK = "SELECT iter, iter AS fit, 'train' AS phase FROM ps WHERE rn > 1"
SPLIT = (f"SELECT iter, CASE WHEN rn > n - {TEST} THEN (SELECT iter FROM ps WHERE rn = n - {TEST - 1}) ELSE iter END AS fit,"
         f" CASE WHEN rn > n - {TEST} THEN 'test' ELSE 'train' END AS phase FROM ps WHERE rn > 1")


def backtest_sql(schedule: str, models=("popularity", "bandit", "price_bandit")) -> str:
    """CTEs up to ``results``: each user's best k unseen items lie among the first k + seen."""
    score = {"popularity": "coalesce((pos + 1.0) / (total + 2.0), 0.5)",
             "bandit": "coalesce(pos / total + sqrt(ln(2.0 * n) / total), 1 + sqrt(ln(2.0 * n)))"}
    score["price_bandit"] = f"0.7 * {score['bandit']} + 0.3 * price / (SELECT max(price) FROM items)"
    union = " UNION ALL ".join(
        f"SELECT '{m}' AS model, iter, item_idx, round({score[m]}, 12) AS relevance FROM grid" for m in models)
    ctes, select = ranking_metrics_sql("lists", K, "model, iter")
    return (
        "lg AS MATERIALIZED (SELECT * FROM log), ps AS (SELECT iter, row_number() OVER (ORDER BY iter) AS rn, count(*) OVER () AS n"
        f" FROM (SELECT DISTINCT iter FROM lg)), sched AS ({schedule}),"
        " st AS (SELECT s.iter, item_idx, sum(relevance) AS pos, cast(count(*) as double) AS total FROM sched s JOIN lg l"
        " ON l.iter < s.fit GROUP BY s.iter, item_idx), nn AS (SELECT iter, sum(total) AS n FROM st GROUP BY iter),"
        " grid AS (SELECT s.iter, i.item_idx, price, pos, total, n FROM sched s CROSS JOIN items i JOIN nn ON nn.iter = s.iter"
        " LEFT JOIN st ON st.iter = s.iter AND st.item_idx = i.item_idx),"
        f" placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY model, iter ORDER BY relevance DESC, item_idx) AS place FROM ({union})),"
        " act AS (SELECT DISTINCT l.iter, user_idx FROM lg l JOIN sched s ON s.iter = l.iter),"
        " fst AS (SELECT user_idx, item_idx, min(iter) AS first FROM lg GROUP BY user_idx, item_idx),"
        " sn AS MATERIALIZED (SELECT a.iter, a.user_idx, f.item_idx FROM act a JOIN fst f ON f.user_idx = a.user_idx AND f.first < a.iter),"
        " cnt AS (SELECT a.iter, a.user_idx, count(s.item_idx) AS c FROM act a LEFT JOIN sn s USING (iter, user_idx) GROUP BY ALL),"
        " cand AS (SELECT model, p.iter, user_idx, item_idx, relevance FROM cnt JOIN placed p ON p.iter = cnt.iter"
        f" AND p.place <= cnt.c + {K} ANTI JOIN sn ON sn.iter = p.iter AND sn.user_idx = cnt.user_idx AND sn.item_idx = p.item_idx),"
        " rc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, iter, user_idx ORDER BY relevance DESC, item_idx)"
        f" AS rank FROM cand) WHERE rank <= {K}), tr AS (SELECT iter, user_idx, item_idx, max(relevance) AS response,"
        " sum(relevance * amount) AS revenue FROM lg GROUP BY ALL), lists AS (SELECT rc.model, rc.iter, rc.user_idx, rc.item_idx,"
        " rc.relevance, rc.rank, coalesce(tr.response, 0) AS response, coalesce(tr.revenue, 0) AS revenue FROM rc LEFT JOIN tr"
        f" USING (iter, user_idx, item_idx)), {ctes}, results AS (SELECT * FROM (" +
        select.replace("SELECT model, iter, ", "SELECT model, iter, ", 1) + ") JOIN sched USING (iter))")


RESULT = ("model, iter, phase, precision_at_k, ndcg_at_k, mrr, hit_rate, discounted_revenue, revenue, conversion_rate, geometric_dcg")


def _log_items(spark, path):
    return V.log(spark, path), V.items(spark, path)


def _judged_log(spark, path):
    """The columns of the log that a backtest reads several times, joined once."""
    return stored(V.log(spark, path).select("user_idx", "item_idx", "relevance", "amount", "iter"), "log")


@query("job1_score_and_append", V.with_views(
    "SELECT cast((SELECT count(*) FROM answered) as bigint) AS logged, cast(sum(response) as bigint) AS purchases,"
    " round(sum(revenue), 4) AS revenue FROM answered", "log", "users", "items",
    extra=shared_sql(POPULARITY) + ", answered AS (SELECT *, response * price AS revenue FROM (SELECT *, CASE WHEN "
    f"{uniform_sql('response.42.buy', 'user_idx', 'item_idx')} <= least(1.0, greatest(0.0, relevance + p)) THEN 1 ELSE 0 END"
    f" AS response FROM (SELECT *, greatest(0.0, {normal_sql('response.42.noise', 'user_idx', 'item_idx', mean='0.1', std=0.05)})"
    " AS p FROM best JOIN items USING (item_idx))))"))
def score_and_append(spark, path):
    log, items = _log_items(spark, path)
    sink = IterationLog(spark, scratch_path(spark, "log"))
    metrics = score_batch(PopularityRecommender().fit(log), log, V.users(spark, path), items, K, "train_0", sink,
                          user_fraction=1.0, response_model="additive")
    stored = sink.read().agg(F.count(F.lit(1)).alias("logged"), F.sum("relevance").alias("purchases"))
    return stored.crossJoin(F.broadcast(metrics.select("revenue")))  # single rows


@query("job2_walk_forward", V.with_views(f"SELECT {RESULT} FROM results", "log", "items",
                                         extra=backtest_sql(WALK, ("popularity",))))
def walk(spark, path):
    log, items = _judged_log(spark, path), V.items(spark, path)
    return backtest(log, items, walk_forward(periods(log)), K, ["popularity"])


@query("job3_train_test", V.with_views(f"SELECT {RESULT} FROM results", "log", "items", extra=backtest_sql(SPLIT)))
def split(spark, path):
    log, items = _judged_log(spark, path), V.items(spark, path)
    return backtest(log, items, train_test(periods(log), TEST), K)


def _compare_sql():
    cols = [f"round(avg(CASE WHEN phase = '{ph}' THEN {m} END), 6) AS {ph}_{m}"
            for ph in ("train", "test") for m in RANKING[:6] if m != "revenue"]
    cols += [f"round(coalesce(sum(CASE WHEN phase = '{ph}' THEN revenue END), 0), 4) AS {ph}_total_revenue" for ph in ("train", "test")]
    cols += [f"round(avg(CASE WHEN phase = '{ph}' THEN revenue END), 4) AS {ph}_avg_revenue" for ph in ("train", "test")]
    return (f"SELECT *, round(CASE WHEN train_avg_revenue > 0 THEN (test_avg_revenue / train_avg_revenue - 1) * 100 ELSE 0 END, 6)"
            f" AS performance_change FROM (SELECT model, {', '.join(cols)} FROM results GROUP BY model)")


@query("job4_compare_models", V.with_views(_compare_sql(), "log", "items", extra=backtest_sql(SPLIT)))
def comparison(spark, path):
    return compare(split(spark, path))


@query("job5_density_sweep", V.with_views(
    "SELECT density, upto, cast(sum(n) as bigint) AS total_interactions, cast(count(*) as bigint) AS unique_users,"
    " round(avg(n), 6) AS avg_per_user, cast(max(n) as bigint) AS max_per_user,"
    " round(100.0 * count(CASE WHEN n > 1 THEN 1 END) / cast(count(*) as double), 6) AS pct_with_multiple,"
    " any_value(items) AS unique_items FROM (SELECT density, upto, user_idx, count(*) AS n FROM c GROUP BY ALL)"
    " JOIN (SELECT density, upto, cast(count(DISTINCT item_idx) as bigint) AS items FROM c GROUP BY ALL) USING (density, upto)"
    " GROUP BY density, upto", "log",
    extra=f"d AS (SELECT unnest([0.25, 0.5, 0.75, 1.0])::double AS density), l AS (SELECT user_idx, item_idx, substring(iter, 1, 4)"
          f" AS period, {uniform_sql('density.7', 'user_idx', 'item_idx')} AS u FROM log), c AS (SELECT density, upto, user_idx,"
          " item_idx FROM d, (SELECT DISTINCT period AS upto FROM l) JOIN l ON period <= upto WHERE u < density)"))
def sweep(spark, path):
    log = V.log(spark, path).withColumn("period", F.substring("iter", 1, 4))
    years = sorted({p[:4] for p in periods(V.log(spark, path))})
    return density_sweep(log, [0.25, 0.5, 0.75, 1.0], years, 7)


@query("job6_phase_averages", V.with_views(
    "SELECT model, phase, metric, round(avg(value), 6) AS mean, cast(count(*) as bigint) AS periods FROM (" + " UNION ALL ".join(
        f"SELECT model, phase, '{m}' AS metric, {m} AS value FROM results" for m in RANKING[:6]) +
    ") GROUP BY ALL", "log", "items", extra=backtest_sql(SPLIT)))
def averages(spark, path):
    return phase_averages(split(spark, path))


@query("agg18_phase_revenue", V.with_views(
    "SELECT model, phase, round(sum(revenue), 4) AS total_revenue, round(avg(revenue), 4) AS avg_revenue FROM results"
    " GROUP BY model, phase", "log", "items", extra=backtest_sql(SPLIT)))
def phase_revenue(spark, path):
    return split(spark, path).groupBy("model", "phase").agg(
        F.round(F.sum("revenue"), 4).alias("total_revenue"), F.round(F.avg("revenue"), 4).alias("avg_revenue"))


@query("job8_revenue_trajectory", V.with_views(
    "SELECT model, iter, revenue AS value FROM results", "log", "items", extra=backtest_sql(WALK)))
def revenue_trajectory(spark, path):
    log, items = _judged_log(spark, path), V.items(spark, path)
    return trajectory(backtest(log, items, walk_forward(periods(log)), K), "revenue")


@query("job8_metric_correlation", V.with_views(" UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM results" for a, b in
    [("precision_at_k", "precision_at_k"), ("precision_at_k", "mrr"), ("precision_at_k", "revenue"), ("mrr", "mrr"),
     ("mrr", "revenue"), ("revenue", "revenue")]), "log", "items", extra=backtest_sql(WALK)))
def correlation(spark, path):
    log, items = _judged_log(spark, path), V.items(spark, path)
    results = backtest(log, items, walk_forward(periods(log)), K)
    return metric_correlations(results, ["precision_at_k", "mrr", "revenue"])


@query("doc16_learning_curve", V.with_views(
    "SELECT iter, precision_at_k, ndcg_at_k, log_rows FROM results JOIN (SELECT iter, cast(n as bigint) AS log_rows FROM nn)"
    " USING (iter)", "log", "items", extra=backtest_sql(WALK, ("bandit",))))
def learning_curve(spark, path):
    """Quality of one model against the amount of log it was fitted on."""
    log, items = _judged_log(spark, path), V.items(spark, path)
    labels = periods(log)
    results = backtest(log, items, walk_forward(labels), K, ["bandit"])
    # one row per period
    sizes = log.groupBy("iter").agg(F.count(F.lit(1)).alias("n"))
    upto = sizes.withColumn("at", F.explode(F.filter(F.array(*[F.lit(p) for p in labels]), lambda p: p > F.col("iter"))))
    upto = upto.groupBy(F.col("at").alias("iter")).agg(F.sum("n").alias("log_rows"))
    return results.join(upto, "iter").select("iter", "precision_at_k", "ndcg_at_k", "log_rows")


