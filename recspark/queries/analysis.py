"""Leaderboard queries and report tables.

Orders stand in for submissions: the customer is the team, the total price the score and
the order status the outcome.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.profile import histogram, interaction_stats
from ..plans import leaderboard as L
from ..plans.report import metric_registry
from ..sources import views as V
from .registry import query

SUBS = ("subs AS (SELECT o_orderkey AS id, o_custkey AS team, o_orderdate AS submitted, o_totalprice AS score,"
        " CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'error' ELSE 'pending' END AS status,"
        " CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS error FROM orders)")


def _subs(sql):
    return f"WITH {SUBS} {sql}"


def submissions(spark, path):
    status = (F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "error")
              .otherwise("pending"))
    return V.table(spark, path, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("team"), F.col("o_orderdate").alias("submitted"),
        F.col("o_totalprice").alias("score"), status.alias("status"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("error"))


@query("lb1_ranked", _subs("SELECT id, team, submitted, score FROM subs WHERE status = 'success'"))
def ranked(spark, path):
    return L.ranked(submissions(spark, path))


@query("lb2_board", _subs("SELECT id, team, submitted, score, row_number() OVER (ORDER BY score DESC, submitted, id) AS position"
                          " FROM subs WHERE status = 'success' ORDER BY position LIMIT 50"))
def board(spark, path):
    return L.board(submissions(spark, path))


@query("lb3_recent", _subs("SELECT id, team, submitted, score, status, error FROM subs"))
def recent(spark, path):
    return L.recent(submissions(spark, path))


@query("lb4_team_statistics", _subs(
    "SELECT team, cast(count(*) as bigint) AS submissions, cast(count(CASE WHEN status = 'success' THEN 1 END) as bigint) AS successes,"
    " round(100.0 * count(CASE WHEN status = 'success' THEN 1 END) / cast(count(*) as double), 6) AS success_rate,"
    " max(CASE WHEN status = 'success' THEN score END) AS best_score FROM subs GROUP BY team"))
def teams(spark, path):
    return L.team_statistics(submissions(spark, path))


@query("agg19_summary", _subs(
    "SELECT cast(count(DISTINCT team) as bigint) AS teams, cast(count(*) as bigint) AS submissions,"
    " cast(count(CASE WHEN status = 'success' THEN 1 END) as bigint) AS successes,"
    " cast(count(CASE WHEN status = 'error' THEN 1 END) as bigint) AS errors, max(CASE WHEN status = 'success' THEN score END)"
    " AS best_score, round(avg(CASE WHEN status = 'success' THEN score END), 4) AS mean_score FROM subs"))
def summary(spark, path):
    return L.summary(submissions(spark, path))


@query("agg19_status_counts", _subs("SELECT status, cast(count(*) as bigint) AS n FROM subs GROUP BY status"))
def statuses(spark, path):
    return L.status_counts(submissions(spark, path))


@query("win6_positions", _subs(
    "SELECT id, row_number() OVER (ORDER BY score DESC, submitted, id) AS position FROM subs WHERE status = 'success'"))
def positions(spark, path):
    from ..operators.ordering import with_position
    ok = submissions(spark, path).filter(F.col("status") == "success").select("id", "score", "submitted")
    return with_position(ok, [F.desc("score"), "submitted", "id"]).select("id", (F.col("pos") + 1).alias("position"))


@query("srt3_recent_first", _subs("SELECT id, submitted FROM subs ORDER BY submitted DESC, id DESC"))
def recent_first(spark, path):
    return L.recent(submissions(spark, path)).select("id", "submitted")


@query("lb5_performance_change", _subs(
    "SELECT team, round(CASE WHEN train > 0 THEN (test / train - 1) * 100 ELSE 0 END, 6) AS performance_change FROM"
    " (SELECT team, coalesce(avg(CASE WHEN submitted < TIMESTAMP '1998-01-01' THEN score END), 0) AS train,"
    " coalesce(avg(CASE WHEN submitted >= TIMESTAMP '1998-01-01' THEN score END), 0) AS test FROM subs GROUP BY team)"))
def change(spark, path):
    from ..plans.backtest import performance_change
    early = F.col("submitted") < F.lit("1998-01-01").cast("timestamp_ntz")
    mean = lambda c: F.coalesce(F.avg(F.when(c, F.col("score"))), F.lit(0.0))
    sides = submissions(spark, path).groupBy("team").agg(mean(early).alias("train"), mean(~early).alias("test"))
    return sides.select("team", performance_change("train", "test").alias("performance_change"))


@query("job7_period_report", V.with_views(
    "SELECT iter, cast(sum(n) as bigint) AS total_interactions, cast(count(*) as bigint) AS unique_users,"
    " cast(max(n) as bigint) AS max_per_user FROM (SELECT iter, user_idx, count(*) AS n FROM log GROUP BY ALL) GROUP BY iter", "log"))
def period_report(spark, path):
    return interaction_stats(V.log(spark, path), ["iter"]).select(
        "iter", "total_interactions", "unique_users", "max_per_user")


@query("job7_activity_histogram", V.with_views(
    "SELECT bin, cast(count(*) as bigint) AS n, round(min(lo), 6) AS low, round(max(hi), 6) AS high FROM (SELECT lo, hi,"
    " cast(CASE WHEN hi > lo THEN least(floor((c - lo) / (hi - lo) * 20), 19) ELSE 0 END as bigint) AS bin FROM t,"
    " (SELECT cast(min(c) as double) AS lo, cast(max(c) as double) AS hi FROM t)) GROUP BY bin", "log",
    extra="t AS (SELECT user_idx, count(*) AS c FROM log GROUP BY user_idx)"))
def activity_histogram(spark, path):
    counts = V.log(spark, path).groupBy("user_idx").agg(F.count(F.lit(1)).alias("c"))
    return histogram(counts, "c", 20)


@query("met16_metric_values", V.with_views(
    "SELECT metric, value FROM (SELECT 'revenue' AS metric, round(sum(relevance * amount), 4) AS value FROM log UNION ALL"
    " SELECT 'conversion_rate', round(avg(relevance), 6) FROM log)", "log"))
def metric_values(spark, path):
    """Metrics of the whole log that the registry knows, in long form."""
    wide = V.log(spark, path).agg(
        F.round(F.sum(F.col("relevance") * F.col("amount")), 4).alias("revenue"),
        F.round(F.avg("relevance"), 6).alias("conversion_rate"))
    long = wide.unpivot([], ["revenue", "conversion_rate"], "metric", "value")
    return long.join(F.broadcast(metric_registry(spark)), "metric").select("metric", "value")  # a fixed list
