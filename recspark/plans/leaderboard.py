"""Queries over a table of submissions: (id, team, submitted, score, status, error)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_BOARD_ROWS = 10_000


def ranked(submissions: DataFrame) -> DataFrame:
    """Successful submissions, best score first."""
    return (submissions.filter(F.col("status") == "success").select("id", "team", "submitted", "score")
            .orderBy(F.desc("score"), "submitted", "id"))


def board(submissions: DataFrame, rows: int = 50) -> DataFrame:
    """The first ``rows`` with their 1-based position.

    The limit is applied while sorting, so the position window sees ``rows`` rows only.
    """
    if rows > MAX_BOARD_ROWS:
        raise ValueError(f"a board has at most {MAX_BOARD_ROWS} rows")
    best = ranked(submissions).limit(rows)
    order = Window.orderBy(F.desc("score"), "submitted", "id")
    return best.withColumn("position", F.row_number().over(order).cast("bigint"))


def recent(submissions: DataFrame) -> DataFrame:
    return submissions.orderBy(F.desc("submitted"), F.desc("id"))


def team_statistics(submissions: DataFrame) -> DataFrame:
    ok = F.col("status") == "success"
    return submissions.groupBy("team").agg(
        F.count(F.lit(1)).alias("submissions"), F.count_if(ok).alias("successes"),
        F.round(F.avg(F.when(ok, F.lit(100.0)).otherwise(F.lit(0.0))), 6).alias("success_rate"),
        F.max(F.when(ok, F.col("score"))).alias("best_score"))


def summary(submissions: DataFrame) -> DataFrame:
    ok = F.col("status") == "success"
    return submissions.agg(
        F.count_distinct("team").alias("teams"), F.count(F.lit(1)).alias("submissions"),
        F.count_if(ok).alias("successes"), F.count_if(F.col("status") == "error").alias("errors"),
        F.max(F.when(ok, F.col("score"))).alias("best_score"),
        F.round(F.avg(F.when(ok, F.col("score"))), 4).alias("mean_score"))


def status_counts(submissions: DataFrame) -> DataFrame:
    return submissions.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
