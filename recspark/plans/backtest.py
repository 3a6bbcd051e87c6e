"""Walk-forward evaluation of shared-score models, for all periods and models in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import wide_join
from ..operators.lists import draw_responses, enrich
from ..operators.metrics import RANKING, metrics_long, ranking_metrics
from ..operators.sampling import bernoulli_rows
from ..recommenders.shared_score import (longest_history, recommend_by_score,
                                         smoothed_popularity, ucb_score, ucb_unseen)
from ..sources.tables import IterationLog

MAX_PERIODS = 1000


def periods(log: DataFrame) -> list[str]:
    """Sorted iteration labels; refuses a column that is not a small set of labels."""
    rows = log.select("iter").distinct().orderBy("iter").limit(MAX_PERIODS + 1).collect()
    if len(rows) > MAX_PERIODS:
        raise ValueError(f"more than {MAX_PERIODS} periods")
    return [r[0] for r in rows]


def walk_forward(labels: list[str]) -> list[tuple]:
    """(period, fit, phase): each period is judged by a model of everything before it."""
    return [(p, p, "train") for p in labels[1:]]


def train_test(labels: list[str], test: int) -> list[tuple]:
    """Refit before every training period, then one last fit that all test periods share."""
    first = labels[-test]
    return ([(p, p, "train") for p in labels[1:-test]] + [(p, first, "test") for p in labels[-test:]])


def model_scores(log: DataFrame, items: DataFrame, plan, alpha=1.0, coef=2.0, price_weight=0.3) -> DataFrame:
    """(model, iter, item_idx, relevance) of every shared-score model at every period.

    The log folds to one row per item and period; a running sum over the few periods of an
    item gives its counts before each period, and the plan picks the periods to fit at.
    """
    marks = sorted({fit for _, fit, _ in plan})
    # events count towards the first fit after them; those after the last fit do not count
    after = F.array_min(F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: m > F.col("iter")))
    counts = (log.groupBy("item_idx", "iter")
              .agg(F.sum("relevance").alias("pos"), F.count("relevance").alias("total"))
              .withColumn("fit", after).filter(F.col("fit").isNotNull())
              .groupBy("item_idx", "fit").agg(F.sum("pos").alias("pos"), F.sum("total").alias("total")))
    cells = items.select("item_idx", "price", F.explode(F.array(*[F.lit(m) for m in marks])).alias("fit"))
    upto = Window.partitionBy("item_idx").orderBy("fit").rowsBetween(Window.unboundedPreceding, 0)
    grid = cells.join(counts, ["item_idx", "fit"], "left").select(
        "item_idx", "price", "fit", F.sum("pos").over(upto).alias("pos"), F.sum("total").over(upto).alias("total"))
    sizes = counts.groupBy("fit").agg(F.sum("total").alias("n"))  # one row per fit
    sizes = sizes.select("fit", F.sum("n").over(
        Window.orderBy("fit").rowsBetween(Window.unboundedPreceding, 0)).alias("log_rows"))
    top = items.agg(F.max("price").alias("top"))
    grid = (grid.join(F.broadcast(sizes), "fit")
            .crossJoin(F.broadcast(top)))  # a single row
    pos, total, n = F.col("pos"), F.col("total"), F.col("log_rows")
    popular = F.coalesce(smoothed_popularity(pos, total, alpha), F.lit(0.5))
    bandit = F.coalesce(ucb_score(pos, total, n, coef), ucb_unseen(n, coef))
    priced = F.lit(1 - price_weight) * bandit + F.lit(float(price_weight)) * F.col("price") / F.col("top")
    models = F.array(*[F.struct(F.lit(name).alias("model"), F.round(score, 12).alias("relevance"))
                       for name, score in (("popularity", popular), ("bandit", bandit), ("price_bandit", priced))])
    fits = F.array(*[F.struct(F.lit(fit).alias("fit"), F.array(*[F.lit(p) for p, f, _ in plan if f == fit])
                              .alias("iters")) for fit in marks])
    users_of_fit = F.explode(F.get(F.filter(fits, lambda f: f["fit"] == F.col("fit")), F.lit(0))["iters"])
    return (grid.select("fit", "item_idx", F.explode(models).alias("m"))
            .select(users_of_fit.alias("iter"), "m.model", "item_idx", "m.relevance"))


def _periods_of(log: DataFrame, plan) -> DataFrame:
    """Active (iter, user_idx) of the planned periods."""
    return log.filter(F.col("iter").isin([p for p, _, _ in plan])).select("iter", "user_idx").distinct()


def backtest_lists(log: DataFrame, items: DataFrame, plan, k: int, models=None) -> DataFrame:
    """Recommendations for the users active in each period, with what they then did."""
    scores = model_scores(log, items, plan)
    if models is not None:
        scores = scores.filter(F.col("model").isin(list(models)))
    names = list(models) if models is not None else ["popularity", "bandit", "price_bandit"]
    active = _periods_of(log, plan)
    each_model = F.explode(F.array(*[F.lit(n) for n in names]))
    who = active.select(each_model.alias("model"), "iter", "user_idx")
    reached = [log]

    def seen(head):
        """Histories before each active period; of items that no list can reach no row is dealt."""
        if head is not None:  # its size was checked
            reached[0] = log.join(F.broadcast(head), "item_idx", "left_semi")
        first = reached[0].groupBy("user_idx", "item_idx").agg(F.min("iter").alias("first"))
        sets = active.groupBy("user_idx").agg(F.collect_set("iter").alias("active"))  # as many entries as periods at most
        return (wide_join(first, sets, ["user_idx"], ["item_idx"], counted=log)
                .withColumn("iter", F.explode(F.filter("active", lambda p: p > F.col("first"))))
                .select("iter", "user_idx", "item_idx"))

    recs = recommend_by_score(scores, who, seen, k, ["model", "iter"], longest=longest_history(log))
    truth = reached[0].groupBy("iter", "user_idx", "item_idx").agg(
        F.max("relevance").alias("response"), F.sum(F.col("relevance") * F.col("amount")).alias("revenue"))
    return (recs.join(truth, ["iter", "user_idx", "item_idx"], "left")
            .fillna(0, ["response"]).fillna(0.0, ["revenue"]))


def backtest(log: DataFrame, items: DataFrame, plan, k: int = 5, models=None) -> DataFrame:
    """One row of metrics per (model, iter, phase)."""
    phases = F.lit(None).cast("string")
    for p, _, phase in plan:
        phases = F.when(F.col("iter") == p, F.lit(phase)).otherwise(phases)
    return (ranking_metrics(backtest_lists(log, items, plan, k, models), k, ["model", "iter"])
            .withColumn("phase", phases))


def compare(results: DataFrame) -> DataFrame:
    """Phase averages and totals per model, one row per model, best test revenue first."""
    cells = results.groupBy("model").agg(
        *[F.round(F.avg(F.when(F.col("phase") == ph, F.col(m))), 6).alias(f"{ph}_{m}")
          for ph in ("train", "test") for m in RANKING[:6] if m != "revenue"],
        *[F.round(F.coalesce(F.sum(F.when(F.col("phase") == ph, F.col("revenue"))), F.lit(0.0)), 4)
          .alias(f"{ph}_total_revenue") for ph in ("train", "test")],
        *[F.round(F.avg(F.when(F.col("phase") == ph, F.col("revenue"))), 4).alias(f"{ph}_avg_revenue")
          for ph in ("train", "test")])
    return cells.withColumn("performance_change", performance_change("train_avg_revenue", "test_avg_revenue")) \
                .orderBy(F.desc("test_total_revenue"), "model")


def performance_change(train: str, test: str):
    """Percent change from training to test average; 0 without a positive training average."""
    t = F.col(train)
    return F.round(F.when(t > 0, (F.col(test) / t - 1.0) * 100.0).otherwise(F.lit(0.0)), 6)


def phase_averages(results: DataFrame) -> DataFrame:
    """Mean of every metric per model and phase, in long form."""
    return (metrics_long(results, ["model", "phase", "iter"]).groupBy("model", "phase", "metric")
            .agg(F.round(F.avg("value"), 6).alias("mean"), F.count(F.lit(1)).alias("periods")))


def score_batch(model, log: DataFrame, users: DataFrame, items: DataFrame, k: int, label: str,
                sink: IterationLog | None = None, user_fraction: float = 0.1, seed: int = 42,
                response_model="noise") -> DataFrame:
    """Score a sample of users, draw their responses, append them to the log; metrics back.

    Responses are hash draws: the logged rows and the metrics agree even if parts of the
    plan run twice.
    """
    who = users if user_fraction >= 1 else bernoulli_rows(users, user_fraction, f"{seed}.{label}", ["user_idx"])
    recs = model.predict(log, k, who, items)
    answered = draw_responses(enrich(recs, items=items.select("item_idx", "price")), seed, model=response_model)
    if sink is not None:
        sink.append(answered.select("user_idx", "item_idx", F.col("response").cast("bigint").alias("relevance")),
                    label, replace=True)
    return ranking_metrics(answered, k).withColumn("iter", F.lit(label))
