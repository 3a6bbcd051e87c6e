"""Distribution and classification metrics as table operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import running_totals


def regression_metrics(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """rmse, mse, mae, r2 and explained variance in one aggregate."""
    p, y = F.col(prediction).cast("double"), F.col(label).cast("double")
    # two aggregates so that the squares are taken around the mean
    mean = df.agg(F.avg(y).alias("__mean"))
    rows = df.crossJoin(F.broadcast(mean))  # a single row
    m = F.col("__mean")
    return rows.agg(
        F.round(F.sqrt(F.avg((y - p) * (y - p))), 6).alias("rmse"),
        F.round(F.avg((y - p) * (y - p)), 6).alias("mse"),
        F.round(F.avg(F.abs(y - p)), 6).alias("mae"),
        F.round(F.lit(1.0) - F.sum((y - p) * (y - p)) / F.sum((y - m) * (y - m)), 6).alias("r2"),
        F.round(F.avg((p - m) * (p - m)), 6).alias("var"))


def ranking_curve_areas(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve.

    Rows fold to one per distinct score before they are ordered; running counts come from
    the chunked ordering, so neither step has an unpartitioned window.
    """
    folded = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) > 0, F.lit(1)).otherwise(F.lit(0))).alias("p"),
        F.sum(F.when(F.col(label) > 0, F.lit(0)).otherwise(F.lit(1))).alias("n"))
    curve = running_totals(folded, [F.desc("score")], {"tp": "p", "fp": "n"})
    ends = curve.agg(F.sum("p").cast("double").alias("all_p"), F.sum("n").cast("double").alias("all_n"))
    before_tp, before_fp = F.col("tp") - F.col("p"), F.col("fp") - F.col("n")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    # the curve starts at recall 0 with the precision of the first threshold
    left = F.when(before_tp + before_fp > 0, before_tp / (before_tp + before_fp)).otherwise(precision)
    return curve.crossJoin(F.broadcast(ends)).agg(
        F.round(F.sum(F.col("n") * (before_tp + F.col("p") / 2.0) / F.col("all_p") / F.col("all_n")), 6).alias("area_under_roc"),
        F.round(F.sum(F.col("p") / F.col("all_p") * (left + precision) / 2.0), 6).alias("area_under_pr"))


def confusion(df: DataFrame, prediction: str, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def multiclass_by_label(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Per class: rows, precision, recall, F1, true and false positive rate."""
    # from here on one row per pair of classes
    cells = confusion(df, prediction, label)
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)))
    actual = cells.groupBy("label").agg(F.sum("n").alias("rows"), hit.alias("tp"))
    guessed = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("guessed"))
    total = cells.agg(F.sum("n").alias("total"))
    out = actual.join(guessed, "label", "left").crossJoin(F.broadcast(total)).fillna(0, ["guessed"])
    tp, rows, guesses = F.col("tp"), F.col("rows"), F.col("guessed")
    precision = F.when(guesses > 0, tp / guesses).otherwise(F.lit(0.0))
    recall = tp / rows
    other = F.col("total") - rows
    return out.select(
        "label", "rows", "total", "tp", precision.alias("precision"), recall.alias("recall"),
        F.when(precision + recall > 0, 2 * precision * recall / (precision + recall))
        .otherwise(F.lit(0.0)).alias("f1"),
        F.when(other > 0, (guesses - tp) / other).otherwise(F.lit(0.0)).alias("fpr"))


def multiclass_metrics(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Accuracy, Hamming loss and the class-weighted averages."""
    by = multiclass_by_label(df, prediction, label)
    weigh = lambda c: F.round(F.sum(F.col(c) * F.col("rows") / F.col("total")), 6)
    share = F.sum("tp") / F.max("total")
    return by.agg(F.round(share, 6).alias("accuracy"), F.round(F.lit(1.0) - share, 6).alias("hamming_loss"),
                  weigh("precision").alias("weighted_precision"), weigh("recall").alias("weighted_recall"),
                  weigh("f1").alias("f1"), weigh("fpr").alias("weighted_fpr"))


def log_loss(df: DataFrame, probability: str, label: str, eps=1e-15) -> DataFrame:
    """Mean negative log-likelihood of a 0/1 label."""
    p = F.when(F.col(label) > 0, F.col(probability)).otherwise(1.0 - F.col(probability))
    return df.agg(F.round(F.avg(-F.log(F.greatest(F.lit(eps), F.least(F.lit(1 - eps), p)))), 6).alias("log_loss"))


def ks_statistic(df: DataFrame, left: str, right: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic of two columns: largest gap of their ECDFs."""
    stacked = df.select(F.explode(F.array(
        F.struct(F.col(left).cast("double").alias("x"), F.lit(1).alias("a"), F.lit(0).alias("b")),
        F.struct(F.col(right).cast("double").alias("x"), F.lit(0).alias("a"), F.lit(1).alias("b")))).alias("s"))
    return _ks(stacked.select("s.*"))


def ks_two_tables(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """The same statistic for one column of two tables."""
    x = F.col(column).cast("double").alias("x")
    return _ks(a.select(x, F.lit(1).alias("a"), F.lit(0).alias("b"))
               .unionByName(b.select(x, F.lit(0).alias("a"), F.lit(1).alias("b"))))


def _ks(stacked: DataFrame) -> DataFrame:
    folded = stacked.filter(F.col("x").isNotNull()).groupBy("x").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    steps = running_totals(folded, ["x"], {"ca": "a", "cb": "b"})
    ends = steps.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    return steps.crossJoin(F.broadcast(ends)).agg(
        F.round(F.max(F.abs(F.col("ca") / F.col("na") - F.col("cb") / F.col("nb"))), 9).alias("ks"))


def kl_score(df: DataFrame, prediction: str, truth: str, bins: int = 10) -> DataFrame:
    """``1 / (1 + KL)`` over equal-width bins of the truth's range.

    Predictions outside that range are left out, the last bin is closed and every count
    is raised by a small constant.
    """
    return _kl(df.select(F.col(truth).cast("double").alias("t"), F.col(prediction).cast("double").alias("p")), bins)


def kl_two_tables(real: DataFrame, other: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """The same score for one column of two tables, ``real`` being the truth."""
    x = F.col(column).cast("double")
    none = F.lit(None).cast("double")
    return _kl(real.select(x.alias("t"), none.alias("p"))
               .unionByName(other.select(none.alias("t"), x.alias("p"))), bins)


def _kl(values: DataFrame, bins: int) -> DataFrame:
    span = values.agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    edge = lambda i: F.col("lo") + F.lit(i) * (F.col("hi") - F.col("lo")) / F.lit(float(bins))

    def count_in(column, i):
        above = F.col(column) >= (F.col("lo") if i == 0 else edge(i))
        below = F.col(column) <= F.col("hi") if i == bins - 1 else F.col(column) < edge(i + 1)
        return F.sum(F.when(above & below, F.lit(1)).otherwise(F.lit(0)))

    counts = values.crossJoin(F.broadcast(span)).agg(  # a single row
        *[count_in("t", i).alias(f"f{i}") for i in range(bins)],
        *[count_in("p", i).alias(f"g{i}") for i in range(bins)])
    small = F.lit(1e-5)
    terms = []
    for i in range(bins):
        f, g = F.col(f"f{i}") + small, F.col(f"g{i}") + small
        terms.append(f * F.log(f / g) - f + g)
    return counts.select(F.round(F.lit(1.0) / (F.lit(1.0) + reduce(lambda a, b: a + b, terms)), 9).alias("kl_score"))
