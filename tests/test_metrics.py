"""Metrics on hand-made lists with hand-computed values."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from recspark.functions.arrays import angular, cosine
from recspark.functions.scoring import utility
from recspark.operators.metrics import metrics_long, ranking_metrics, recall_at_k
from recspark.operators.profile import interaction_stats, suitability
from recspark.operators.statistics import (kl_score, ks_statistic, multiclass_metrics,
                                           ranking_curve_areas, regression_metrics)

SCHEMA = "user_idx bigint, item_idx bigint, relevance double, rank bigint, response bigint, revenue double"


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame([
        (1, 1, 0.9, 1, 0, 0.0), (1, 2, 0.8, 2, 1, 10.0), (1, 3, 0.7, 3, 1, 20.0),
        (2, 1, 0.9, 1, 1, 5.0),
        (3, 1, 0.9, 1, 0, 0.0), (3, 2, 0.8, 2, 0, 0.0), (3, 3, 0.7, 3, 1, 7.0)], SCHEMA)


def test_ranking_metrics(lists):
    m = ranking_metrics(lists, 2).first()
    assert m["precision_at_k"] == pytest.approx((1 / 2 + 1 + 0) / 3, abs=1e-6)
    # user 3 has no hit among the first two and does not enter NDCG
    assert m["ndcg_at_k"] == pytest.approx((1 / math.log2(3) + 1) / 2, abs=1e-6)
    assert m["mrr"] == pytest.approx((1 / 2 + 1 + 1 / 3) / 3, abs=1e-6)
    assert m["hit_rate"] == pytest.approx(2 / 3, abs=1e-6)
    assert m["discounted_revenue"] == pytest.approx(10 / math.log2(3) + 5, abs=1e-4)
    assert m["revenue"] == 42.0
    assert m["conversion_rate"] == pytest.approx(4 / 7, abs=1e-6)
    assert m["geometric_dcg"] == pytest.approx((0.9 + 0.8 * 0.85 + 0.9 + 0.9 + 0.8 * 0.85) / 3, abs=1e-6)


def test_precision_over_k(lists):
    assert ranking_metrics(lists, 2, denominator="k").first()["precision_at_k"] == pytest.approx(1 / 3, abs=1e-6)


def test_empty_lists(spark):
    m = ranking_metrics(spark.createDataFrame([], SCHEMA), 5).first()
    assert m["revenue"] == 0.0 and m["ndcg_at_k"] == 0.0


def test_long_metrics(lists):
    wide = ranking_metrics(lists, 2).withColumn("model", F.lit("m"))
    rows = {r["metric"]: r["value"] for r in metrics_long(wide, ["model"]).collect()}
    assert rows["revenue"] == 42.0 and len(rows) == 6


def test_recall(spark, lists):
    truth = spark.createDataFrame([(1, 2), (1, 9), (4, 1)], "user_idx bigint, item_idx bigint")
    assert recall_at_k(lists, truth, 2).first()["recall_at_k"] == pytest.approx(0.25)


def test_ks(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i + 100)) for i in range(50)], "a double, b double, c double")
    assert ks_statistic(df, "a", "b").first()["ks"] == 0.0
    assert ks_statistic(df, "a", "c").first()["ks"] == 1.0


def test_kl(spark):
    df = spark.createDataFrame([(float(i), float(i), 3.0) for i in range(50)], "a double, b double, c double")
    assert kl_score(df, "b", "a").first()["kl_score"] == pytest.approx(1.0)
    assert kl_score(df, "a", "c").first()["kl_score"] < 1  # a constant truth still has bins


def test_areas_match_mllib(spark):
    rows = [(i % 7 / 7.0, float((i * 5) % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "score double, label double")
    got = ranking_curve_areas(df, "score", "label").first()
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    for ours, theirs in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
        assert got[ours] == pytest.approx(judge.setMetricName(theirs).evaluate(df), abs=1e-6)


def test_regression_and_classes_match_mllib(spark):
    rows = [(float(i % 3), float((i * i) % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "p double, y double")
    got, judge = regression_metrics(df, "p", "y").first(), RegressionEvaluator(predictionCol="p", labelCol="y")
    for name in ("rmse", "mse", "mae", "r2", "var"):
        assert got[name] == pytest.approx(judge.setMetricName(name).evaluate(df), abs=1e-6)
    got, judge = multiclass_metrics(df, "p", "y").first(), MulticlassClassificationEvaluator(predictionCol="p", labelCol="y")
    for ours, theirs in (("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("hamming_loss", "hammingLoss"),
                         ("weighted_fpr", "weightedFalsePositiveRate")):
        assert got[ours] == pytest.approx(judge.setMetricName(theirs).evaluate(df), abs=1e-6)


def test_similarities(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]),
                                (None, [1.0, 1.0])], "a array<double>, b array<double>")
    rows = df.select(cosine("a", "b"), angular("a", "b")).collect()
    assert [tuple(round(x, 6) for x in r) for r in rows] == [(0.0, 0.5), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_utility(spark):
    p, x = 0.3, 950.0
    want = (math.sin(p) + 1) * math.exp(p - 1) * math.log1p(x) * math.cos(x / 100) * (1 + math.tan(p * math.pi / 4))
    assert spark.range(1).select(utility(F.lit(p), F.lit(x))).first()[0] == pytest.approx(want)


def test_suitability(spark):
    log = spark.createDataFrame([(u, i) for u in range(4) for i in range(3)], "user_idx bigint, item_idx bigint")
    row = suitability(interaction_stats(log)).first()
    assert row["rating"] == "Good" and row["unique_items"] == 3 and row["max_per_user"] == 3
