"""Log appends, schemas, streams and synthetic tables."""

import pytest
from pyspark.sql import functions as F

from recspark.functions.stages import AngularStage, ConstantStage, NoiseStage, ParametricStage
from recspark.plans.synth import aligned_feedback, copula_table, like_strata, strata_moments
from recspark.sources.tables import RECS, IterationLog, check_schema, from_rows, interaction_schema
from recspark.streaming.incremental import append_stream, file_stream, latest_stats, maintain_item_stats

SCHEMA = "user_idx bigint, item_idx bigint, relevance bigint"


def test_log_appends(spark, tmp_path):
    log = IterationLog(spark, str(tmp_path / "log"))
    assert log.read() is None
    first = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], SCHEMA)
    log.append(first, "start")
    log.append(first.select("relevance", "item_idx", "user_idx"), "train_0")  # order does not matter
    assert log.read().count() == 4
    with pytest.raises(ValueError):
        log.append(first, "start")
    with pytest.raises(ValueError):
        log.append(first.withColumn("relevance", F.lit(0.5)), "train_1")
    log.append(first.limit(1), "train_0", replace=True)
    assert {r["__iter"]: r["count"] for r in log.read().groupBy("__iter").count().collect()} == {"start": 2, "train_0": 1}
    assert log.of_users(first.filter("user_idx = 2")).count() >= 1
    assert dict(log.read().dtypes)["__iter"] == "string"
    log.clear()
    assert log.read() is None


def test_partitions_are_pruned(spark, tmp_path):
    log = IterationLog(spark, str(tmp_path / "log"))
    df = spark.createDataFrame([(1, 1, 1)], SCHEMA)
    for name in ("a", "b"):
        log.append(df, name)
    plan = log.read().filter("__iter = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__iter" in plan


def test_schemas(spark):
    assert [f.name for f in interaction_schema().fields] == ["user_idx", "item_idx", "timestamp", "relevance"]
    assert len(RECS.fields) == 3
    with pytest.raises(ValueError):
        check_schema(RECS, interaction_schema())
    with pytest.raises(ValueError):
        from_rows(spark, [], None)


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    rows = [(u, u % 3, u % 2) for u in range(20)]
    spark.createDataFrame(rows[:10], SCHEMA).write.parquet(str(folder))
    schema = spark.read.parquet(str(folder)).schema
    stats, progress = str(tmp_path / "stats"), str(tmp_path / "progress")
    maintain_item_stats(file_stream(spark, str(folder), schema), stats, progress)
    spark.createDataFrame(rows[10:], SCHEMA).write.mode("append").parquet(str(folder))
    maintain_item_stats(file_stream(spark, str(folder), schema), stats, progress)  # picks up where it stopped
    got = {r["item_idx"]: (r["pos"], r["total"]) for r in latest_stats(spark, stats).collect()}
    want = {i: (sum(r for _, j, r in rows if j == i), sum(1 for _, j, _ in rows if j == i)) for i in range(3)}
    assert got == want
    append_stream(file_stream(spark, str(folder), schema), str(tmp_path / "log"), "s", str(tmp_path / "p2"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 20


def test_synthetic_tables(spark):
    rows = [(i, "ab"[i % 2] if i < 4000 else None, 10.0 * (i % 2) + i % 5, None) for i in range(5000)]
    df = spark.createDataFrame(rows, "user_idx long, kind string, x double, y double").repartition(6)
    moments = {r.kind: r for r in strata_moments(df, "kind", ["x", "y"]).collect()}
    assert [(moments[k].n, moments[k].first_id, moments[k].last_id) for k in (None, "a", "b")] == [(1000, 0, 999), (2000, 1000, 2999), (2000, 3000, 4999)]
    assert (moments["a"].mean_x, moments["b"].mean_x) == (2.0, 12.0) and moments["a"].std_x == pytest.approx(2 ** 0.5, abs=1e-6)
    fake = like_strata(df, "user_idx", "kind", ["x", "y"])
    assert sorted(map(tuple, fake.collect()), key=str) == sorted(map(tuple, like_strata(df.repartition(2), "user_idx", "kind", ["x", "y"]).collect()), key=str)
    found = {r.kind: r for r in fake.groupBy("kind").agg(F.count("*").alias("n"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.count("y").alias("y")).collect()}
    assert {k: r.n for k, r in found.items()} == {"a": 2000, "b": 2000, None: 1000} and all(r.y == 0 for r in found.values())
    assert found["a"].m == pytest.approx(2, abs=0.15) and found["b"].m == pytest.approx(12, abs=0.15) and found["b"].s == pytest.approx(2 ** 0.5, abs=0.1)
    assert like_strata(df.limit(0), "user_idx", "kind", ["x"]).count() == 0
    users = spark.createDataFrame([(1, 0.0), (2, 10.0)], "user_idx long, x double")
    items = spark.createDataFrame([(5, 0.0), (6, 10.0)], "item_idx long, x double")
    pairs = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 6), (2, 5), (9, 5)], "user_idx long, item_idx long")
    assert {tuple(r) for r in aligned_feedback(pairs, users, items, "x", "x").collect()} == {(1, 5, 1), (1, 6, 0), (2, 6, 1), (2, 5, 0)}


def test_copula_keeps_margins_and_correlation(spark):
    from recspark.functions.draws import normal
    df = spark.range(3000).select("id", normal("a", "id").alias("x")).withColumn(
        "y", F.exp(F.col("x")) + normal("b", "id", std=0.1))
    fake = copula_table(df, "id", ["x", "y"])
    assert sorted(r["y"] for r in fake.collect()) == sorted(r["y"] for r in df.collect())
    ranked = fake.agg(F.corr("x", F.log(F.greatest(F.col("y"), F.lit(0.01))))).first()[0]
    assert ranked > 0.8


def test_stages(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0, 0.0], [1.0, 0.0], 2.0)], "id bigint, a array<double>, b array<double>, x double")
    out = AngularStage(left="a", right="b", outputCol="s").transform(df)
    out = ParametricStage(columns=["s", "x"], weights=[1.0, 0.5], outputCol="w").transform(out)
    out = ConstantStage(outputCol="c", constant=0.25).transform(out)
    row = NoiseStage(outputCol="n", salt="z", keys=["id"], mu=-9.0, sigma=0.1).transform(out).first()
    assert (row["s"], row["w"], row["c"], row["n"]) == (1.0, 2.0, 0.25, 0.0)
    stage = NoiseStage(outputCol="n", salt="z", keys=["id"], mu=1.0, sigma=0.1)
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = NoiseStage.load(str(tmp_path / "stage"))
    assert again.transform(df).first()["n"] == stage.transform(df).first()["n"]
