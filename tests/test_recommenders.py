"""Recommender contract, edge cases and hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from recspark.operators.lists import draw_responses, enrich, training_log
from recspark.operators.blocks import block_best, block_top_k
from recspark.recommenders import (BanditRecommender, ContentRecommender, HybridRecommender,
                                   KernelRecommender, LinearRecommender, PopularityRecommender, RandomRecommender)
from recspark.recommenders import linear, shared_score


@pytest.fixture(scope="module")
def world(spark):
    users = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "b")], "user_idx bigint, segment string")
    items = spark.createDataFrame([(i, "x" if i < 3 else "y", 10.0 + i, float(i), 1.0) for i in range(6)],
                                  "item_idx bigint, category string, price double, item_attr_0 double, item_attr_1 double")
    # user 2 has seen everything, user 3 nothing
    rows = [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 2, 1)] + [(2, i, i % 2) for i in range(6)]
    log = spark.createDataFrame(rows, "user_idx bigint, item_idx bigint, relevance bigint")
    return log, users, items


def _by_user(recs):
    out = {}
    for r in recs.collect():
        out.setdefault(r["user_idx"], []).append((r["rank"], r["item_idx"]))
    return {u: sorted(v) for u, v in out.items()}


def _popularity(log):
    pos, n = {}, {}
    for u, i, r in log:
        pos[i], n[i] = pos.get(i, 0) + r, n.get(i, 0) + 1
    return {i: (pos.get(i, 0) + 1) / (n.get(i, 0) + 2) for i in range(6)}


@pytest.mark.parametrize("head", ["broadcast", "shuffled"])
def test_popularity(world, monkeypatch, head):
    """Both ways to use the head of the catalogue give the brute-force answer."""
    if head == "shuffled":
        monkeypatch.setattr(shared_score, "BROADCAST_ROWS", 0)
    log, users, items = world
    rows = [tuple(r) for r in log.collect()]
    score = _popularity(rows)
    got = _by_user(PopularityRecommender().fit(log).predict(log, 3, users, items))
    for u in range(4):
        seen = {i for w, i, _ in rows if w == u}
        want = sorted((i for i in range(6) if i not in seen), key=lambda i: (-score[i], i))[:3]
        assert [i for _, i in got.get(u, [])] == want
    assert 2 not in got


def test_bandit_scores(world):
    log, users, items = world
    model = BanditRecommender().fit(log)
    scores = {r["item_idx"]: r["relevance"] for r in model.item_scores(items).collect()}
    assert scores[0] == pytest.approx(2 / 3 + math.sqrt(math.log(2 * 10) / 3))
    with pytest.raises(ValueError):
        BanditRecommender().fit(log.withColumn("relevance", F.lit(2)))
    BanditRecommender().fit(log.withColumn("relevance", F.lit(None).cast("bigint")))


def test_bandit_on_cold_item(spark, world):
    log, users, items = world
    more = items.select("item_idx", "price").unionByName(spark.createDataFrame([(99, 5.0)], "item_idx bigint, price double"))
    scores = {r["item_idx"]: r["relevance"] for r in BanditRecommender().fit(log).item_scores(more).collect()}
    assert scores[99] == pytest.approx(1 + math.sqrt(math.log(20)))


def test_random_never_repeats_or_shows_seen_items(spark, world):
    log, users, items = world
    for seed in range(3):
        got = _by_user(RandomRecommender(seed).predict(log, 5, users, items))
        assert 2 not in got
        assert [r for r, _ in got[0]] == [1, 2, 3, 4] and {i for _, i in got[0]} == {2, 3, 4, 5}
        assert len({i for _, i in got[3]}) == 5


def test_random_is_uniform(spark):
    users = spark.range(6000).withColumnRenamed("id", "user_idx")
    items = spark.range(6).withColumnRenamed("id", "item_idx")
    log = users.select("user_idx", F.lit(2).cast("bigint").alias("item_idx"))
    recs = RandomRecommender(1).predict(log, 2, users, items)
    counts = {r["item_idx"]: r["count"] for r in recs.groupBy("item_idx").count().collect()}
    assert set(counts) == {0, 1, 3, 4, 5}
    assert all(abs(c - 2400) < 200 for c in counts.values())
    # the larger of five uniforms averages 5/6
    assert recs.filter("rank = 1").agg(F.avg("relevance")).first()[0] == pytest.approx(5 / 6, abs=0.01)


def test_content_profile_and_cold_user(world):
    log, users, items = world
    model = ContentRecommender().fit(log, users, items)
    profile = {r["user_idx"]: r for r in model.profiles.collect()}
    assert profile[1]["vec"] == pytest.approx([1.0, 1.0]) and profile[1]["interactions"] == 2
    got = _by_user(model.predict(log, 3, users, items, item_features=items))
    assert len(got[3]) == 3 and 2 not in got  # random for the user without a profile
    assert {i for _, i in got[1]} <= {1, 3, 4, 5}


def test_zero_relevance_profile_is_zero(spark, world):
    _, users, items = world
    log = spark.createDataFrame([(0, 1, 0)], "user_idx bigint, item_idx bigint, relevance bigint")
    model = ContentRecommender().fit(log, users, items)
    assert model.profiles.first()["vec"] == [0.0, 0.0]
    got = _by_user(model.predict(log, 2, users.filter("user_idx = 0"), items, item_features=items))
    assert [i for _, i in got[0]] == [0, 2]


def test_hybrid_weights(world):
    log, users, items = world
    model = HybridRecommender([PopularityRecommender(), PopularityRecommender()], [3, 1])
    assert model.weights == [0.75, 0.25]
    got = _by_user(model.fit(log).predict(log, 2, users, items))
    alone = _by_user(PopularityRecommender().fit(log).predict(log, 2, users, items))
    assert {u: [i for _, i in v] for u, v in got.items()} == {u: [i for _, i in v] for u, v in alone.items()}


def test_logistic_matches_direct_scoring(world):
    log, users, items = world
    model = LinearRecommender().fit(log, users, items)
    coef, bias = model.model.coefficients.toArray(), model.model.intercept
    recs = {(r["user_idx"], r["item_idx"]): r["relevance"] for r in
            model.predict(None, 6, users, items, user_features=users).collect()}
    assert len(recs) == 24
    for u in users.collect():
        for i in items.collect():
            x = [float(u["segment"] == s) for s in model.segments] + [float(i["category"] == c) for c in model.categories]
            x.append((i["price"] - model.mean) / model.std)
            z = sum(a * b for a, b in zip(coef, x)) + bias
            assert recs[u["user_idx"], i["item_idx"]] == pytest.approx(i["price"] / (1 + math.exp(-z)), abs=1e-5)


def test_empty_log(spark, world):
    log, users, items = world
    empty = log.filter("user_idx < 0")
    got = _by_user(PopularityRecommender().fit(empty).predict(empty, 2, users, items))
    assert all(v == [(1, 0), (2, 1)] for v in got.values()) and len(got) == 4


def test_responses_and_columns(spark, world):
    log, users, items = world
    recs = PopularityRecommender().fit(log).predict(log, 3, users, items)
    once = draw_responses(enrich(recs, users, items)).select("user_idx", "item_idx", "response", "revenue", "price")
    again = draw_responses(enrich(recs.repartition(5), users, items)).select("user_idx", "item_idx", "response", "revenue", "price")
    assert sorted(once.collect()) == sorted(again.collect())
    assert all(r["revenue"] == r["response"] * r["price"] for r in once.collect())
    assert "response" not in training_log(once.withColumn("relevance", F.lit(0.3))).columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_head_of_a_long_catalogue(spark, by, monkeypatch):
    """The first positions with ties, nulls and not-a-number, without a task that takes all items."""
    rows = [(i, i % 2, None if i % 97 == 0 else float("nan") if i % 89 == 0 else (i * 37 % 1000 if i < 9000 else 500) / 7) for i in range(12_000)]
    scores = spark.createDataFrame(rows, "item_idx long, g int, relevance double")
    plans = []
    real = shared_score.cut
    monkeypatch.setattr(shared_score, "cut", lambda df: plans.append(_plan(df)) or real(df))
    for reach in (1, 5000, 20_000):
        head = shared_score.catalogue_head(scores, reach, by)
        got = {(r.g if by else 0, r.pos): r.item_idx for r in head.collect()}
        want = {}
        for g in ([0, 1] if by else [0]):
            own = [r for r in rows if not by or r[1] == g]
            own.sort(key=lambda r: (r[2] is None, 0 if r[2] is None else -float("inf") if r[2] != r[2] else -r[2], r[0]))
            want.update({(g, n): r[0] for n, r in enumerate(own[:reach])})
        assert got == want
    assert not any("SinglePartition" in p and "relevance" in p.split("SinglePartition")[1].split("\n")[0] for p in plans)
    assert "SinglePartition" not in _plan(head)
    assert shared_score.catalogue_head(scores.limit(0), 5, by).count() == 0
    same = shared_score.catalogue_head(scores.withColumn("relevance", F.lit(0.5)), 3)
    assert sorted((r.pos, r.item_idx) for r in same.collect()) == [(0, 0), (1, 1), (2, 2)]


def test_backtest_histories_of_reachable_items(spark, monkeypatch):
    """Only items of some head are looked up in histories; lists are those of all histories."""
    from recspark.plans import backtest as plans
    rows = [(u, (u * 7 + t * 3) % 60, (u + t) % 2, 1.0, f"p{t % 4}") for u in range(12) for t in range(8)] + [(1, None, 1, 1.0, "p0")]
    log = spark.createDataFrame(rows, "user_idx long, item_idx long, relevance long, amount double, iter string")
    items = spark.createDataFrame([(i, float(i)) for i in range(60)], "item_idx long, price double")
    plan = plans.walk_forward(plans.periods(log))
    heads, real = [], plans.recommend_by_score

    def watched(scores, who, seen, *args, **kwargs):
        return real(scores, who, lambda head: heads.append(head) or seen(head), *args, **kwargs)
    monkeypatch.setattr(plans, "recommend_by_score", watched)
    few = sorted(map(repr, plans.backtest_lists(log, items, plan, 3).collect()))
    assert 0 < heads[0].count() < 60
    monkeypatch.setattr(shared_score, "BROADCAST_ROWS", 0)
    assert few == sorted(map(repr, plans.backtest_lists(log, items, plan, 3).collect()))
    assert heads[1] is None and few


def test_feature_rows_are_joined_once(spark, sf):
    """A pipeline reads its rows once for each indexer, fit and transform; none of these repeats the joins."""
    from recspark.queries.models import _rows
    rows = _rows(spark, sf)
    assert rows.count() > 0
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("model", [LinearRecommender, KernelRecommender])
def test_classifiers_score_once_per_segment(spark, world, monkeypatch, model):
    log, users, items = world
    asked = []

    def watched(left, right, *args, **kwargs):
        asked.append(left.count())
        return block_best(left, right, *args, **kwargs)

    monkeypatch.setattr(linear, "block_best", watched)
    more = users.unionByName(spark.createDataFrame([(i, "c") for i in range(10, 60)] + [(0, "a"), (60, None)], users.schema))
    # of an item that comes twice, a history takes the first place
    twice = items.unionByName(items.where("item_idx = 1"))
    fitted = model().fit(log, users, items)
    got = {}
    for r in fitted.predict(log, 3, more, twice, user_features=more).orderBy("user_idx", "rank").collect():
        got.setdefault(r.user_idx, []).append((r["rank"], r.item_idx, round(r.relevance, 5)))
    assert asked == [3]  # two segments and any other
    left, right = fitted._sides(more, twice)
    expected = {}
    for r in block_top_k(left, right, 3, fitted.score, log.select("user_idx", "item_idx").toDF("user", "item"), digits=6).orderBy("user", "rank").collect():
        expected.setdefault(r.user, []).append((r["rank"], r.item, round(r.score, 5)))
    assert got == expected and len(got) == 55
