"""Skew-safe operators against brute force on small tables, with tiny chunks and buckets."""

import random
from unittest.mock import Mock

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recspark.functions.draws import uniform
from recspark.operators import blocks
from recspark.operators.blocks import block_top_k
from recspark.operators.joins import grouped_sums, salted_join, wide_join
from recspark.operators.ordering import rank_in_key, running_totals, with_position, with_previous
from recspark.operators.sampling import (SeedSequence, composite_rows, exact_rows, negative_pairs, own_items, quota_sample,
                                         quotas, require_rows, shared_items, shares)
from recspark.operators.unseen import unseen_positions
from recspark.operators.weighted import weighted_draw


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows, half of them under one key."""
    rng = random.Random(1)
    rows = [(0 if i % 2 else rng.randrange(9), rng.randrange(40), i) for i in range(300)]
    return spark.createDataFrame(rows, "k bigint, v bigint, id bigint").cache()


def test_positions_are_dense_and_ordered(skewed):
    rows = with_position(skewed, ["v", "id"]).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(300))
    assert [(r["v"], r["id"]) for r in rows] == sorted((r["v"], r["id"]) for r in rows)


@pytest.mark.parametrize("chunk", [7, 1000])
def test_rank_in_key_equals_window(skewed, chunk):
    got = rank_in_key(skewed, ["k"], ["v", "id"], chunk_rows=chunk)
    want = skewed.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("chunk", [7, 1000])
def test_running_totals_equal_window(skewed, chunk):
    got = running_totals(skewed, ["v", "id"], {"s": "k"}, chunk_rows=chunk)
    w = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum("k").over(w))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("chunk", [3, 7, 1000])
def test_previous_equals_lag(skewed, chunk):
    got = with_previous(skewed, ["k"], ["id"], "v", 3, chunk_rows=chunk)
    w = Window.partitionBy("k").orderBy("id")
    want = skewed
    for i in (1, 2, 3):
        want = want.withColumn(f"prev_{i}", F.lag("v", i).over(w))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("width", [2, 5, 4096])
def test_unseen_positions(spark, width):
    rng = random.Random(2)
    seen = {u: sorted(rng.sample(range(30), n)) for u, n in ((1, 0), (2, 1), (3, 12), (4, 29), (5, 30))}
    seen[6] = list(range(10))
    pairs = [(u, p) for u, ps in seen.items() for p in ps] * 2  # repeats do not matter
    wanted = [(u, r) for u in seen for r in range(30)]
    got = unseen_positions(spark.createDataFrame(pairs, "user bigint, pos bigint"),
                           spark.createDataFrame(wanted, "user bigint, nth bigint"), ["user"], width=width)
    result = {(r["user"], r["nth"]): r["pos"] for r in got.collect()}
    assert len(result) == len(wanted)
    for u, ps in seen.items():
        free = [p for p in range(200) if p not in ps]
        assert [result[u, r] for r in range(30)] == free[:30]


def test_unseen_positions_of_one_bucket(spark):
    seen = spark.createDataFrame([(1, p) for p in (0, 1, 5, 5)] + [(2, 3), (None, 2)], "user bigint, pos bigint")
    wanted = spark.createDataFrame([(u, r) for u in (1, 2, 3, None) for r in range(6)], "user bigint, nth bigint")
    split, whole = (unseen_positions(seen, wanted, ["user"], one_bucket=one) for one in (False, True))
    assert split.columns == whole.columns
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") < split._jdf.queryExecution().executedPlan().toString().count("Join")


@pytest.mark.parametrize("rows", [5, 4096])
@pytest.mark.parametrize("metric", ["dot", "cosine", "euclidean", "manhattan"])
def test_block_top_k_equals_brute_force(spark, metric, rows):
    rng = np.random.default_rng(3)
    u, v = rng.normal(size=(13, 4)), rng.normal(size=(17, 4))
    u[0] = 0  # a zero vector ties everywhere under dot and cosine
    v[5] = v[6]
    seen = [(i, j) for i in range(13) for j in range(17) if (i * j) % 5 == 1] + [(2, j) for j in range(17)]
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user bigint, vec array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item bigint, vec array<double>")
    got = block_top_k(users, items, 4, metric, spark.createDataFrame(seen, "user bigint, item bigint"),
                      block_rows=rows)

    def score(a, b):
        if metric == "dot":
            return a @ b
        if metric == "cosine":
            n = np.linalg.norm(a) * np.linalg.norm(b)
            return a @ b / n if n else 0.0
        return -np.linalg.norm(a - b, 2 if metric == "euclidean" else 1)

    want = []
    for i in range(13):
        ranked = sorted((-round(score(u[i], v[j]), 9), j) for j in range(17) if (i, j) not in set(seen))
        want += [(i, j, rank + 1) for rank, (_, j) in enumerate(ranked[:4])]
    assert sorted((r["user"], r["item"], r["rank"]) for r in got.collect()) == sorted(want)


def test_salted_join_keeps_every_row(spark, skewed):
    small = spark.createDataFrame([(k, k * 10) for k in range(5)], "k bigint, w bigint")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = salted_join(skewed, small, ["k"], ["id"], how)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, skewed.join(small, ["k"], how).select(*got.columns).collect()))


def test_salted_join_never_broadcasts_the_copies(spark, skewed, tmp_path):
    """The file is far below the broadcast threshold; sixteen copies of its rows need not be."""
    spark.range(50_000).select(F.col("id").alias("k"), F.lit("BUILDING").alias("w")).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = salted_join(skewed, small, ["k"], ["id"], how)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert salted_join(skewed, small, ["k"], ["id"]).where("w = 'BUILDING'").count() == skewed.count()


@pytest.mark.parametrize("heavy_rows", [20, 1000])
def test_wide_joins_and_sums_equal_plain_ones(spark, skewed, heavy_rows):
    small = spark.createDataFrame([(k, [k * 1.0, k * 10.0]) for k in range(5)], "k bigint, vec array<double>")
    rows = skewed.unionByName(spark.createDataFrame([(None, 1, 1000), (3, None, 1001), (3, None, 1002)], skewed.schema))
    got = wide_join(rows, small, ["k"], ["id"], heavy_rows=heavy_rows)
    plain = rows.join(small, ["k"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    sums = [F.expr("sum(vec[1]) AS d0"), F.sum("id").alias("n")]
    got = grouped_sums(wide_join(rows, small, ["k"], ["id"], heavy_rows=heavy_rows), "v", sums, rows, ["id"], heavy_rows // 10)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.groupBy("v").agg(*sums).collect()))


def test_vectors_meet_their_rows_in_rounds(spark, monkeypatch):
    from recspark.operators import graph, joins
    from recspark.recommenders.content import user_profiles
    random.seed(4)
    log = spark.createDataFrame([(i % 31, random.randrange(40), i % 2) for i in range(600)], "user_idx bigint, item_idx bigint, relevance bigint")
    sides = [spark.createDataFrame([(i, [random.random() for _ in range(3)]) for i in range(n)], f"{key} bigint, vec array<double>")
             for key, n in (("user_idx", 35), ("item_idx", 40))]

    def results():
        users, items = graph.propagate(log, *sides, 3)
        alone, none = graph.propagate(log, *sides, 3, both=False)
        assert none is None
        return [sorted((r[0], *(round(x, 9) for x in r["vec"])) for r in t.collect())
                for t in (user_profiles(log, sides[1], 3), users, items, alone)]

    whole = results()
    monkeypatch.setattr(joins, "ROUND_ROWS", 100)
    monkeypatch.setattr(joins, "stored", written := Mock(wraps=joins.stored))
    assert results() == whole and [len(x) for x in whole] == [31, 35, 40, 35] and whole[1] == whole[3]
    assert [c.args[1] for c in written.call_args_list].count("round") >= 8 * 4


def test_profiles_ship_vectors_once_per_pair(spark):
    """Neither copies of all vectors nor partial sums of single pairs are dealt."""
    from recspark.recommenders.content import user_profiles
    log = spark.range(3000).selectExpr("id % 97 AS user_idx", "id % 41 AS item_idx", "id % 2 AS relevance")
    vectors = spark.range(41).selectExpr("id AS item_idx", "array(float(id), float(1)) AS vec")
    got = user_profiles(log, vectors, 2)
    assert got.count() == 97 and got.agg(F.sum("interactions")).first()[0] == 3000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "repartition" in plan.lower() and "sequence(0, 15" not in plan
    # weight 0 keeps an item out of a profile, unless its vector is not finite
    rows = spark.createDataFrame([(1, 1, 0), (1, 2, 2), (2, 1, 0), (3, 3, 0), (3, 2, 1)], "user_idx bigint, item_idx bigint, relevance bigint")
    odd = spark.createDataFrame([(1, [5.0, None]), (2, [1.0, 2.0]), (3, [float("nan"), 7.0])], "item_idx bigint, vec array<double>")
    assert {r["user_idx"]: (str(r["vec"]), r["interactions"]) for r in user_profiles(rows, odd, 2).collect()} == {
        1: ("[1.0, 2.0]", 2), 2: ("[0.0, 0.0]", 1), 3: ("[nan, 2.0]", 2)}


def test_draws_do_not_depend_on_layout(spark):
    base = spark.range(5000).withColumn("u", uniform("x", "id"))
    other = spark.range(5000).repartition(7).withColumn("u", uniform("x", "id"))
    assert sorted(base.collect()) == sorted(other.collect())
    stats = base.agg(F.avg("u"), F.var_samp("u"), F.min("u"), F.max("u")).first()
    assert abs(stats[0] - 0.5) < 0.02 and abs(stats[1] - 1 / 12) < 0.005
    assert 0 < stats[2] and stats[3] < 1


def test_weighted_draw_follows_the_weights(spark):
    users = spark.range(4000).select(F.col("id").alias("user_idx"), F.lit(1).cast("bigint").alias("n"))
    weights = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 5.0)], "item_idx bigint, weight double")
    counts = {r["item_idx"]: r["n"] for r in weighted_draw(users, weights, 5).groupBy("item_idx").agg(
        F.count("*").alias("n")).collect()}
    for item, share in ((0, 1 / 8), (1, 2 / 8), (2, 5 / 8)):
        assert abs(counts[item] / 4000 - share) < 0.03


def test_weighted_draw_lengths(spark):
    users = spark.createDataFrame([(1, 0), (2, 2), (3, 3)], "user_idx bigint, n bigint")
    weights = spark.createDataFrame([(i, 1.0 + i) for i in range(3)], "item_idx bigint, weight double")
    rows = weighted_draw(users, weights, 5, block_rows=2).collect()
    assert sorted((r["user_idx"], r["rank"]) for r in rows) == [(2, 1), (2, 2), (3, 1), (3, 2), (3, 3)]
    assert len({(r["user_idx"], r["item_idx"]) for r in rows}) == 5


def test_samples(spark):
    df = spark.range(100)
    assert exact_rows(df, 17, 1, ["id"]).count() == 17
    with pytest.raises(ValueError):
        exact_rows(df, 101, 1, ["id"])
    with pytest.raises(ValueError):
        require_rows(df.filter("id < 0"))
    seeds = SeedSequence(42)
    assert seeds.next() != seeds.next() and SeedSequence(42).next() == "42.1"


def test_exact_sample_takes_the_smallest_draws(spark, monkeypatch):
    from recspark.operators import sampling
    monkeypatch.setattr(sampling, "DRAW_BUCKETS", 4)
    rows = spark.range(50).withColumn("u", uniform("exact.1", "id")).orderBy("u").collect()
    for n in (0, 1, 13, 50):
        got = exact_rows(spark.range(50), n, 1, ["id"]).collect()
        assert sorted(r["id"] for r in got) == sorted(r["id"] for r in rows[:n])


def test_quotas_sum_exactly(spark):
    df = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(100)], "s string, id bigint")
    quota = quotas(shares(df, "s"), "s", 37)
    assert sum(r["quota"] for r in quota.collect()) == 37
    got = {r["s"]: r["count"] for r in quota_sample(df, "s", quota, 1, ["id"]).groupBy("s").count().collect()}
    assert got == {r["s"]: r["quota"] for r in quota.collect()}


def test_composite_sample_checks_sizes(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(90)], "s string, id bigint")
    with pytest.raises(ValueError):
        composite_rows(df, "s", 0.9, {"a": 0.9, "b": 0.1}, 1, ["s", "id"])
    got = composite_rows(df, "s", 0.5, {"a": 0.1, "b": 0.9}, 1, ["s", "id"]).count()
    assert 25 < got < 75


def test_item_selectors(spark):
    users = spark.range(6).withColumnRenamed("id", "user_idx")
    items = spark.range(20).withColumnRenamed("id", "item_idx")
    shared = shared_items(users, items, 4, 1).collect()
    assert len(shared) == 24 and len({r["item_idx"] for r in shared}) == 4
    own = own_items(users, items, 4, 1).collect()
    assert len(set(own)) == 24 and len({r["item_idx"] for r in own}) > 4
    with pytest.raises(ValueError):
        shared_items(users, items.withColumnRenamed("item_idx", "x"), 4, 1)


def test_stored_tables_keep_rows(spark):
    from recspark.operators.durable import cut, stored
    rows = [(1, "a", [1, 2]), (1, "a", [1, 2]), (2, None, None)]
    table = spark.createDataFrame(rows, "k long, t string, v array<long>")
    for keep in (cut, stored):
        assert sorted(map(tuple, keep(table).collect()), key=str) == sorted(rows, key=str)
        assert keep(table.where("k > 5")).schema.names == ["k", "t", "v"]
        assert keep(table.where("k > 5")).count() == 0


def test_purchase_lists_keep_every_item(spark):
    """Sixty items of one user: all of them by default, the first k on request."""
    from recspark.operators.lists import purchase_lists
    log = spark.createDataFrame([(1, i, i % 2, float(i)) for i in range(60)] + [(2, 5, 1, 1.0), (None, 7, 0, 2.0)],
                                "user_idx bigint, item_idx bigint, relevance bigint, amount double")
    whole = {(r.user_idx, r.item_idx): r["rank"] for r in purchase_lists(log).collect()}
    assert whole == {(1, i): 60 - i for i in range(60)} | {(2, 5): 1, (None, 7): 1}
    assert purchase_lists(log, 5).count() == 7


def test_cross_counts_take_their_columns_from_the_data(spark):
    from recspark.operators.profile import cross_counts
    items = spark.createDataFrame([("b", "SMALL", 2), ("b", None, 3), ("c", "NEW", 4), ("c", "NEW", 5), (None, "SMALL", 6)], "brand string, category string, n bigint")
    got = cross_counts(items, "brand", "category")
    assert got.columns == ["brand", "NEW", "SMALL", "null"]
    assert {tuple(r) for r in got.collect()} == {("b", 0, 1, 1), ("c", 2, 0, 0), (None, 0, 1, 0)}
    assert {tuple(r) for r in cross_counts(items, "brand", "category", "n").collect()} == {("b", 0, 2, 3), ("c", 9, 0, 0), (None, 0, 6, 0)}


def test_running_totals_over_spans(spark, monkeypatch):
    """Sums carried over chunks and spans of chunks, without one task for all of them."""
    from decimal import Decimal
    from recspark.operators import ordering
    monkeypatch.setattr(ordering, "SPAN_CHUNKS", 3)
    rows = [(i, i % 5, None if i % 7 == 0 else 0.5 * i, Decimal(i) / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "i long, a long, b double, c decimal(10,2)").repartition(7)
    out = ordering.running_totals(df, ["i"], {"sa": "a", "sb": "b", "sc": "c"}, chunk_rows=4)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.i: (r.sa, r.sb, r.sc) for r in out.collect()}
    assert got == {n: (sum(r[1] for r in rows[:n + 1]), sum(r[2] or 0 for r in rows[:n + 1]), sum(r[3] for r in rows[:n + 1]))
                   for n in range(100)}
    assert ordering.running_totals(df.limit(0), ["i"], {"sa": "a"}).count() == 0


def test_cluster_search_is_exact_and_prunes(spark):
    from recspark.operators.blocks import block_top_k
    from recspark.operators.cluster_index import cluster_top_k
    random = np.random.default_rng(5)
    centres = random.normal(size=(30, 12))
    things = [(i, (centres[i % 30] + 0.1 * random.normal(size=12)).tolist()) for i in range(1500)]
    things += [(9000, [0.0] * 12), (9001, [0.0] * 12), *((9100 + i, [1.0] * 12) for i in range(6))]  # zeros and ties
    people = [(i, (centres[i % 30] + 0.2 * random.normal(size=12)).tolist()) for i in range(300)]
    items, users = spark.createDataFrame(things, "item long, vec array<double>"), spark.createDataFrame(people, "user long, vec array<double>")
    seen = spark.createDataFrame([(u, int(i)) for u in range(300) for i in random.integers(0, 1500, 20)] + [(7, 777_777), (3, 5), (3, 5)], "user long, item long")
    both = users.unionByName(spark.createDataFrame([(5000, [0.0] * 12)], users.schema))
    for who, k, hidden, threshold, block in ((users, 5, None, None, 48_000), (both, 7, seen, 0.3, 20), (users, 2000, seen, None, 400)):
        counters = {}
        found = cluster_top_k(who, items, k, hidden, threshold=threshold, cluster_rows=50, block_rows=block, counters=counters)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, block_top_k(who, items, k, "cosine", hidden, threshold=threshold).collect()))
        if k == 5:
            assert counters["visited"] < 0.2 * counters["all"]
    assert cluster_top_k(users, items.limit(0), 3).count() == 0
    assert cluster_top_k(users.limit(0), items, 3).count() == 0
    assert cluster_top_k(users, items.where("item in (9000, 9001)"), 3).count() == 600


def test_boosting_stops_where_rounds_alone_would(spark):
    """The kept rounds are those that an iteration-by-iteration run finds on the held-out rows."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from recspark.operators.boosting import HELD, boost_until_flat, with_held_out
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 4))
    rows = [(i, v.tolist(), float(v[0] + 0.4 * v[1] * v[1] + 1.2 * rng.normal() > 0.3)) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "id long, x array<double>, label double").coalesce(1)
    marked = with_held_out(table.withColumn("features", array_to_vector("x")), ["id"], 0.3, "t").cache()
    assert {r.id for r in marked.where(HELD).collect()} == {r.id for r in with_held_out(table.repartition(5), ["id"], 0.3, "t").where(HELD).collect()}
    model = boost_until_flat(marked, 25, tolerance=0.005, step=0.3)
    alone = GBTClassifier(maxDepth=3, maxIter=25, stepSize=0.3, seed=42).fit(marked.where(~F.col(HELD)))
    losses = alone.evaluateEachIteration(marked.where(HELD))
    best, rounds = losses[0], 1
    for number, loss in enumerate(losses[1:], 2):
        if best - loss < 0.005 * max(loss, 0.01):
            break
        if loss < best:
            best, rounds = loss, number
    assert 1 < rounds < 25 and model.getNumTrees == rounds
    with pytest.raises(ValueError):
        boost_until_flat(marked.where(~F.col(HELD)), 3)


def test_candidates_labels_and_composites(spark):
    from recspark.operators.sampling import candidates, composite_table, labelled_ids, shared_items
    users = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "user_idx long, kind string")
    items = spark.createDataFrame([(i,) for i in range(9)], "item_idx long")
    log = spark.createDataFrame([(1, 4), (1, 4), (7, 4)], "user_idx long, item_idx long")
    pairs, part = candidates(users.unionByName(users), items, log, lambda u, i: shared_items(u.distinct(), i, 2, 1))
    assert pairs.count() == 6 and sorted(map(tuple, part.collect())) == [(1, 4), (1, 4)]
    assert candidates(users, items, None, lambda u, i: u)[1] is None
    assert {r.user_idx for r in labelled_ids(users, "user_idx", "new").collect()} == {"new_1", "new_2", "new_3"}
    assert [r.user_idx for r in labelled_ids(users, "user_idx", "kind").orderBy("kind").collect()][0] is None
    many = spark.createDataFrame([(i, "x" if i < 80 else "y") for i in range(100)], "id long, s string")
    got = composite_table(many, "s", 50, "t", ["id"]).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"x": 40, "y": 10}
    even = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "s string, weight double")
    assert composite_table(many, "s", 40, "t", ["id"], even).count() == 40
    with pytest.raises(ValueError, match="too few"):
        composite_table(many, "s", 60, "t", ["id"], even)


def test_negative_pairs_are_compared_in_parts_by_counted_rows(spark, monkeypatch):
    from recspark.operators import sampling
    monkeypatch.setattr(sampling, "PAIR_ROWS", 50)
    log = spark.range(2_000).select((F.col("id") % 40).alias("user_idx"), (F.col("id") % 37).alias("item_idx"))  # pairs come twice
    log = log.union(spark.createDataFrame([(None, 1), (3, None)], "user_idx long, item_idx long"))
    items = spark.range(60).select(F.col("id").alias("item_idx"))
    found = negative_pairs(log, items, 7)
    assert found.rdd.getNumPartitions() == 41  # 2,002 rows, 50 a part, however narrow they are
    seen = {(r.user_idx, r.item_idx) for r in log.distinct().collect()}
    drawn = log.distinct().select("user_idx", F.floor(uniform("negative.7", "user_idx", "item_idx") * 60).alias("i")).collect()
    want = {(r.user_idx, r.i) for r in drawn} - seen
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_pairs_meet_their_vectors_last(spark, tmp_path):
    from recspark.functions.arrays import cosine
    from recspark.queries.expressions import _pair_vectors, cosine_similarity
    path = str(tmp_path)
    tables = {"customer": "SELECT id AS c_custkey, 'A' AS c_mktsegment, 0D AS c_acctbal, 1 AS c_nationkey FROM range(20)",
              "part": "SELECT id AS p_partkey, 't' AS p_type, 'b' AS p_brand, 1D AS p_retailprice, 1 AS p_size FROM range(30)",
              "orders": "SELECT id AS o_orderkey, id % 25 AS o_custkey, date'2020-01-01' AS o_orderdate FROM range(90)",
              "lineitem": "SELECT id % 90 AS l_orderkey, 1 AS l_linenumber, id % 33 AS l_partkey, 'N' AS l_returnflag,"
                          " 1D AS l_extendedprice, 0D AS l_discount FROM range(400)",
              "embeddings": "SELECT id AS vec_id, CASE id WHEN 3 THEN NULL WHEN 4 THEN array(0F, 0F) ELSE"
                            " array(cast(id - 2 AS float), 1F) END AS embedding FROM range(7)"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{path}/{name}.parquet")
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()}
    pairs = {(i % 90 % 25, i % 33) for i in range(400)}

    def similar(u, i):
        a, b = vectors[u * 7 % 7], vectors[i % 7]
        size = np.linalg.norm(a) * np.linalg.norm(b) if a and b else 0.0
        return round(float(np.dot(a, b) / size), 6) if size else 0.0
    want = sorted((u, i, similar(u, i)) for u, i in pairs if u < 20 and i < 30)
    assert sorted(map(tuple, cosine_similarity(spark, path).collect())) == want
    rows = _pair_vectors(spark, path)
    both = rows.select(cosine("a", "b").alias("x"), cosine("a", "b", "length_a", "length_b").alias("y"))
    assert both.where(~F.col("x").eqNullSafe(F.col("y"))).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _pair_vectors(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [x for x in plan.splitlines() if "Join Inner" in x]
    assert "__i" in joins[0] and "__u" in joins[1], plan  # the outermost joins are those with the vectors


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean", "manhattan"])
def test_block_kernel_scores_few_cells_in_full(monkeypatch, metric):
    """Single precision rules out nearly all cells, and the best ones are those of a full evaluation."""
    import pyarrow as pa
    from recspark.operators import blocks
    random = np.random.default_rng(9)
    vectors = random.normal(size=(9000, 16)) + 2.0
    vectors[5000:5040] = vectors[0]  # ties
    vectors[77] = 0.0
    people = np.concatenate([vectors[:3], random.normal(size=(400, 16)) + 2.0])
    items = pa.table({"item": np.arange(9000), "vec": vectors.tolist(), "extra": np.ones(9000)})
    hidden = [(u, int(i)) for u in range(403) for i in random.integers(0, 9000, 30)] + [(0, 0), (0, 5000), (999_999, 4)]
    users = pa.concat_tables([
        pa.table({"user": np.arange(403), "vec": people.tolist(), "seen": pa.array([None] * 403, pa.int64())}),
        pa.table({"user": [u for u, _ in hidden], "vec": pa.nulls(len(hidden), pa.list_(pa.float64())), "seen": [i for _, i in hidden]})])
    scored, cells = [], blocks._cells
    monkeypatch.setattr(blocks, "_cells", lambda u, v, score: scored.append(len(u)) or cells(u, v, score))
    for threshold in (None, {"cosine": 0.9, "dot": 70.0, "euclidean": -4.0, "manhattan": -12.0}[metric]):
        scored.clear()
        got = blocks._block_kernel(metric, 6, 6, threshold)(users, items).to_pydict()
        assert sum(scored) < 0.05 * 403 * 9000
        u, v = (blocks._unit(people), blocks._unit(vectors)) if metric == "cosine" else (people, vectors)
        scores = np.rint(blocks.SCORES[metric](u, v, None) * 1e6) / 1e6
        for who, item in hidden[:-1]:
            scores[who, item] = -np.inf
        if threshold is not None:
            scores[scores < threshold] = -np.inf
        found = {}
        for who, item, score in zip(got["user"], got["item"], got["score"]):
            found.setdefault(who, []).append((-score, item))
        for who in range(403):
            order = np.lexsort((np.arange(9000), -scores[who]))[:6]
            want = [(-scores[who, i], int(i)) for i in order if scores[who, i] > -np.inf]
            assert [i for _, i in sorted(found.get(who, []))[:6]] == [i for _, i in want]


def test_large_searches_deal_their_copies_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(11)
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(90, 4)))], "user bigint, vec array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(400, 4)))], "item bigint, vec array<double>")
    seen = spark.createDataFrame([(i, j) for i in range(90) for j in range(i % 7, 400, 7)], "user bigint, item bigint")
    monkeypatch.setattr(blocks, "_search", search := Mock(wraps=blocks._search))
    monkeypatch.setattr(blocks, "ROUND_SHARE", 1000)
    want = block_top_k(users, items, 3, "cosine", seen, block_rows=6).collect()
    assert [c.args[-1] for c in search.call_args_list] == [range(15)]
    search.reset_mock()
    monkeypatch.setattr(blocks, "ROUND_SHARE", 2)
    got = block_top_k(users, items, 3, "cosine", seen, block_rows=6).collect()
    some = [c.args[-1] for c in search.call_args_list]
    # one user block deals 400 items and 6 users to 67 blocks each: 802 rows, and 980 are allowed
    assert some == [range(i, i + 1) for i in range(15)]
    assert sorted(got) == sorted(want) and len(got) == 270


def test_vectors_without_structure_go_to_large_blocks(spark, monkeypatch):
    """Where the clusters rule nothing out, users are dealt once per block and not once per cluster."""
    from recspark.operators import cluster_index
    random = np.random.default_rng(4)
    items = spark.createDataFrame([(i, random.normal(size=16).tolist()) for i in range(2000)], "item long, vec array<double>")
    users = spark.createDataFrame([(i, random.normal(size=16).tolist()) for i in range(200)], "user long, vec array<double>")
    plain, ran = cluster_index.block_top_k, []
    monkeypatch.setattr(cluster_index, "block_top_k", lambda *a, **k: ran.append(1) or plain(*a, **k))
    got = cluster_index.cluster_top_k(users, items, 3, cluster_rows=50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain(users, items, 3).collect())) and ran == [1]


def test_weighted_draw_hands_on_few_cells(spark, monkeypatch):
    """Blocks hand on little more than is drawn in all; users whose cells ring late are drawn from all their cells."""
    from recspark.operators import weighted
    users = spark.createDataFrame([(i, 4 + i % 9) for i in range(300)] + [(900, 1500)], "user_idx long, n long")
    weights = spark.createDataFrame([(i, 0.1 + (i * 37 % 101) / 50) for i in range(2000)], "item_idx long, weight double")
    ranked, handed = weighted.rank_in_key, []
    monkeypatch.setattr(weighted, "rank_in_key", lambda df, *a: handed.append(df.count()) or ranked(df, *a))
    draw = lambda: sorted(map(tuple, weighted.weighted_draw(users, weights, 7, block_rows=100).select("user_idx", "rank", "item_idx").collect()))
    got = draw()
    monkeypatch.setattr(weighted, "_curve", lambda scores: None)
    assert got == draw()
    assert len(got) == sum(4 + i % 9 for i in range(300)) + 1500
    assert handed[0] < 4 * len(got) < handed[1]
    monkeypatch.undo()
    monkeypatch.setattr(weighted, "_target", lambda n: 0 * n + 1.0)  # hardly anyone has enough by then
    assert got == draw()
