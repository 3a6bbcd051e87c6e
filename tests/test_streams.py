"""Event-time streams, versioned tables and saved models."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recspark.operators.ordering import with_last
from recspark.queries.streams import arrivals, through_stream
from recspark.recommenders import (BanditRecommender, ContentRecommender, ForestRecommender, HybridRecommender, KernelRecommender,
                                   LinearRecommender, PopularityRecommender, PriceBanditRecommender, RandomRecommender, Recommender)
from recspark.recommenders.state import load_model, save_model
from recspark.sources import views as V
from recspark.sources.versions import VersionedTables
from recspark.streaming.incremental import file_stream, latest_stats, maintain_item_stats
from recspark.streaming.windows import drain_to, session_steps, sessions, windowed_rates, without_repeats

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


SCHEMA = "id long, ts timestamp, key string, kind string, value decimal(10,2), w string, n int"


def table(spark, rows):
    """Rows (id, hours or None, key, kind); the last two columns clash with names used inside."""
    return spark.createDataFrame([(i, None if h is None else at(h), k, s, Decimal(1), "x", 7) for i, h, k, s in rows], SCHEMA)


def feed(spark, folder, waves, make):
    """Every wave of rows is appended and drained; returns rows and progress."""
    progress = []
    for rows in waves:
        table(spark, rows).write.mode("append").parquet(f"{folder}/in")
        progress += drain_to(make(file_stream(spark, f"{folder}/in", table(spark, []).schema)), f"{folder}/out", f"{folder}/progress")
    return spark.read.parquet(f"{folder}/out").collect(), progress


def seconds(value):
    return (value - DAY).total_seconds() / 3600


def found_sessions(rows):
    return sorted((r.key, seconds(r.session_start), seconds(r.session_end), r.n, r.first_state, r.last_state) for r in rows)


def test_sessions_join_over_late_rows(spark, tmp_path):
    waves = [
        [(1, 0, "a", "open"), (2, 3, "a", "close"), (3, 0, "b", "only"), (9, None, "a", "timeless")],
        [(4, 1.5, "a", "middle"), (5, 1.5, "a", "after"), (6, 30, "b", "last")],  # 4 is late and near both sessions of a
        [(7, 2, "a", "too late"), (8, 30, None, "no key")],
        [(10, 100, "c", "end")]]
    rows, _ = feed(spark, tmp_path, waves, lambda s: sessions(s, "key", "2 hours", "kind", "id", "10 hours"))
    assert found_sessions(r for r in rows if r.key) == [
        ("a", 0, 5, 4, "open", "close"), ("b", 0, 2, 1, "only", "only"), ("b", 30, 32, 1, "last", "last")]
    assert [r.n for r in rows if r.key is None] == [1]
    batch = sessions(table(spark, [r for w in waves for r in w if r[0] != 7]), "key", "2 hours", "kind", "id").where("key <> 'c'")
    assert found_sessions(batch.collect()) == found_sessions(r for r in rows if r.key)
    assert sessions(table(spark, []), "key", "2 hours", "kind", "id").count() == 0


def test_session_steps(spark):
    rows = [(i, h, k, f"s{i}") for i, (h, k) in enumerate([(0, "a"), (1, "a"), (1, "a"), (9, "a"), (0, None), (0.5, None), (50, "b"), (None, "a")])]
    events = table(spark, rows + [(8, 99, "a", "of no session")])
    found = sessions(table(spark, rows), "key", "2 hours", "kind", "id")
    got = {(r.key, seconds(r.session_start), r.step, r.state) for r in session_steps(events, found, "key", "kind", "id").collect()}
    assert got == {("a", 0, 1, "s0"), ("a", 0, 2, "s1"), ("a", 0, 3, "s2"), ("a", 9, 1, "s3"), (None, 0, 1, "s4"), (None, 0, 2, "s5"), ("b", 50, 1, "s6")}


def test_last_value_crosses_chunks(spark):
    rows = [("a", i, i if i in (3, 14) else None) for i in range(25)] + [("b", 0, None), (None, 1, 5), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(4)
    got = {(r.k, r.i): r.last for r in with_last(df, ["k"], ["i"], {"last": "v"}, chunk_rows=4).collect()}
    assert got == {**{("a", i): None if i < 3 else 3 if i < 14 else 14 for i in range(25)}, ("b", 0): None, (None, 1): 5, (None, 2): 5}


def test_windows_drop_late_rows_and_forget(spark, tmp_path):
    waves = [[(100 * w + i, 24 * w + i, "k", "hit" if i % 4 == 0 else None) for i in range(24)] for w in range(8)]
    waves[5].append((1000, 2, "k", "hit"))  # days late
    rows, progress = feed(spark, tmp_path, waves, lambda s: windowed_rates(
        s, F.col("kind") == "hit", F.col("value"), "6 hours", delay="12 hours", keys=["key"]))
    got = sorted((seconds(r.window_start), seconds(r.window_end), r.n, r.hits, r.rate, float(r.revenue)) for r in rows)
    done = 24 * 7 + 23 - 12  # the last watermark
    assert got == [(6.0 * i, 6.0 * i + 6, 6, len(range(-6 * i % 4, 6, 4)), len(range(-6 * i % 4, 6, 4)) / 6, len(range(-6 * i % 4, 6, 4)))
                   for i in range(100) if 6 * i + 6 <= done]
    state = [p["stateOperators"][0] for p in progress]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert max(s["numRowsTotal"] for s in state) <= 7  # a day and a half of windows, however many days come


def test_sliding_windows_of_a_table(spark):
    rows = windowed_rates(table(spark, [(1, 0, "a", "hit"), (2, 5, "a", None), (3, None, "a", "hit")]), F.col("kind") == "hit", F.col("value"), "4 hours", "2 hours")
    assert sorted((seconds(r.window_start), r.n, r.hits, float(r.revenue)) for r in rows.collect()) == [(-2, 1, 1, 1), (0, 1, 1, 1), (2, 1, 0, 0), (4, 1, 0, 0)]


def test_repeats_are_dropped_and_forgotten(spark, tmp_path):
    waves = [[(i, 10 * w + i % 10, "k", "s") for i in range(20 * w, 20 * w + 20)] for w in range(8)]
    for w in range(1, 8):
        waves[w] += waves[w - 1][:5] + waves[w][:3]  # sent again in the next wave and in the same one
    waves[7] += [(5000, 1, "k", "too late")]
    rows, progress = feed(spark, tmp_path, waves, lambda s: without_repeats(s, ["id"], "20 hours"))
    assert sorted(r.id for r in rows) == list(range(160))
    state = [p["stateOperators"][0] for p in progress]
    assert max(s["numRowsTotal"] for s in state) <= 120  # some waves of keys, not all of them
    assert state[-1]["numRowsTotal"] <= 80


def test_arrivals_have_late_rows(spark, sf):
    rows = arrivals(V.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "event_id")
    found, progress = through_stream(rows, lambda s: without_repeats(s, ["event_id"], "7 days"))
    lost = rows.count() - found.count()
    assert lost > 0 and lost == sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress)


def test_versions_are_read_when_committed(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path))
    assert store.newest() is None and store.versions() == []
    with pytest.raises(ValueError):
        store.load()
    assert store.save({"t": spark.range(3)}, {"a": 1}) == 0
    spark.range(9).write.parquet(f"{store.folder(1)}/t")  # a writer that died before its commit
    assert store.newest() == 0 and store.next_version() == 2
    assert store.save({"t": spark.range(5), "u": spark.range(1)}, {"a": 2}) == 2
    assert (store.load()["t"].count(), store.load(0)["t"].count(), store.settings()["a"]) == (5, 3, 2)
    assert store.save({"t": spark.range(7)}, version=2) == 2 and store.load()["t"].count() == 5  # a repeated job
    with pytest.raises(ValueError):
        store.commit(2, {})
    with pytest.raises(ValueError, match="schema mismatch"):
        store.load(expected={"t": spark.range(1).selectExpr("cast(id as string) id").schema})
    with pytest.raises(ValueError, match="no table"):
        store.load(0, {"u": spark.range(1).schema})
    with pytest.raises(ValueError):
        store.load(1)
    store.save({"t": spark.range(0)})
    assert store.load()["t"].count() == 0
    store.clear(keep=1)
    assert store.versions() == [3] and sorted(p.name for p in (tmp_path / "data").iterdir()) == ["3"]


def test_item_stats_follow_the_stream(spark, tmp_path):
    schema = "item_idx long, relevance long"
    with pytest.raises(ValueError):
        latest_stats(spark, f"{tmp_path}/stats")
    for wave in range(5):
        rows = [(i, (i + wave) % 2) for i in range(wave, wave + 3)] + [(99, None)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        maintain_item_stats(file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), f"{tmp_path}/stats",
                            f"{tmp_path}/progress", full_after=3)
        got = {tuple(r) for r in latest_stats(spark, f"{tmp_path}/stats").collect()}
        everything = spark.read.parquet(f"{tmp_path}/in").groupBy("item_idx").agg(F.sum("relevance"), F.count("relevance"))
        assert got == {tuple(r) for r in everything.collect()}
    store = VersionedTables(spark, f"{tmp_path}/stats")
    assert [store.settings(v)["full"] for v in store.versions()][-3:] == [True, False, True]
    changed = store.load(store.versions()[-2])["items"].count()
    assert changed == 4  # only what the batch touched


@pytest.fixture(scope="module")
def shop(spark, sf):
    log, users, items = V.log(spark, sf), V.users(spark, sf), V.items(spark, sf)
    return log, users, items, V.item_vectors(spark, sf)


@pytest.mark.parametrize("model", [
    RandomRecommender(seed=3), PopularityRecommender(alpha=2.0), BanditRecommender(1.5), PriceBanditRecommender(price_weight=0.6),
    ContentRecommender(similarity_threshold=0.1), HybridRecommender([ContentRecommender(), PopularityRecommender()], [1, 2]),
    LinearRecommender(C=0.5), KernelRecommender(features=8), ForestRecommender(trees=3, depth=3)], ids=lambda m: type(m).__name__)
def test_models_survive_saving(spark, shop, tmp_path, model):
    log, users, items, vectors = shop
    features = vectors if isinstance(model, (ContentRecommender, HybridRecommender)) else items
    model.fit(log, users, features)
    assert save_model(model, spark, str(tmp_path)) == 0
    again = load_model(spark, str(tmp_path))
    assert type(again) is type(model)

    def lists(m):
        return sorted(map(tuple, m.predict(log, 3, users, items, user_features=users, item_features=features).collect()))
    assert lists(again) == lists(model)


def test_models_of_another_form_are_refused(spark, shop, tmp_path):
    class Own(Recommender):
        def fit(self, log, user_features=None, item_features=None):
            return self

        def predict(self, *args, **kwargs):
            return None

    with pytest.raises(ValueError, match="cannot be saved"):
        save_model(Own(), spark, str(tmp_path))
    with pytest.raises(ValueError):
        load_model(spark, str(tmp_path))
    save_model(PopularityRecommender(), spark, str(tmp_path))  # not fitted: items without feedback only
    assert load_model(spark, str(tmp_path)).popularity is None
    store = VersionedTables(spark, str(tmp_path))
    store.save({"popularity": spark.range(3)}, store.settings())
    with pytest.raises(ValueError, match="schema mismatch"):
        load_model(spark, str(tmp_path))
