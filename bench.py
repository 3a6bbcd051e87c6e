"""Headline queries on ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "agg1_item_popularity", "agg3_user_profile", "agg8_interaction_stats", "win1_user_top_k",
    "jn5_log_features", "rec1_random", "rec2_popularity", "rec3_content", "rec4_hybrid", "rec5_bandit",
    "rec9_logistic_regression", "smp7_weighted_draw", "met_ranking_report", "met11_curve_areas", "met13_ks",
    "gen3_history", "job2_walk_forward", "job4_compare_models", "doc1_user_knn_recommend",
    "doc6_backoff_next", "doc9_propagation", "doc11_random_walks",
]


def popularity_by_pairs(spark, path):
    """Popularity top-5 the direct way: all pairs, anti-join, window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from recspark.recommenders import PopularityRecommender
    from recspark.sources import views as V

    log, items = V.log(spark, path), V.items(spark, path)
    scores = PopularityRecommender().fit(log).item_scores(items)
    pairs = V.users(spark, path).select("user_idx").crossJoin(scores).join(
        log.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")
    order = Window.partitionBy("user_idx").orderBy(F.desc("relevance"), "item_idx")
    return pairs.withColumn("rank", F.row_number().over(order)).filter("rank <= 5")


def content_by_pairs(spark, path):
    """Content top-5 the direct way: all pairs, a Python cosine per row, window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from recspark.recommenders import ContentRecommender
    from recspark.sources import views as V

    @F.udf("double")
    def cosine(a, b):
        na, nb = sum(x * x for x in a) ** 0.5, sum(x * x for x in b) ** 0.5
        return sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0

    log, vectors = V.log(spark, path), V.item_vectors(spark, path)
    profiles = ContentRecommender().fit(log, None, vectors).profiles.select("user_idx", F.col("vec").alias("p"))
    pairs = profiles.crossJoin(vectors).join(
        log.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")
    order = Window.partitionBy("user_idx").orderBy(F.desc("relevance"), "item_idx")
    return (pairs.select("user_idx", "item_idx", cosine("p", "vec").alias("relevance"))
            .withColumn("rank", F.row_number().over(order)).filter("rank <= 5"))


def main() -> None:
    from pyspark.sql import SparkSession

    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from recspark.queries import QUERIES

    QUERIES["agg1_item_popularity"](spark, path).count()  # start the session before timing
    known, names = dict(QUERIES), sys.argv[1:] or HEADLINE
    if names == ["--pairs"]:
        known.update(popularity_by_pairs=popularity_by_pairs, content_by_pairs=content_by_pairs)
        names = ["rec2_popularity", "popularity_by_pairs", "rec3_content", "content_by_pairs"]
    seconds = {}
    for name in names:
        start = time.time()
        # the whole result is computed and dropped, nothing reaches the driver
        known[name](spark, path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(path.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
