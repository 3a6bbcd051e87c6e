"""Classifiers over user and item features, ranked by a price-aware score.

The log-odds of a linear model are a sum of a user part and an item part, and those of a
random-Fourier-feature model are an inner product of the two.  Users differ only in their segment:
the block search scores the items once for each of these, and users pick up the first items of their
segment that they have not seen.  Predictions never form a users x items table.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import normal, uniform
from ..operators.blocks import block_best
from ..operators.durable import cut
from ..operators.joins import salted_join
from ..operators.ordering import top_k
from .base import Recommender, seen_pairs


def category_levels(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """Sorted distinct values of a categorical column; refuses unbounded ones."""
    rows = df.select(column).distinct().orderBy(column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values; not a category")
    return [r[0] for r in rows if r[0] is not None]


def one_hot(column: str, levels) -> list:
    return [F.when(F.col(column) == v, F.lit(1.0)).otherwise(F.lit(0.0)) for v in levels]


class LinearRecommender(Recommender):
    """Logistic regression on one-hot categories and a standardised price.

    ``C`` follows the usual inverse-penalty convention: the penalty per row is 1 / (C n).
    Price is standardised with the population deviation over the log rows.
    """

    def __init__(self, C: float = 1.0, elastic_net: float = 0.0, score: str = "expected_revenue",
                 max_iter: int = 50, seed: int = 42):
        super().__init__(seed)
        self.C, self.elastic_net, self.score, self.max_iter = C, elastic_net, score, max_iter
        self.model = None

    # -- features ------------------------------------------------------------------
    def _learn_levels(self, log, users, items):
        self.segments = category_levels(users, "segment")
        self.categories = category_levels(items, "category")
        moments = log.join(items.select("item_idx", "price"), "item_idx").agg(
            F.avg("price").alias("m"), F.stddev_pop("price").alias("s"), F.count(F.lit(1)).alias("n")).first()
        self.mean, self.std, self.rows = moments["m"], moments["s"] or 1.0, moments["n"]

    def _user_part(self, users):
        return users.select("user_idx", F.array(*one_hot("segment", self.segments)).alias("u"))

    def _item_part(self, items):
        price = (F.col("price") - F.lit(self.mean)) / F.lit(self.std)
        return items.select("item_idx", "price",
                            F.array(*one_hot("category", self.categories), price).alias("v"))

    def _training(self, log, users, items):
        # rows with equal features collapse into one weighted row before the solver sees
        # them: first per segment and item, then per feature vector
        cells = (salted_join(log.select("user_idx", "item_idx", "relevance"),
                             users.select("user_idx", "segment"), ["user_idx"], ["item_idx"])
                 .groupBy("segment", "item_idx", F.col("relevance").cast("double").alias("label"))
                 .agg(F.count(F.lit(1)).cast("double").alias("n")))
        u = F.array(*one_hot("segment", self.segments))
        rows = cells.join(self._item_part(items), "item_idx").select(F.concat(u, "v").alias("x"), "label", "n")
        return (rows.groupBy("x", "label").agg(F.sum("n").alias("weight"))
                .withColumn("features", array_to_vector("x")))

    def _classifier(self):
        return LogisticRegression(regParam=1.0 / (self.C * self.rows), standardization=False,
                                  elasticNetParam=self.elastic_net, maxIter=self.max_iter,
                                  weightCol="weight")

    # -- contract ------------------------------------------------------------------
    def fit(self, log, user_features=None, item_features=None):
        self._learn_levels(log, user_features, item_features)
        self.model = self._classifier().fit(self._training(log, user_features, item_features))
        return self

    def _sides(self, users, items):
        """User and item vectors whose dot product is the log-odds."""
        coef, bias = self.model.coefficients.toArray(), float(self.model.intercept)
        n = len(self.segments)
        weigh = lambda col, w: F.aggregate(
            F.zip_with(col, F.array(*[F.lit(float(x)) for x in w]), lambda a, b: a * b),
            F.lit(0.0), lambda acc, x: acc + x)
        left = self._user_part(users).select(
            F.col("user_idx").alias("user"),
            F.array(F.lit(1.0), weigh(F.col("u"), coef[:n]) + F.lit(bias)).alias("vec"))
        right = self._item_part(items).select(
            F.col("item_idx").alias("item"),
            F.array(weigh(F.col("v"), coef[n:]), F.lit(1.0)).alias("vec"),
            F.col("price").alias("extra"))
        return left, right

    def predict(self, log, k, users, items, user_features=None, item_features=None,
                filter_seen_items=True):
        from .shared_score import longest_history, recommend_from_head
        people = users if user_features is None else user_features.join(users.select("user_idx"), "user_idx", "left_semi")
        who = people.select(self._kind().alias("kind"), "user_idx")
        seen = seen_pairs(log, filter_seen_items)
        longest = 0 if seen is None else longest_history(seen)

        def histories(few):
            # a short head meets few rows of the log, whatever the kind; otherwise each history goes to its own kinds
            return seen if few is not None else salted_join(seen, who.distinct(), ["user_idx"], ["item_idx"])

        head = self._head(items, k + longest)
        best = recommend_from_head(head, who, None if seen is None else histories, k, ["kind"], longest, one_place=True)
        # users that come more than once have one list
        best = top_k(best.drop("rank"), ["user_idx"], [F.desc("relevance"), F.asc("item_idx")], k)
        return best.select("user_idx", "item_idx", "relevance", F.col("rank").cast("bigint").alias("rank"))

    def _kind(self):
        """Number of a user's segment among the known ones, 0 for any other: users of a kind have equal vectors."""
        if not self.segments:
            return F.lit(0).cast("bigint")
        return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in self.segments]), F.col("segment")), F.lit(0)).cast("bigint")

    def _head(self, items, reach: int) -> DataFrame:
        """The first ``reach`` items of every kind: (kind, item_idx, relevance, pos)."""
        from .shared_score import place_items
        kinds = items.sparkSession.createDataFrame([(0, None), *enumerate(self.segments, 1)], "user_idx bigint, segment string")
        left, right = self._sides(kinds, items)
        best = cut(block_best(left, right, reach, self.score, digits=6))
        # what is not a number stands where the block search puts it, with a score of zero
        placed = place_items(best.select(
            F.col("user").alias("kind"), F.col("item").alias("item_idx"), F.col("score").alias("__score"),
            F.when(F.isnan("score"), F.lit(0.0)).otherwise(F.col("score")).alias("relevance")), ["kind"])
        return cut(placed.where(F.col("pos") < reach).select("kind", "item_idx", F.col("__score").alias("relevance"), "pos"))


class KernelRecommender(LinearRecommender):
    """Radial-basis-function classifier by random Fourier features.

    ``cos(a + b)`` of a random projection splits into products of a user and an item term,
    so the fitted model is again an inner product of two vectors.
    """

    def __init__(self, features: int = 64, gamma: float | None = None, score: str = "utility",
                 C: float = 1.0, max_iter: int = 50, seed: int = 42):
        super().__init__(C=C, score=score, max_iter=max_iter, seed=seed)
        self.features, self.gamma = features, gamma

    def _project(self, spark):
        """The random projection: features x inputs weights and one phase per feature."""
        width = len(self.segments) + len(self.categories) + 1
        gamma = self.gamma or 1.0 / width
        grid = spark.range(self.features).select(
            "id", (F.lit(2 * math.pi) * uniform(f"rff.{self.seed}.b", "id")).alias("phase"),
            F.array(*[normal(f"rff.{self.seed}.{j}", "id", std=math.sqrt(2 * gamma))
                      for j in range(width)]).alias("w"))
        rows = grid.orderBy("id").collect()  # a fixed number of model parameters
        return [r["w"] for r in rows], [r["phase"] for r in rows]

    def _angles(self, col, weights):
        matrix = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in weights])
        return F.transform(matrix, lambda w: F.aggregate(
            F.zip_with(w, col, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x))

    def fit(self, log, user_features=None, item_features=None):
        self._learn_levels(log, user_features, item_features)
        self.weights, self.phases = self._project(log.sparkSession)
        rows = self._training(log, user_features, item_features)
        phases = F.array(*[F.lit(float(p)) for p in self.phases])
        scale = math.sqrt(2.0 / self.features)
        z = F.transform(F.zip_with(self._angles(F.col("x"), self.weights), phases, lambda a, b: a + b),
                        lambda a: F.cos(a) * F.lit(scale))
        self.model = self._classifier().fit(rows.withColumn("features", array_to_vector(z)))
        return self

    def _sides(self, users, items):
        n, scale = len(self.segments), math.sqrt(2.0 / self.features)
        coef = F.array(*[F.lit(float(c) * scale) for c in self.model.coefficients.toArray()])
        phases = F.array(*[F.lit(float(p)) for p in self.phases])
        a = F.zip_with(self._angles(F.col("u"), [w[:n] for w in self.weights]), phases, lambda x, p: x + p)
        b = self._angles(F.col("v"), [w[n:] for w in self.weights])
        bias = F.lit(float(self.model.intercept))
        left = self._user_part(users).select(
            F.col("user_idx").alias("user"),
            F.concat(F.zip_with(F.transform(a, lambda x: F.cos(x)), coef, lambda x, c: x * c),
                     F.zip_with(F.transform(a, lambda x: F.sin(x)), coef, lambda x, c: -x * c),
                     F.array(bias)).alias("vec"))
        right = self._item_part(items).select(
            F.col("item_idx").alias("item"),
            F.concat(F.transform(b, lambda x: F.cos(x)), F.transform(b, lambda x: F.sin(x)),
                     F.array(F.lit(1.0))).alias("vec"), F.col("price").alias("extra"))
        return left, right


class ForestRecommender(LinearRecommender):
    """Tree ensemble on the same features.

    Users differ only in their segment, so the forest scores one row per (segment, item)
    and users pick up the list of their segment.
    """

    def __init__(self, trees: int = 20, depth: int = 5, seed: int = 42, classifier=None):
        super().__init__(seed=seed)
        self.trees, self.depth, self.classifier = trees, depth, classifier

    def _classifier(self):
        return self.classifier or RandomForestClassifier(
            numTrees=self.trees, maxDepth=self.depth, seed=self.seed, weightCol="weight")

    def segment_scores(self, items: DataFrame) -> DataFrame:
        """(segment, item_idx, relevance): expected revenue of each item for each segment."""
        spark = items.sparkSession
        kinds = spark.createDataFrame([(s,) for s in self.segments], "segment string")
        rows = (self._item_part(items).crossJoin(F.broadcast(kinds))  # a checked number of levels
                .withColumn("features", array_to_vector(
                    F.concat(F.array(*one_hot("segment", self.segments)), "v"))))
        p = F.get(vector_to_array("probability"), F.lit(1))
        return self.model.transform(rows).select(
            "segment", "item_idx", F.round(p * F.col("price"), 6).alias("relevance"))

    def predict(self, log, k, users, items, user_features=None, item_features=None,
                filter_seen_items=True):
        from .shared_score import longest_history, recommend_by_score
        who = (user_features if user_features is not None else users).select("segment", "user_idx")
        seen = seen_pairs(log, filter_seen_items)
        longest = 0
        if seen is not None:
            longest = longest_history(seen)
            seen = salted_join(seen, who, ["user_idx"], ["item_idx"])
        recs = recommend_by_score(self.segment_scores(items), who, seen, k, ["segment"], longest=longest)
        return recs.drop("segment")
