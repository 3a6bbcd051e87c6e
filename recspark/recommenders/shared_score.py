"""Models that score items once for all users."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.durable import cut, stored
from ..operators.joins import BROADCAST_ROWS, lookup_join, salted_join
from ..operators.ordering import rank_in_key, with_position
from ..operators.unseen import BUCKET_POSITIONS, first_ranks, unseen_positions
from .base import Recommender, seen_pairs


# Scores are counted in so many steps between the lowest and the highest.
BUCKETS = 4096


def _order(id_descending: bool):
    return [F.desc("relevance"), F.desc("item_idx") if id_descending else F.asc("item_idx")]


def place_items(scores: DataFrame, by=(), id_descending=False) -> DataFrame:
    """Give all items their position by score, per ``by`` group; ties by item id."""
    if not by:
        return with_position(scores, _order(id_descending))
    return (rank_in_key(scores, by, _order(id_descending), "__rank")
            .withColumn("pos", F.col("__rank") - 1).drop("__rank"))


def catalogue_head(scores: DataFrame, reach: int, by=(), id_descending=False) -> DataFrame:
    """The first ``reach`` positions of every ``by`` group, stored for repeated use.

    A histogram of the scores finds the step in which a group reaches that many items; only
    items of that step and above are sorted, by a distributed sort.
    """
    by, scores = list(by), stored(scores, "scores")
    value = F.col("relevance")
    known = ~(value.isNull() | F.isnan(value))
    ends = scores.groupBy(*by).agg(F.min(F.when(known, value)).alias("__low"), F.max(F.when(known, value)).alias("__high"))
    step = F.floor((value - F.col("__low")) / (F.col("__high") - F.col("__low")) * BUCKETS)
    # as in a descending order: no score is last, not-a-number first
    place = (F.when(value.isNull(), -1).when(F.isnan(value), BUCKETS + 1).when(F.col("__high") > F.col("__low"), step)
             .otherwise(0).cast("int"))
    # few groups have many items each: dealing items by group would fill a few tasks
    marked = lookup_join(scores, ends, by, ["item_idx"]) if by else scores.crossJoin(F.broadcast(ends))  # a single row
    marked = marked.withColumn("__b", place).drop("__low", "__high")
    counts = marked.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    if by:
        above = Window.partitionBy(*by).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
        needed = counts.withColumn("__above", F.coalesce(F.sum("__n").over(above), F.lit(0))).where(F.col("__above") < reach)
        last = needed.groupBy(*by).agg(F.min("__b").alias("__last"))
        found = lookup_join(marked, last, by, ["item_idx"]).where(F.col("__b") >= F.col("__last")).drop("__last")
    else:
        steps = sorted(((r["__b"], r["__n"]) for r in counts.collect()), reverse=True)  # at most BUCKETS + 3
        above = accumulate([n for _, n in steps], initial=0)
        found = marked.where(F.col("__b") >= min((b for (b, _), n in zip(steps, above) if n < reach), default=0))
    return cut(place_items(found.drop("__b"), by, id_descending).filter(F.col("pos") < reach))


def longest_history(seen: DataFrame, by=()) -> int:
    """Most rows of any user: no user has seen more items than that."""
    counts = seen.groupBy(*by, "user_idx").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def recommend_by_score(scores: DataFrame, who: DataFrame, seen: DataFrame | Callable | None, k: int,
                       by=(), id_descending=False, longest: int | None = None) -> DataFrame:
    """First ``k`` unseen items of every ``who`` row, in the order of their scores.

    ``seen`` may repeat pairs and may lack some of the ``by`` columns: a history that
    several groups share then stands for all of them.  It may be a function that makes the
    histories from the ids of the items that matter (``item_idx``, few enough to broadcast) or
    from None where all do; ``longest`` is then required.  With at most ``longest`` seen items
    per user, only the first ``k + longest`` positions can be reached.  Where that head is
    small it is broadcast, which drops almost the whole log before anything is shuffled;
    otherwise, as when one user has seen most of the catalogue, both sides are shuffled
    and every user's own history length bounds the positions that go further.
    """
    by = list(by)
    if seen is None:
        longest = 0
    elif longest is None:
        longest = longest_history(seen, [c for c in by if c in seen.columns])
    return recommend_from_head(catalogue_head(scores, k + longest, by, id_descending), who, seen, k, by, longest)


def recommend_from_head(head: DataFrame, who: DataFrame, seen: DataFrame | Callable | None, k: int, by, longest: int,
                        one_place=False) -> DataFrame:
    """The lists of :func:`recommend_by_score` from the stored first positions of every group.

    With ``one_place`` a seen pair takes the first position of its item only, where an item has several.
    """
    by = list(by)
    small = head.count() <= BROADCAST_ROWS
    if callable(seen):
        seen = seen(head.select("item_idx").distinct() if small else None)
    shared = [] if seen is None else [c for c in by if c in seen.columns]
    # dealt as the join below needs them, before there are k rows of each
    wanted = who.select(*by, "user_idx").repartition(*by, "user_idx").select("*", first_ranks(k).alias("nth"))
    if seen is None:
        at = wanted.withColumn("pos", F.col("nth"))
    else:
        spots = head.groupBy(*by, "item_idx").agg(F.min("pos").alias("pos")) if one_place else head.select(*by, "item_idx", "pos")
        if small:
            seen_at = seen.join(F.broadcast(spots), [*shared, "item_idx"])  # size checked above
        else:
            lengths = seen.groupBy(*shared, "user_idx").agg(F.count(F.lit(1)).alias("__n"))
            seen_at = salted_join(seen, spots, [*shared, "item_idx"], ["user_idx"])
            seen_at = salted_join(seen_at, lengths, [*shared, "user_idx"], ["item_idx"]).filter(
                F.col("pos") < k + F.col("__n"))
        at = unseen_positions(seen_at, wanted, [*by, "user_idx"], one_bucket=k + longest <= BUCKET_POSITIONS)
    items = head.select(*by, "pos", "item_idx", "relevance")
    if small:
        found = at.join(F.broadcast(items), [*by, "pos"])  # size checked above
    else:
        # the first positions are wanted by nearly every user, hence the salt
        found = salted_join(at, items, [*by, "pos"], ["user_idx"])
    return found.select(*by, "user_idx", "item_idx", "relevance", (F.col("nth") + 1).alias("rank"))


def item_counts(log: DataFrame, by=()) -> DataFrame:
    return log.groupBy(*by, "item_idx").agg(
        F.sum("relevance").alias("pos"), F.count("relevance").alias("total"))


def smoothed_popularity(pos, total, alpha=1.0) -> Column:
    """Share of positive feedback; equals 0.5 for an item without feedback."""
    return (pos + F.lit(float(alpha))) / (total + F.lit(2.0 * alpha))


def ucb_score(pos, total, log_rows, coef=2.0) -> Column:
    """Mean feedback plus the width of its confidence interval."""
    bonus = F.sqrt(F.log(F.lit(float(coef)) * log_rows) / total)
    return pos / total + bonus


def ucb_unseen(log_rows, coef=2.0) -> Column:
    """Score of an item without feedback."""
    return F.lit(1.0) + F.sqrt(F.log(F.lit(float(coef)) * log_rows))


class _SharedScore(Recommender):
    id_descending = False

    def item_scores(self, items: DataFrame) -> DataFrame:
        raise NotImplementedError

    def predict(self, log, k, users, items, user_features=None, item_features=None,
                filter_seen_items=True):
        return recommend_by_score(self.item_scores(items), users,
                                  seen_pairs(log, filter_seen_items), k,
                                  id_descending=self.id_descending)

    def score_pairs(self, pairs: DataFrame, items: DataFrame) -> DataFrame:
        """Attach the item's score to given (user_idx, item_idx) pairs."""
        return salted_join(pairs, self.item_scores(items).select("item_idx", "relevance"),
                           ["item_idx"], ["user_idx"])


class PopularityRecommender(_SharedScore):
    def __init__(self, alpha: float = 1.0, seed: int = 42):
        super().__init__(seed)
        self.alpha = alpha
        self.popularity: DataFrame | None = None

    def fit(self, log, user_features=None, item_features=None):
        self.popularity = item_counts(log).select(
            "item_idx", smoothed_popularity(F.col("pos"), F.col("total"), self.alpha).alias("relevance"))
        return self

    def item_scores(self, items):
        if self.popularity is None:
            return items.select("item_idx", F.lit(0.5).alias("relevance"))
        return (items.select("item_idx").join(self.popularity, "item_idx", "left")
                .select("item_idx", F.coalesce("relevance", F.lit(0.5)).alias("relevance")))


class BanditRecommender(_SharedScore):
    """Upper confidence bound over binary feedback.

    ``predict`` returns the unseen top-k.  ``sample`` draws items in proportion to their
    score instead, see :mod:`recspark.operators.weighted`.
    """

    id_descending = True

    def __init__(self, exploration_coef: float = 2.0, seed: int = 42):
        super().__init__(seed)
        self.coef = exploration_coef
        self.stats: DataFrame | None = None

    def fit(self, log, user_features=None, item_features=None):
        require_binary(log)
        counts = item_counts(log)
        rows = log.agg(F.count(F.lit(1)).alias("log_rows"))
        self.stats, self.rows = counts, rows
        return self

    def item_scores(self, items):
        score = F.coalesce(ucb_score(F.col("pos"), F.col("total"), F.col("log_rows"), self.coef),
                           ucb_unseen(F.col("log_rows"), self.coef))
        return (items.select("item_idx").join(self.stats, "item_idx", "left")
                .crossJoin(F.broadcast(self.rows))  # a single row
                .select("item_idx", score.alias("relevance")))


class PriceBanditRecommender(BanditRecommender):
    """Upper confidence bound blended with the price relative to the dearest item."""

    def __init__(self, exploration_coef: float = 2.0, price_weight: float = 0.3, seed: int = 42):
        super().__init__(exploration_coef, seed)
        self.price_weight = price_weight

    def item_scores(self, items):
        top = items.agg(F.max("price").alias("__top"))
        w = float(self.price_weight)
        return (super().item_scores(items).join(items.select("item_idx", "price"), "item_idx")
                .crossJoin(F.broadcast(top))  # a single row
                .select("item_idx", (F.lit(1 - w) * F.col("relevance")
                                     + F.lit(w) * F.col("price") / F.col("__top")).alias("relevance")))


def require_binary(log: DataFrame) -> None:
    """Raise if any relevance is neither 0 nor 1; nulls pass."""
    if not log.filter(~F.col("relevance").isin(0, 1)).select(F.lit(1)).limit(1).isEmpty():
        raise ValueError("relevance must be 0 or 1")
