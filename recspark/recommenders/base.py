from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame


class Recommender(ABC):
    """Contract of every recommender.

    ``fit`` learns from (user_idx, item_idx, relevance) rows; ``predict`` returns
    (user_idx, item_idx, relevance, rank) with at most ``k`` rows per user.  Results carry
    key columns only: enrich them with :func:`recspark.operators.lists.enrich`.
    """

    def __init__(self, seed: int = 42):
        self.seed = seed

    @abstractmethod
    def fit(self, log: DataFrame, user_features: DataFrame | None = None,
            item_features: DataFrame | None = None) -> "Recommender": ...

    @abstractmethod
    def predict(self, log: DataFrame | None, k: int, users: DataFrame, items: DataFrame,
                user_features: DataFrame | None = None, item_features: DataFrame | None = None,
                filter_seen_items: bool = True) -> DataFrame: ...


def seen_pairs(log: DataFrame | None, filter_seen_items: bool) -> DataFrame | None:
    if log is None or not filter_seen_items:
        return None
    return log.select("user_idx", "item_idx")
