"""Recommenders with a common fit / predict contract."""

from .base import Recommender
from .content import ContentRecommender
from .hybrid import HybridRecommender
from .linear import ForestRecommender, KernelRecommender, LinearRecommender
from .random_pick import RandomRecommender
from .shared_score import (BanditRecommender, PopularityRecommender, PriceBanditRecommender)

__all__ = ["Recommender", "RandomRecommender", "PopularityRecommender", "BanditRecommender",
           "PriceBanditRecommender", "ContentRecommender", "HybridRecommender",
           "LinearRecommender", "KernelRecommender", "ForestRecommender"]
