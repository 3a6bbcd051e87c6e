"""Responses, revenue, discounts and utilities as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .draws import normal, uniform


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bernoulli(p, salt, *keys) -> Column:
    """1 with probability ``p``."""
    return F.when(uniform(salt, *keys) <= _c(p), F.lit(1)).otherwise(F.lit(0))


def noise(mu, sigma, salt, *keys, clip_negative=True) -> Column:
    """Gaussian noise that does not look at any input column."""
    value = normal(salt, *keys, mean=mu, std=sigma)
    return F.greatest(F.lit(0.0), value) if clip_negative else value


def parametric(weights: dict) -> Column:
    """Weighted sum of columns."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return total


def log_discount(rank) -> Column:
    return F.lit(1.0) / F.log2(_c(rank) + F.lit(1.0))


def geometric_discount(rank, factor=0.85) -> Column:
    return F.pow(F.lit(float(factor)), _c(rank) - F.lit(1))


def binarise(col) -> Column:
    return F.when(_c(col) > 0, F.lit(1)).otherwise(F.lit(0))


def utility(p, price) -> Column:
    """Price-aware utility of a purchase probability."""
    p, price = _c(p), _c(price)
    return ((F.sin(p) + 1.0) * F.exp(p - 1.0) * F.log1p(price) * F.cos(price / 100.0)
            * (F.tan(p * F.lit(math.pi / 4)) + 1.0))


def expected_revenue(p, price) -> Column:
    return _c(p) * _c(price)
