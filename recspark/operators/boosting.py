"""Boosted trees that stop when held-out rows gain no more."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform

HELD = "held_out"


def with_held_out(rows: DataFrame, keys, share: float, salt) -> DataFrame:
    """Marks a ``share`` of rows for validation by a hash of their keys, whatever their partition."""
    return rows.withColumn(HELD, uniform(f"held.{salt}", *keys) < F.lit(float(share)))


def boost_until_flat(rows: DataFrame, max_rounds: int, tolerance: float = 0.01, depth: int = 3, step: float = 0.1,
                     seed: int = 42) -> GBTClassificationModel:
    """Boosting on rows with ``features``, ``label`` and the held-out mark, for ``max_rounds`` at most.

    Rounds end when the loss over held-out rows falls by less than ``tolerance`` times the larger of itself and 0.01; the
    model keeps the trees up to its best round.  Without held-out rows there is nothing to stop by, which is an error.
    """
    if rows.where(F.col(HELD)).isEmpty():
        raise ValueError("no held-out rows")
    return GBTClassifier(maxDepth=depth, maxIter=max_rounds, stepSize=step, seed=seed, validationIndicatorCol=HELD,
                         validationTol=tolerance).fit(rows)
