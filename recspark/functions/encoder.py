"""Scoring vectors with a small dense network."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

_SLOPE = 0.01  # leaky rectifier


def encode(df: DataFrame, key: str, vector: str, layers) -> DataFrame:
    """Unit-normalise each vector and run it through ``layers`` of (weights, bias).

    Hidden layers use a leaky rectifier, the last one is linear.  The key column is kept;
    latent values come back as float columns.  Arrow batches, one matrix product per layer.
    """
    weights = [(np.asarray(w, dtype=np.float64), None if b is None else np.asarray(b, dtype=np.float64)) for w, b in layers]
    width = weights[-1][0].shape[1]
    names = [f"latent_{i}" for i in range(width)]

    def run(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch[vector].to_numpy()).astype(np.float64)
            length = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
            for i, (w, b) in enumerate(weights):
                x = x @ w if b is None else x @ w + b
                if i < len(weights) - 1:
                    x = np.where(x > 0, x, _SLOPE * x)
            out = pd.DataFrame(x.astype(np.float32), columns=names)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    key_type = df.schema[key].dataType.simpleString()
    return df.select(key, vector).mapInPandas(run, f"{key} {key_type}, " + ", ".join(f"{n} float" for n in names))
