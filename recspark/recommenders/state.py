"""Saving fitted recommenders and loading them again.

A model is a version of a :class:`~recspark.sources.versions.VersionedTables`: its tables as Parquet, MLlib models in
their own format beside them, and constructor arguments and learned numbers as settings of the commit mark.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources.versions import VersionedTables
from .base import Recommender
from .content import ContentRecommender
from .hybrid import HybridRecommender
from .linear import ForestRecommender, KernelRecommender, LinearRecommender
from .random_pick import RandomRecommender
from .shared_score import BanditRecommender, PopularityRecommender, PriceBanditRecommender

_LEARNED = ("segments", "categories", "mean", "std", "rows")
_COUNTS = T.StructType().add("item_idx", "long").add("pos", "long").add("total", "long")
# constructor arguments with the attributes that hold them, learned plain values, tables with the columns they need
_STATE = {
    RandomRecommender: ({"seed": "seed"}, (), {}),
    PopularityRecommender: ({"alpha": "alpha", "seed": "seed"}, (),
                            {"popularity": T.StructType().add("item_idx", "long").add("relevance", "double")}),
    BanditRecommender: ({"exploration_coef": "coef", "seed": "seed"}, (),
                        {"stats": _COUNTS, "rows": T.StructType().add("log_rows", "long")}),
    PriceBanditRecommender: ({"exploration_coef": "coef", "price_weight": "price_weight", "seed": "seed"}, (),
                             {"stats": _COUNTS, "rows": T.StructType().add("log_rows", "long")}),
    ContentRecommender: ({"similarity_threshold": "threshold", "prefix": "prefix", "seed": "seed"}, (), {"profiles": None}),
    LinearRecommender: ({"C": "C", "elastic_net": "elastic_net", "score": "score", "max_iter": "max_iter", "seed": "seed"}, _LEARNED, {}),
    KernelRecommender: ({"features": "features", "gamma": "gamma", "score": "score", "C": "C", "max_iter": "max_iter", "seed": "seed"},
                        (*_LEARNED, "weights", "phases"), {}),
    ForestRecommender: ({"trees": "trees", "depth": "depth", "seed": "seed"}, _LEARNED, {}),
}
_KINDS = {c.__name__: c for c in (*_STATE, HybridRecommender)}
_MODELS = {c.__name__: c for c in (LogisticRegressionModel, RandomForestClassificationModel)}


def _take(model: Recommender, prefix: str, tables: dict, models: dict) -> dict:
    """Settings of a model; its tables and MLlib models go to the given dicts."""
    kind = type(model)
    if kind is HybridRecommender:
        parts = [_take(m, f"{prefix}{i}-", tables, models) for i, m in enumerate(model.recommenders)]
        return {"kind": kind.__name__, "arguments": {"weights": model.weights, "seed": model.seed}, "parts": parts}
    if kind not in _STATE:
        raise ValueError(f"{kind.__name__} cannot be saved")
    arguments, learned, held = _STATE[kind]
    for name in held:
        if getattr(model, name, None) is not None:
            tables[prefix + name] = getattr(model, name)
    if getattr(model, "model", None) is not None:
        models[f"{prefix}model"] = model.model
    return {"kind": kind.__name__, "arguments": {a: getattr(model, at) for a, at in arguments.items()},
            "learned": {n: getattr(model, n) for n in learned if hasattr(model, n)},
            "model": type(model.model).__name__ if getattr(model, "model", None) is not None else None}


def save_model(model: Recommender, spark: SparkSession, path: str) -> int:
    """Store a fitted model as a new version under ``path``; returns its number."""
    store, tables, models = VersionedTables(spark, path), {}, {}
    settings, version = _take(model, "", tables, models), store.next_version()
    for name, part in models.items():
        part.write().overwrite().save(f"{store.folder(version)}/{name}")
    return store.save(tables, settings, version)


def load_model(spark: SparkSession, path: str, version: int | None = None) -> Recommender:
    """A model as it was saved; raises for a version that was not committed and for tables of another form."""
    store = VersionedTables(spark, path)
    version = store.newest() if version is None else version
    settings = store.settings(version)

    def expected(part: dict, prefix: str) -> dict:
        if part["kind"] == HybridRecommender.__name__:
            return {n: s for i, p in enumerate(part["parts"]) for n, s in expected(p, f"{prefix}{i}-").items()}
        return {prefix + n: s for n, s in _STATE[_KINDS[part["kind"]]][2].items() if s is not None and prefix + n in saved}

    saved = store.load(version)
    tables = store.load(version, expected(settings, ""))

    def make(part: dict, prefix: str) -> Recommender:
        kind = _KINDS[part["kind"]]
        if kind is HybridRecommender:
            return kind([make(p, f"{prefix}{i}-") for i, p in enumerate(part["parts"])], **part["arguments"])
        model = kind(**part["arguments"])
        for name, value in part["learned"].items():
            setattr(model, name, value)
        for name in _STATE[kind][2]:
            if prefix + name in tables:
                setattr(model, name, tables[prefix + name])
        if part["model"]:
            model.model = _MODELS[part["model"]].load(f"{store.folder(version)}/{prefix}model")
        return model

    return make(settings, "")
