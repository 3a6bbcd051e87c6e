"""Robust multivariate outliers among text statistics: minimum covariance determinant per language and source.

All work is DataFrame functions.  Each group's centre and covariance come from the half of its documents, (n + p + 1) / 2
of n in p dimensions, with the smallest distances, reached by concentration steps (fit on the subset, measure all, take
the nearest again) from two starts, shortest halves per dimension and plain moments.  Steps go on until no group's
determinant falls any more; the smaller determinant wins.  A last fit takes all documents within the ``WEIGHT`` quantile.
A group's moments are pooled with ``PRIOR`` documents' worth of the moments of all groups, so that small groups
lean on the rest, and ``FLOOR`` adds to each variance the spread below which a difference means nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.operators.durable import cut

from .rules import base_failed, text_stats

DIMS, PRIOR, WEIGHT, QUANTILE = 4, 50.0, 0.975, 0.9999
# Logarithms of determinants closer than this are equal: sums and quantiles carry errors of that size.
FALL = 1e-3
# Spread per dimension: log word length, log symbol rate, log repeated lines, share of repeated words.
FLOOR = (0.06, 0.2, 0.5, 0.08)
GROUP = ("lang", "source")
BROADCAST_GROUPS = 10_000


def _chi2_cdf(x: float, dof: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def _chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 500.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf(middle, dof) < p else (low, middle)
    return low


CUTOFF = _chi2_quantile(QUANTILE, DIMS)
WEIGHT_CUTOFF = _chi2_quantile(WEIGHT, DIMS)
PERCENTS = [i / 100 for i in range(101)]


def _consistency(share: float) -> float:
    """Makes the covariance of the nearest ``share`` consistent at the normal distribution."""
    return 1.0 if share >= 1 else share / _chi2_cdf(_chi2_quantile(share, DIMS), DIMS + 2)


# For the nearest 50, 51 .. 100 percent.
CONSISTENCY = [_consistency(p) for p in PERCENTS[50:]]


def vector() -> list[Column]:
    """The transformed statistics of a text with words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log1p(10.0 * F.col("n_symbols") / n),
            F.log1p(F.col("n_dup_lines").cast("double")), F.col("n_repeat_words") / n]


def _moments(weight: Column | None, name: str) -> list[Column]:
    def total(value):
        return F.sum(value if weight is None else F.when(weight, value).otherwise(0.0))
    x = [F.col(f"x{i}") for i in range(DIMS)]
    return ([total(F.lit(1.0)).alias(f"{name}_n")] + [total(x[i]).alias(f"{name}_s{i}") for i in range(DIMS)]
            + [total(x[i] * x[j]).alias(f"{name}_p{i}{j}") for i in range(DIMS) for j in range(i + 1)])


def _fit(sums: DataFrame, name: str, scale: float | Column) -> tuple[list[Column], list[list[Column]]]:
    """Centre and covariance columns from a group's sums pooled with the prior ``all_*`` of the same names."""
    n = F.col(f"{name}_n") + PRIOR
    share = PRIOR / F.col(f"all_{name}_n")
    mean = [(F.col(f"{name}_s{i}") + share * F.col(f"all_{name}_s{i}")) / n for i in range(DIMS)]
    cov = [[(F.col(f"{name}_p{i}{j}") + share * F.col(f"all_{name}_p{i}{j}")) / n - mean[i] * mean[j] for j in range(i + 1)]
           for i in range(DIMS)]
    return mean, [[scale * cov[i][j] + (FLOOR[i] ** 2 if i == j else 0.0) for j in range(i + 1)] for i in range(DIMS)]


def _with_factor(frame: DataFrame, mean, cov, name: str) -> DataFrame:
    """Stores centre ``m``, Cholesky factor ``l`` and the logarithm of the determinant, one column after the other."""
    frame = frame.withColumns({f"{name}_m{i}": mean[i] for i in range(DIMS)}
                              | {f"{name}_c{i}{j}": cov[i][j] for i in range(DIMS) for j in range(i + 1)})
    for j in range(DIMS):
        square = F.col(f"{name}_c{j}{j}") - sum((F.col(f"{name}_l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        frame = frame.withColumn(f"{name}_l{j}{j}", F.sqrt(F.greatest(square, F.lit(1e-12))))
        frame = frame.withColumns({f"{name}_l{i}{j}": (F.col(f"{name}_c{i}{j}") - sum(
            (F.col(f"{name}_l{i}{k}") * F.col(f"{name}_l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"{name}_l{j}{j}")
            for i in range(j + 1, DIMS)} or {"__none": F.lit(None)})
    logdet = sum((2 * F.log(F.col(f"{name}_l{i}{i}")) for i in range(DIMS)), F.lit(0.0))
    return frame.withColumn(f"{name}_det", logdet).drop("__none")


def _distance(name: str, x=None) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    x = x or [F.col(f"x{i}") for i in range(DIMS)]
    y: list[Column] = []
    for i in range(DIMS):
        y.append((x[i] - F.col(f"{name}_m{i}") - sum((F.col(f"{name}_l{i}{k}") * y[k] for k in range(i)), F.lit(0.0)))
                 / F.col(f"{name}_l{i}{i}"))
    return sum((v * v for v in y), F.lit(0.0))


def _model(frame: DataFrame, names) -> DataFrame:
    wanted = [*GROUP]
    for name in names:
        wanted += [f"{name}_m{i}" for i in range(DIMS)] + [f"{name}_l{i}{j}" for i in range(DIMS) for j in range(i + 1)] + [f"{name}_det"]
    return frame.select(*wanted)


def _few(groups: DataFrame) -> bool:
    """Whether a table of groups is broadcast, some 5 MB; more groups are joined by a shuffle."""
    return groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS


def _join(frame: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """Adds a group's columns; null groups match null groups."""
    if few:
        groups = F.broadcast(groups)
    other = groups.withColumnsRenamed({c: f"__{c}" for c in GROUP})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in GROUP]
    return frame.join(other, same[0] & same[1], "left").drop(*(f"__{c}" for c in GROUP))


def _pooled(sums: DataFrame) -> DataFrame:
    """Adds the sums ``all_*`` of all groups' sums."""
    whole = sums.agg(*[F.sum(c).alias(f"all_{c}") for c in sums.columns if c not in GROUP and not c.startswith("q")])
    return sums.crossJoin(whole)  # one row on the right


def _shortest_half(percentiles: str) -> Column:
    """``low, high`` of the shortest interval that holds half of the values, from an array at ``PERCENTS``."""
    def interval(i):
        low, high = F.get(percentiles, i), F.get(percentiles, i + 50)
        return F.struct((high - low).alias("length"), low.alias("low"), high.alias("high"))
    return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(50)), interval))


def _concentrated(points: DataFrame, model: DataFrame, few: bool) -> DataFrame:
    """Both starts' fits, one concentration step on: from the nearest half of each group under ``model``."""
    measured = _join(points, model, few).withColumns({"da": _distance("a"), "db": _distance("b")})
    shares = PERCENTS[50:]
    n = F.count(F.lit(1))
    place = F.least(F.ceil(100 * F.floor((n + DIMS + 1) / 2) / n), F.lit(100)).cast("int") - 50
    nearest = cut(measured.groupBy(*GROUP).agg(n.alias("size"), *[
        F.get(F.percentile_approx(f"d{name}", shares, 1000), place).alias(f"h{name}") for name in "ab"]))
    chosen = _join(measured.select(*GROUP, *[f"x{i}" for i in range(DIMS)], "da", "db"), nearest, few)
    sums = cut(chosen.groupBy(*GROUP).agg(F.max("size").alias("qsize"), *_moments(F.col("da") <= F.col("ha"), "a"),
                                          *_moments(F.col("db") <= F.col("hb"), "b")))
    pooled = _pooled(sums)
    for name in "ab":
        share = F.round(100 * F.col(f"{name}_n") / F.col("qsize")).cast("int")  # equal distances may add to the half
        scale = F.get(F.array(*[F.lit(c) for c in CONSISTENCY]), F.greatest(share, F.lit(50)) - 50)
        pooled = _with_factor(pooled, *_fit(pooled, name, scale), name)
    return _model(pooled, "ab")


def fit(stats: DataFrame) -> DataFrame:
    """One row per language and source with the chosen centre ``best_m*`` and factor ``best_l*``.

    ``stats`` holds ``lang, source`` and the statistics of ``text_stats``; texts that fail the base rule do not count.
    Tables of groups are small beside the corpus and are written to the shared folder between the steps.
    """
    points = stats.where(~base_failed()).select(*GROUP, *[x.alias(f"x{i}") for i, x in enumerate(vector())])
    spreads = [F.percentile_approx(f"x{i}", PERCENTS, 1000).alias(f"q{i}") for i in range(DIMS)]
    start = cut(points.groupBy(*GROUP).agg(*_moments(None, "a"), *spreads))
    few = _few(start)  # all tables of groups have its rows
    pooled = _pooled(start)
    halves = [_shortest_half(f"q{i}") for i in range(DIMS)]
    middle = [(h.low + h.high) / 2 for h in halves]
    spread = [[((halves[i].high - halves[i].low) / 1.349) ** 2 + FLOOR[i] ** 2 if i == j else F.lit(0.0) for j in range(i + 1)]
              for i in range(DIMS)]
    model = _with_factor(_with_factor(pooled, *_fit(pooled, "a", 1.0), "a"), middle, spread, "b")
    model = cut(_model(model, "ab"))
    first, falling = True, True
    while falling:
        after = _concentrated(points, model, few)
        # determinants of the starts are no subset's and do not compare
        lower = {name: F.lit(True) if first else F.col(f"new_{name}_det") < F.col(f"{name}_det") - FALL for name in "ab"}
        both = cut(_join(model, after.withColumnsRenamed({c: f"new_{c}" for c in after.columns if c not in GROUP}), few)
                   .withColumns({f"{name}_fell": lower[name] for name in "ab"}))
        falling = both.where("a_fell or b_fell").limit(1).count() > 0
        model = both.select(*GROUP, *[F.when(F.col(f"{c[0]}_fell"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
                                      for c in model.columns if c not in GROUP])
        first = False
    keys = [f"m{i}" for i in range(DIMS)] + [f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)]
    smaller = F.col("a_det") <= F.col("b_det")
    model = cut(model.select(*GROUP, *[F.when(smaller, F.col(f"a_{k}")).otherwise(F.col(f"b_{k}")).alias(f"best_{k}") for k in keys]))
    near = _distance("best") <= WEIGHT_CUTOFF
    pooled = _pooled(cut(_join(points, model, few).groupBy(*GROUP).agg(*_moments(near, "best"))))
    last = _with_factor(pooled, *_fit(pooled, "best", _consistency(WEIGHT)), "best")
    return cut(_model(last, ["best"]).drop("best_det"))


def verdict(stats: DataFrame, model: DataFrame) -> DataFrame:
    """Adds ``base_failed, distance, kept``; a group without a model (all its texts failed the base rule) keeps nothing."""
    judged = _join(stats, model, _few(model))
    return (judged.withColumn("base_failed", base_failed())
            .withColumn("distance", _distance("best", vector()))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(False)))
            .drop(*[c for c in model.columns if c not in GROUP]))


def quality_rules(docs: DataFrame, key="doc_id", text="text") -> DataFrame:
    """``key, lang, source``, the statistics, ``base_failed, distance, kept``, one row per input row.

    Statistics are written once to the shared folder; texts are never shuffled.  Null texts are empty and fail the
    base rule; a null language or source is a group of its own; equal rows get equal verdicts; other columns are
    ignored; an empty table gives an empty result.
    """
    stats = cut(text_stats(docs.select(F.col(key), F.col(text), *GROUP), text, (key, *GROUP)))
    return verdict(stats, fit(stats))


def keep_regular(docs: DataFrame, text="text") -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the verdict, with all their columns.

    Rows and statistics are written once to the shared folder, so nothing is computed twice or joined by a key.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text), *GROUP)
    held = cut(text_stats(whole, text, ("__row", *GROUP)))
    return verdict(held, fit(held)).where("kept").select("__row.*")
