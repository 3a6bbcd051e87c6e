"""Join helpers for keys that may be heavily repeated."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import cut, stored

SALTS = 16
# A side of up to this many narrow rows, some 10 MB, is broadcast.
BROADCAST_ROWS = 200_000
# Rows of one key that a task takes whole.
HEAVY_ROWS = 100_000
# Rows that meet wide ones are dealt in rounds of some so many, in this number of rounds at most.
ROUND_ROWS, MOST_ROUNDS = 15_000_000, 16


def salted_join(large: DataFrame, small: DataFrame, on, spread_by, how="inner",
                salts=SALTS) -> DataFrame:
    """Equi-join where a few keys of ``large`` may hold most of its rows.

    Rows of a heavy key are spread over ``salts`` tasks by a hash of ``spread_by``;
    ``small``, unique on ``on`` and of item or key-table size, is repeated once per salt.
    The copies are never broadcast: Spark knows the size of ``small``'s file but not of its copies, which
    would all meet in the driver.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (large.withColumn("__salt", salt)
            .join(copies.hint("merge"), [*on, "__salt"], how).drop("__salt"))


def _heavy(counted: DataFrame, on, heavy_rows: int) -> DataFrame:
    """Keys with more rows than that and how many parts they make: at most a row per ``heavy_rows`` rows of ``counted``."""
    counts = counted.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > heavy_rows)
    return counts.select(*on, F.ceil(F.col("__rows") / heavy_rows).cast("int").alias("__parts"))


def _parts():
    return F.coalesce("__parts", F.lit(1))


def wide_join(large: DataFrame, small: DataFrame, on, spread_by, counted: DataFrame | None = None,
              heavy_rows=HEAVY_ROWS) -> DataFrame:
    """The inner join of :func:`salted_join` for a ``small`` of wide rows, such as vectors: only heavy keys are repeated.

    The rows of each key are counted first, in ``counted`` (``large`` itself by default), which should be cheap to read twice.
    """
    heavy = _heavy(large if counted is None else counted, on, heavy_rows)
    spread = (large.join(F.broadcast(heavy), on, "left")
              .withColumn("__salt", F.pmod(F.xxhash64(*spread_by), _parts()).cast("int")).drop("__parts"))
    copies = (small.join(F.broadcast(heavy), on, "left")
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), _parts() - 1))).drop("__parts"))
    return spread.join(copies.hint("merge"), [*on, "__salt"]).drop("__salt")


def grouped_sums(rows: DataFrame, key: str, sums, counted: DataFrame, spread_by, heavy_rows=HEAVY_ROWS) -> DataFrame:
    """``sums`` (aliased sums) per ``key`` of rows that are narrower than their sums, as vectors are.

    Rows are dealt as they are, since a partial sum of each would be wider; a key with many rows in ``counted`` in parts.
    """
    dealt = (rows.join(F.broadcast(_heavy(counted, [key], heavy_rows)), key, "left")
             .withColumn("__part", F.pmod(F.xxhash64(*spread_by), _parts()).cast("int")).drop("__parts").repartition(key, "__part"))
    parts = dealt.groupBy(key, "__part").agg(*sums)
    return parts.groupBy(key).agg(*[F.expr(f"sum({c}) AS {c}") for c in parts.columns if c not in (key, "__part")])


def in_rounds(rows: DataFrame, key: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make(rows)``, one row per ``key``, with many rows made and stored in rounds of keys.

    What a round shuffles, such as a vector for each of its rows, is gone before the next.  ``rows`` is counted and read
    in every round: store it first.
    """
    n = min(MOST_ROUNDS, math.ceil(rows.count() / ROUND_ROWS))
    if n <= 1:
        return make(rows)
    part = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(n))
    return reduce(DataFrame.unionByName, [stored(make(rows.where(part == i)), "round") for i in range(n)])


def lookup_join(large: DataFrame, small: DataFrame, on, spread_by, how="inner") -> DataFrame:
    """Join a computed lookup table: broadcast if its counted size allows, else salted.

    ``small`` is stored before it is counted, so counting does not compute it twice.
    """
    small = cut(small)
    if small.count() <= BROADCAST_ROWS:
        return large.join(F.broadcast(small), on, how)
    return salted_join(large, small, on, spread_by, how)
