"""Reproducible random columns.

``rand(seed)`` depends on how rows are laid out over partitions, so a lost executor or
another partition count changes the draw.  Every draw here is a hash of a salt and the
row's own keys: the same row gets the same number on any layout, and the same number can
be computed in plain SQL (the ``*_sql`` twins, in the DuckDB dialect, serve the checks).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits = 52 bits, all of which fit a double exactly.
_HEX_DIGITS = 13
_SPAN = float(1 << (4 * _HEX_DIGITS))

# Modulus for numbers that two sides of a pair carry separately (2^31 - 1, a prime):
# products of two residues stay inside a signed 64-bit integer.
PAIR_PRIME = 2147483647


def _col(key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def _hash52(salt, *keys) -> Column:
    parts = [F.lit(str(salt))] + [_col(k).cast("string") for k in keys]
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, _HEX_DIGITS)
    return F.conv(digest, 16, 10).cast("bigint")


def uniform(salt, *keys) -> Column:
    """Uniform on (0, 1) from ``salt`` and the key columns; never exactly 0 or 1."""
    return (_hash52(salt, *keys) + F.lit(0.5)) / F.lit(_SPAN)


def normal(salt, *keys, mean=0.0, std=1.0) -> Column:
    """Gaussian by Box-Muller; the two uniforms use separate salts."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(f"{salt}.r", *keys)))
    angle = F.lit(2 * math.pi) * uniform(f"{salt}.a", *keys)
    mean = F.lit(mean) if not isinstance(mean, Column) else mean
    return mean + F.lit(float(std)) * radius * F.cos(angle)


def erlang(salt, *keys, shape=5, scale=10.0) -> Column:
    """Gamma with an integer shape, as a sum of exponentials."""
    total = F.log(uniform(f"{salt}.0", *keys))
    for j in range(1, shape):
        total = total + F.log(uniform(f"{salt}.{j}", *keys))
    return F.lit(-float(scale)) * total


def residue(salt, key) -> Column:
    """A non-zero residue of ``PAIR_PRIME`` for one side of a pair."""
    return _hash52(salt, key) % F.lit(PAIR_PRIME - 1) + F.lit(1)


# ---- the same draws as SQL text, for checks in DuckDB -------------------------------

def _hash52_sql(salt, *keys) -> str:
    parts = ", ".join(f"cast({k} as varchar)" for k in keys)
    return (f"cast('0x' || substring(md5(concat_ws('|', '{salt}', {parts})), 1, {_HEX_DIGITS})"
            " as bigint)")


def uniform_sql(salt, *keys) -> str:
    return f"(({_hash52_sql(salt, *keys)} + cast(0.5 as double)) / cast({int(_SPAN)} as double))"


def normal_sql(salt, *keys, mean="0.0", std=1.0) -> str:
    return (f"(cast({mean} as double) + cast({std} as double)"
            f" * sqrt(cast(-2.0 as double) * ln({uniform_sql(f'{salt}.r', *keys)}))"
            f" * cos(cast({2 * math.pi!r} as double) * {uniform_sql(f'{salt}.a', *keys)}))")


def erlang_sql(salt, *keys, shape=5, scale=10.0) -> str:
    logs = " + ".join(f"ln({uniform_sql(f'{salt}.{j}', *keys)})" for j in range(shape))
    return f"(cast({-float(scale)} as double) * ({logs}))"


def residue_sql(salt, key) -> str:
    return f"({_hash52_sql(salt, key)} % {PAIR_PRIME - 1} + 1)"
