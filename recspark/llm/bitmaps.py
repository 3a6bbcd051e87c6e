"""Bitmaps of fixed size over hashed keys, built in the JVM and small enough to travel with every task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.durable import tidy

_PART = 32_768  # bits of one of Spark's bitmap rows


def _places(bits: int, hashes: int):
    """Shifts of the key's bits that give its places; ``bits`` bits from each."""
    return [(64 - bits) * i // max(1, hashes - 1) if hashes > 1 else 0 for i in range(hashes)]


class Bitmap:
    """Membership of 64-bit keys by some of their bits; false hits are possible, misses are not."""

    def __init__(self, bits: int, hashes: int, parts):
        self.mask, self.shifts = (1 << bits) - 1, _places(bits, hashes)
        self.bytes = np.zeros(max(1, (1 << bits) // 8), dtype=np.uint8)
        for number, data in parts:
            at = number * (_PART // 8)
            piece = np.frombuffer(bytes(data), dtype=np.uint8)[: len(self.bytes) - at]
            self.bytes[at:at + len(piece)] = piece

    def __contains__(self, key: int) -> bool:
        key &= (1 << 64) - 1
        return all(self.bytes[(p := key >> s & self.mask) >> 3] >> (p & 7) & 1 for s in self.shifts)

    def hits(self, keys: np.ndarray) -> np.ndarray:
        result = np.ones(len(keys), dtype=bool)
        for shift in self.shifts:
            at = np.flatnonzero(result)
            places = (keys[at] >> np.uint64(shift) & np.uint64(self.mask)).astype(np.int64)
            result[at] = self.bytes[places >> 3] >> (places & 7).astype(np.uint8) & 1
        return result


def bitmaps_of(rows: DataFrame, key: str, kinds: dict, bits: int, hashes: int = 1) -> list[Bitmap]:
    """Bitmaps of the keys that meet each of ``kinds`` (None: all), in one pass over ``rows``.

    At most ``2 ** bits / 8`` bytes for each kind reach the driver, whatever the input.
    """
    mask = F.lit((1 << bits) - 1)
    places = F.array(*[F.shiftrightunsigned(key, s).bitwiseAND(mask) for s in _places(bits, hashes)])
    names = [F.lit(n) if c is None else F.when(c, F.lit(n)) for n, c in kinds.items()]
    with tidy(rows.sparkSession):
        parts = (rows.where(F.col(key).isNotNull()).select(places.alias("places"), F.explode(F.array_compact(F.array(*names))).alias("kind"))
                 .select("kind", F.explode("places").alias("place"))
                 .groupBy("kind", F.shiftright("place", 15).alias("part"))
                 .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(_PART - 1))).alias("bits")).collect())
    return [Bitmap(bits, hashes, [(r["part"], r["bits"]) for r in parts if r["kind"] == n]) for n in kinds]


def bitmap_of(rows: DataFrame, key: str, bits: int, hashes: int = 1) -> Bitmap:
    return bitmaps_of(rows, key, {"all": None}, bits, hashes)[0]
