"""Ordered operators without an unpartitioned or unbounded window.

A window over all rows, or over one key that holds a third of them, runs in a single task.
Here rows are range-sorted on (key, order), which splits a heavy key over many tasks, and
receive their dense position.  Ranks, running totals and neighbours follow from positions:
rows fall into chunks of a fixed length and chunks into spans, and only one number per sort
partition or span is summed in one place.
"""

from __future__ import annotations

from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType

from .durable import cut

CHUNK_ROWS = 1 << 16
SPAN_CHUNKS = 1 << 12
_PART_SHIFT = 33  # monotonically_increasing_id keeps the partition number above 33 bits


def _columns(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def with_position(df: DataFrame, order, name="pos") -> DataFrame:
    """Append the 0-based position of each row in the total order ``order``.

    ``order`` must be total (end with a unique key), so that the position is a property of
    the row.  The sorted rows are checkpointed because range boundaries are sampled: both
    the partition sizes and the rows have to come from the same sort.
    """
    placed = cut(df.orderBy(*_columns(order)).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("__id"), _PART_SHIFT)
    # one number per sort partition
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows")).orderBy("__part").collect()
    starts = accumulate([r["__rows"] for r in sizes], initial=0)
    offsets = df.sparkSession.createDataFrame([(r["__part"], n) for r, n in zip(sizes, starts)], "__part long, __offset long")
    local = F.col("__id").bitwiseAND(F.lit((1 << _PART_SHIFT) - 1))
    return (placed.withColumn("__part", part)
            .join(F.broadcast(offsets), "__part")  # as many rows as shuffle partitions
            .withColumn(name, F.col("__offset") + local)
            .drop("__id", "__part", "__offset"))


def rank_in_key(df: DataFrame, keys, order, name="rank", chunk_rows=CHUNK_ROWS) -> DataFrame:
    """``row_number() over (partition by keys order by order)``, safe for heavy keys.

    The start of a key is found on one row per (chunk, key); joining it back on the same
    pair never brings more than one chunk of rows together.
    """
    keys = list(keys)
    placed = with_position(df, [*keys, *order], "__pos").withColumn(
        "__chunk", F.expr(f"__pos div {chunk_rows}"))
    starts = placed.groupBy("__chunk", *keys).agg(F.min("__pos").alias("__start"))
    starts = starts.withColumn("__start", F.min("__start").over(Window.partitionBy(*keys)))
    starts = starts.withColumnsRenamed({c: f"__s_{c}" for c in ["__chunk", *keys]})
    same = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in ["__chunk", *keys]]  # null keys have ranks too
    return (placed.join(starts, same).drop(*[f"__s_{c}" for c in ["__chunk", *keys]])
            .withColumn(name, F.col("__pos") - F.col("__start") + F.lit(1))
            .drop("__chunk", "__pos", "__start"))


def running_totals(df: DataFrame, order, totals: dict, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Inclusive running sums over the whole table in the total order ``order``.

    ``totals`` maps new column names to the columns they accumulate; nulls add nothing.
    """
    placed = with_position(df, order, "__pos").withColumn(
        "__chunk", F.expr(f"__pos div {chunk_rows}"))
    chunk_sums = cut(placed.groupBy("__chunk").agg(*[F.sum(src).alias(f"__sum_{dst}") for dst, src in totals.items()])
                     .withColumn("__span", F.expr(f"__chunk div {SPAN_CHUNKS}")))
    # one row per span, some hundred million rows of the table
    spans = chunk_sums.groupBy("__span").agg(*[F.sum(f"__sum_{dst}").alias(dst) for dst in totals])
    rows = spans.orderBy("__span").collect()
    columns = [list(accumulate([r[dst] or 0 for r in rows], initial=0)) for dst in totals]
    kinds = ", ".join(["__span long", *[f"__base_{dst} {spans.schema[dst].dataType.simpleString()}" for dst in totals]])
    whole = [isinstance(spans.schema[dst].dataType, FractionalType) for dst in totals]
    bases = df.sparkSession.createDataFrame(
        [(r["__span"], *[_number(c[i], f, spans.schema[d].dataType) for c, f, d in zip(columns, whole, totals)]) for i, r in enumerate(rows)], kinds)
    earlier = Window.partitionBy("__span").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunk_sums.join(F.broadcast(bases), "__span").select(
        "__chunk", *[(F.coalesce(F.sum(f"__sum_{dst}").over(earlier), F.lit(0)) + F.col(f"__base_{dst}")).alias(f"__carry_{dst}")
                     for dst in totals])
    inside = (Window.partitionBy("__chunk").orderBy("__pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.join(carried, "__chunk")
    for dst, src in totals.items():
        out = out.withColumn(dst, F.coalesce(F.sum(src).over(inside), F.lit(0)) + F.col(f"__carry_{dst}"))
    return out.drop("__chunk", "__pos", *[f"__carry_{dst}" for dst in totals])


def _number(value, fractional: bool, kind):
    """A running sum as a value of its column's type."""
    if isinstance(kind, DecimalType):
        return Decimal(value)
    return float(value) if fractional else value


def with_previous(df: DataFrame, keys, order, column, depth, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Append ``prev_1 .. prev_depth``: the last values of ``column`` within the key.

    The final ``depth`` rows of every chunk are also handed to the next chunk, so the lag
    window is over chunks and not over keys.
    """
    keys = list(keys)
    placed = with_position(df, [*keys, *order], "__pos").withColumn(
        "__chunk", F.expr(f"__pos div {chunk_rows}"))
    at_end = F.col("__pos") % chunk_rows >= chunk_rows - depth
    homes = F.when(at_end, F.array("__chunk", F.col("__chunk") + 1)).otherwise(F.array("__chunk"))
    spread = placed.withColumn("__home", F.explode(homes))
    seq = Window.partitionBy("__home").orderBy("__pos")
    for back in range(1, depth + 1):
        same_key = F.lit(True)
        for k in keys:
            same_key = same_key & F.lag(k, back).over(seq).eqNullSafe(F.col(k))
        spread = spread.withColumn(f"prev_{back}", F.when(same_key, F.lag(column, back).over(seq)))
    return spread.filter(F.col("__home") == F.col("__chunk")).drop("__home", "__chunk", "__pos")


def with_last(df: DataFrame, keys, order, columns: dict, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Append the last non-null value of columns up to each row within the key.

    ``columns`` maps new names to the columns they follow.  One row per (chunk, key) carries the
    values into later chunks, so a heavy key is a window over its chunks and not over its rows.
    """
    keys = list(keys)
    placed = with_position(df, [*keys, *order], "__pos").withColumn(
        "__chunk", F.expr(f"__pos div {chunk_rows}"))
    ends = placed.groupBy("__chunk", *keys).agg(*[
        F.max_by(src, F.when(F.col(src).isNotNull(), F.col("__pos"))).alias(f"__end_{dst}") for dst, src in columns.items()])
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("__chunk").alias("__s_chunk"), *[F.col(k).alias(f"__s_{k}") for k in keys], *[
        F.last(f"__end_{dst}", ignorenulls=True).over(earlier).alias(f"__carry_{dst}") for dst in columns])
    same = [F.col("__chunk") == F.col("__s_chunk"), *[F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]]
    inside = (Window.partitionBy("__chunk", *keys).orderBy("__pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.join(carried, same)
    for dst, src in columns.items():
        out = out.withColumn(dst, F.coalesce(F.last(src, ignorenulls=True).over(inside), F.col(f"__carry_{dst}")))
    return out.drop("__chunk", "__pos", "__s_chunk", *[f"__s_{k}" for k in keys], *[f"__carry_{dst}" for dst in columns])


def top_k(df: DataFrame, keys, order, k, name="rank") -> DataFrame:
    """Best ``k`` rows per key.

    The rank filter on ``row_number`` lets Spark keep only ``k`` rows per key in every map
    task before the shuffle, so a heavy key arrives as k rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*_columns(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
