"""Event-time operators: windowed rates, sessions and removal of repeats.

Each works on a stream and, but for the removal of repeats, on a table alike; a stream needs ``delay``, how late rows may
come.  Results are appended once the watermark has passed them, so what a window, session or key keeps in the state goes
when it can no longer change, and rows that come later still are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import rank_in_key, with_last


def _timed(rows: DataFrame, ts: str, delay: str | None) -> DataFrame:
    rows = rows.where(F.col(ts).isNotNull())  # rows without a time belong to no window
    return rows.withWatermark(ts, delay) if rows.isStreaming and delay else rows


def windowed_rates(rows: DataFrame, hit: Column, amount: Column, length: str, slide: str | None = None,
                   delay: str | None = None, keys=(), ts: str = "ts") -> DataFrame:
    """``window_start, window_end, *keys, n, hits, rate, revenue`` of tumbling windows, or sliding ones with ``slide``.

    ``hit`` is a boolean (null counts as no), ``amount`` a decimal; ``revenue`` sums it over hits.  Sums are exact, so
    neither batches nor partitions can change them.  A busy window or key is summed in its tasks first.
    """
    zero = F.coalesce(hit, F.lit(False))
    found = (_timed(rows, ts, delay).groupBy(F.window(ts, length, slide).alias("w"), *keys)
             .agg(F.count("*").alias("n"), F.sum(zero.cast("long")).alias("hits"),
                  F.coalesce(F.sum(F.when(zero, amount)), F.lit(0)).alias("revenue")))
    return found.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "hits",
                        (F.col("hits") / F.col("n")).alias("rate"), "revenue")


def sessions(rows: DataFrame, key: str, gap: str, state: str, order: str, delay: str | None = None, ts: str = "ts") -> DataFrame:
    """``key, session_start, session_end, n, first_state, last_state`` of runs of events less than ``gap`` apart.

    A late row that is near two sessions joins them into one.  The state has a fixed size for each open session, whatever
    its length: events are not listed; ``session_steps`` gives their order from the finished sessions.  ``order`` breaks
    ties of time.  A null key is a key of its own.
    """
    at = F.struct(F.col(ts), F.col(order))
    found = (_timed(rows, ts, delay).groupBy(F.session_window(ts, gap).alias("w"), key)
             .agg(F.count("*").alias("n"), F.min_by(state, at).alias("first_state"), F.max_by(state, at).alias("last_state")))
    return found.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "first_state", "last_state")


def session_steps(events: DataFrame, found: DataFrame, key: str, state: str, order: str, ts: str = "ts") -> DataFrame:
    """``key, session_start, step, state`` for the events of finished sessions, steps from 1.

    Sessions of a key do not overlap, so with both sides in one order by key and time the session of an event is the last
    start before it: a running maximum over chunks of fixed length, which no long session and no busy key makes longer.
    """
    starts = found.select(key, F.col("session_start").alias(ts), F.lit(None).cast("bigint").alias(order), F.lit(None).cast("string").alias(state),
                          F.col("session_start").alias("__start"), F.col("session_end").alias("__end"))
    rows = events.where(F.col(ts).isNotNull()).select(key, ts, F.col(order).cast("bigint").alias(order), F.col(state).cast("string").alias(state),
                                                      F.lit(None).cast("timestamp").alias("__start"), F.lit(None).cast("timestamp").alias("__end"))
    both = starts.unionByName(rows).withColumn("__event", F.col("__start").isNull())
    placed = with_last(both, [key], [ts, "__event", order], {"session_start": "__start", "__until": "__end"})
    inside = placed.where(F.col("__event") & (F.col(ts) < F.col("__until"))).select(key, "session_start", ts, order, state)
    return rank_in_key(inside, [key, "session_start"], [ts, order], "step").select(key, "session_start", "step", F.col(state).alias("state"))


def without_repeats(stream: DataFrame, keys, delay: str, ts: str = "ts") -> DataFrame:
    """Rows of a stream whose ``keys`` did not come before within ``delay``; a key's state goes after that time."""
    return stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def drain_to(rows: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Append what has arrived to a Parquet table and stop; a later call goes on where this one stopped.

    Returns the progress of its batches.  The sink lists its files per batch, so a repeated batch adds nothing.
    """
    query = (rows.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
        return [p if isinstance(p, dict) else p.jsonValue for p in query.recentProgress]
    finally:
        query.stop()
