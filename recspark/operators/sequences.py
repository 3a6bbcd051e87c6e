"""Interaction sequences and n-gram next-state models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import top_k, with_previous

START = "<s>"


def last_sequences(events: DataFrame, length: int, pad=None, value="state") -> DataFrame:
    """The latest ``length`` entries per user, oldest first, optionally left-padded.

    Only ``length`` rows per user and map task reach the shuffle.
    """
    tail = top_k(events, ["user_idx"], [F.desc("ts"), F.desc("event_id")], length, "__back")
    seq = tail.groupBy("user_idx").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", F.col(value).alias("v")))).alias("__s"),
        F.count(F.lit(1)).alias("steps"))
    states = F.transform("__s", lambda e: e["v"])
    if pad is not None:
        states = F.concat(F.array_repeat(F.lit(pad), F.lit(length) - F.size("__s")), states)
    return seq.select("user_idx", states.alias("states"), "steps")


def contexts(events: DataFrame, order: int, value="state") -> DataFrame:
    """Each event with the ``order`` states before it joined into a context string.

    Events with a shorter history have a null context.
    """
    lagged = with_previous(events, ["user_idx"], ["ts", "event_id"], value, order)
    parts = [F.col(f"prev_{i}") for i in range(order, 0, -1)]
    full = F.lit(True)
    for p in parts:
        full = full & p.isNotNull()
    return lagged.withColumn("context", F.when(full, F.concat_ws(">", *parts)))


def ngram_counts(events: DataFrame, order: int, value="state") -> DataFrame:
    return (contexts(events, order, value).filter(F.col("context").isNotNull())
            .groupBy("context", F.col(value).alias("next")).agg(F.count(F.lit(1)).alias("n")))


def ngram_probabilities(counts: DataFrame, states: DataFrame, add_k: float = 1.0) -> DataFrame:
    """Add-k smoothed probability of the observed continuations of a context."""
    size = states.select("next").distinct().agg(F.count(F.lit(1)).alias("__v"))
    totals = counts.groupBy("context").agg(F.sum("n").alias("__total"))
    return (counts.join(totals, "context").crossJoin(F.broadcast(size))  # a single row
            .select("context", "next", "n",
                    ((F.col("n") + F.lit(float(add_k)))
                     / (F.col("__total") + F.lit(float(add_k)) * F.col("__v"))).alias("p")))


def next_states(events: DataFrame, max_order: int = 3, value="state") -> DataFrame:
    """Most likely next state per user, backing off to shorter contexts.

    All orders come from one ordered pass: the event joins its longest context and every
    suffix of it.
    """
    lagged = with_previous(events, ["user_idx"], ["ts", "event_id"], value, max_order)
    rows = []
    for n in range(1, max_order + 1):
        parts = [F.col(f"prev_{i}") for i in range(n, 0, -1)]
        full = F.lit(True)
        for p in parts:
            full = full & p.isNotNull()
        rows.append(F.when(full, F.struct(F.lit(n).alias("order"), F.concat_ws(">", *parts).alias("context"))))
    grams = (lagged.select(F.explode(F.array_compact(F.array(*rows))).alias("g"), F.col(value).alias("next"))
             .groupBy("g.order", "g.context", "next").agg(F.count(F.lit(1)).alias("n")))
    best = top_k(grams, ["order", "context"], [F.desc("n"), F.asc("next")], 1).drop("rank")
    tails = last_sequences(events, max_order, value=value)
    probes = [F.when(F.size("states") >= n, F.struct(
        F.lit(n).alias("order"),
        F.array_join(F.slice("states", F.lit(-n), F.lit(n)), ">").alias("context"))) for n in range(1, max_order + 1)]
    asked = tails.select("user_idx", F.explode(F.array_compact(F.array(*probes))).alias("g")).select(
        "user_idx", "g.order", "g.context")
    return (asked.join(best, ["order", "context"]).groupBy("user_idx")
            .agg(F.max_by(F.struct("order", "context", "next"), "order").alias("b"))
            .select("user_idx", "b.order", "b.context", "b.next"))
