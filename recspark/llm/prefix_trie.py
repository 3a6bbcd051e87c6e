"""A trie of conversation prefixes by van Emde Boas recursion.

Conversations are runs of turns in a block whose height is a power of two.  A block is cut at half its height: the first
halves are runs of the upper trie, equal ones merged into one with a count, and the prefix that ends at the cut is named
by its content; what follows is a run of the lower forest under that name.  All blocks of one height are cut at once, so
``log2`` of the longest conversation gives as many rounds, after which every run is one turn and every merged run a node.
A conversation joins at the height that holds it, so a few long ones do not burden the others.

Totals over subtrees take the way back.  Going up, the total of a block is that of its upper trie and of the forests
under the cut; going down, the forests' totals, with all that hangs under their own lowest nodes, are grafted onto the
lowest nodes of the upper trie.  Each round is one join and one sum by node, so a hot prefix is summed in its tasks first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.operators.durable import stored
from recspark.operators.ordering import rank_in_key

GROUP, SHARED_TURNS = 100, 6
ID_BITS = 8  # ids of one block of 2 ** ID_BITS consecutive ones stand in one row while they are digested


def _root() -> Column:
    """The name of the prefix without turns."""
    return F.unhex(F.lit("00" * 16))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def ordered_turns(talks: DataFrame) -> DataFrame:
    """``conv_id, pos, item, chars``: each turn's place from 1, a digest of role and text, and the text's code points.

    Turns without a number come first; equal numbers are ordered by role and the digest.  Null roles and texts are empty.
    Rows without ``conv_id`` belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    item = _digest(F.char_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))
    turns = talks.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), item.alias("item"), F.char_length(text).cast("long").alias("chars"))
    return rank_in_key(turns, ["conv_id"], ["turn", "role", "item"], "pos").select("conv_id", F.col("pos").cast("long").alias("pos"), "item", "chars")


def rebuild(turns: DataFrame, group: int = GROUP, shared: int = SHARED_TURNS) -> tuple[DataFrame, DataFrame]:
    """Sequences ``conv_id, b, item, chars, size`` (``b`` from 0) and conversations ``conv_id, size``.

    Conversation c starts with the first h turns of c - c % ``group`` (fewer if that is shorter), h = crc32(c) % ``shared``,
    and goes on with its own turns after its first h.
    """
    turns = stored(turns, "turns")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = stored(convs.select("conv_id", "own", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h"),
                                (F.col("conv_id") - F.col("conv_id") % group).alias("base")), "convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    given = F.least("h", F.coalesce("base_own", F.lit(0)))
    heads = stored(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", given.alias("given"), (given + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")), "heads")
    # at most shared - 1 turns of a base go to the conversations of its group
    first = (turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < shared))
             .select(F.col("conv_id").alias("base"), F.col("pos"), "item", "chars")
             .join(heads, "base").where("pos <= given").select("conv_id", (F.col("pos") - 1).alias("b"), "item", "chars", "size"))
    rest = (turns.join(heads, "conv_id").where("pos > h")
            .select("conv_id", (F.col("given") + F.col("pos") - F.col("h") - 1).alias("b"), "item", "chars", "size"))
    return stored(first.unionByName(rest), "sequences"), heads.select("conv_id", "size")


def _digest_ids(members: DataFrame) -> DataFrame:
    """``tail, ends_sha256`` of ``tail, conv_id``: ids in numerical order, joined by commas.

    Ids are listed in blocks of consecutive numbers, which bounds a row; a digest then reads its blocks one by one.
    """
    blocks = (members.groupBy("tail", F.shiftright("conv_id", ID_BITS).alias("block")).agg(F.collect_list("conv_id").alias("ids"))
              .select("tail", "block", F.array_join(F.transform(F.array_sort("ids"), lambda x: x.cast("string")), ",").alias("ids")))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail, state = None, None
        for batch in batches:
            done = []
            for t, ids in zip(batch["tail"].tolist(), batch["ids"].tolist()):
                if t == tail:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        done.append((tail, state.hexdigest()))
                    tail, state = t, hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["tail", "ends_sha256"], dtype=object)
        if state is not None:
            yield pd.DataFrame([(tail, state.hexdigest())], columns=["tail", "ends_sha256"], dtype=object)

    return blocks.repartition("tail").sortWithinPartitions("tail", "block").select("tail", "ids").mapInPandas(read, "tail binary, ends_sha256 string")


def _add(*tables: DataFrame) -> DataFrame:
    """Sums by node of tables ``name, depth, leaves, saved``."""
    return (reduce(DataFrame.unionByName, tables).groupBy("name", "depth")
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))


def build(sequences: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The merged runs of every height, lowest first, and the digest of each conversation's whole sequence.

    A run is ``root`` (name of the prefix before it), ``b`` (its block), ``seg`` (digest of its turns), ``full`` (it reaches
    the block's end), ``name`` (of the prefix it completes, if full), ``tail`` (digest of the sequence that ends with it),
    ``conv_id`` (smallest member) and ``n`` (members).
    """
    longest = sequences.agg(F.max("size")).first()[0] or 0
    parts = [sequences.select("conv_id", "b", F.col("item").alias("seg"), F.lit(True).alias("full"), "size")]
    halves = [None]
    for level in range(1, max(0, longest - 1).bit_length() + 1):
        left, right = F.col("b") % 2 == 0, F.col("b") % 2 == 1
        pairs = (parts[-1].where(F.col("size") > 1 << level - 1).groupBy("conv_id", F.shiftright("b", 1).alias("b"), "size")
                 .agg(F.max(F.when(left, F.col("seg"))).alias("left"), F.max(F.when(left, F.col("full"))).alias("left_full"),
                      F.max(F.when(right, F.col("seg"))).alias("right"), F.max(F.when(right, F.col("full"))).alias("right_full")))
        halves.append(stored(pairs, "halves"))
        parts.append(halves[-1].select("conv_id", "b", _digest("left", F.coalesce("right", F.unhex(F.lit("")))).alias("seg"),
                                       (F.col("left_full") & F.coalesce("right_full", F.lit(False))).alias("full"), "size"))

    def entering(level: int) -> DataFrame:
        """Conversations that this height is the first to hold."""
        low = 1 << level - 1 if level else 0
        return (parts[level].where((F.col("b") == 0) & (F.col("size") > low) & (F.col("size") <= 1 << level))
                .select(_root().alias("root"), "b", "seg", "full", F.when(F.col("full"), _digest(_root(), "seg")).alias("name"),
                        F.col("seg").alias("tail"), "conv_id", F.lit(1).cast("long").alias("n")))

    runs: list[DataFrame] = []
    for level in reversed(range(len(parts))):
        found = entering(level)
        if runs:
            cut = runs[-1].join(halves[level + 1].drop("size"), ["conv_id", "b"])
            upper = cut.select("root", (F.col("b") * 2).alias("b"), F.col("left").alias("seg"), F.col("left_full").alias("full"),
                               F.when(F.col("left_full"), _digest("root", "left")).alias("name"),
                               F.when(F.col("right").isNull(), F.col("tail")).alias("tail"), "conv_id", "n")
            lower = cut.where(F.col("right").isNotNull()).select(
                _digest("root", "left").alias("root"), (F.col("b") * 2 + 1).alias("b"), F.col("right").alias("seg"),
                F.col("right_full").alias("full"), "name", "tail", "conv_id", "n")
            found = found.unionByName(upper).unionByName(lower)
        runs.append(stored(found.groupBy("root", "b", "seg", "full").agg(
            F.max("name").alias("name"), F.max("tail").alias("tail"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n")), "runs"))
    tails = reduce(DataFrame.unionByName, [entering(level).select("conv_id", "tail") for level in range(len(parts))])
    return runs[::-1], tails


def graft(runs: list[DataFrame], own: DataFrame) -> DataFrame:
    """``name, leaves, saved``: of every node with children, the sums of all nodes below it.

    ``own`` has ``parent, depth, leaves, saved`` of the nodes themselves.
    """
    blocks = [stored(_add(own.select(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth"), "leaves", "saved")), "blocks")]
    for level, table in enumerate(runs[:-1]):
        # the forest under a cut belongs to the block of the upper trie above the cut
        above = table.where("full and b % 2 = 0").select("name", F.col("root").alias("up"))
        lifted = blocks[-1].join(above, "name", "left").select(
            F.coalesce("up", "name").alias("name"),
            F.when(F.col("up").isNotNull(), F.col("depth") - (1 << level)).otherwise(F.col("depth")).alias("depth"), "leaves", "saved")
        blocks.append(stored(_add(lifted), "blocks"))
    below = blocks[-1]  # of the root
    for level in reversed(range(len(runs) - 1)):
        ends = runs[level].where("full and b % 2 = 1").select("name", F.col("root").alias("up"))
        hanging = below.join(ends, "name").select(F.col("up").alias("name"), (F.col("depth") - (1 << level)).alias("depth"), "leaves", "saved")
        under_cut = blocks[level].where((F.shiftright("depth", level) % 2) == 1)
        below = stored(below.unionByName(_add(under_cut, hanging)), "below")
    return below.select("name", "leaves", "saved")


def prefix_trie(talks: DataFrame, group: int = GROUP, shared: int = SHARED_TURNS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``talks`` has ``conv_id, turn, role, text``; other columns are ignored.  Nodes are the distinct sequences of the first
    ``depth`` turns of rebuilt conversations (see ``rebuild``), named by their smallest member; the root has no turn.  An
    empty table has no node, conversations without turns stand at the root, equal conversations share all nodes.
    """
    sequences, convs = rebuild(ordered_turns(talks), group, shared)
    runs, tails = build(sequences)
    turns = runs[0].select("name", F.col("root").alias("parent"), "conv_id", "b", "n", "tail")
    turns = turns.join(sequences.select("conv_id", "b", "chars"), ["conv_id", "b"]).withColumn("depth", F.col("b") + 1).drop("b")
    top = (convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).where("n > 0")
           .select("conv_id", "n", F.lit(0).cast("long").alias("chars"), _root().alias("name"), F.lit(None).cast("binary").alias("parent"),
                   _root().alias("tail"), F.lit(0).cast("long").alias("depth")))
    nodes = stored(turns.unionByName(top), "nodes")
    kids = nodes.where("depth > 0").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, "name", "left").select(
        "name", "parent", "conv_id", "depth", "n", "tail", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("chars")).alias("saved")), "nodes")
    totals = graft(runs, nodes.where("depth > 0")).select("name", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    ends = _digest_ids(tails.unionByName(convs.where("size = 0").select("conv_id", _root().alias("tail"))))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(totals, "name", "left").join(ends, "tail", "left").join(parents, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
                    (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
