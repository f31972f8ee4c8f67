"""Chat formatting after cumulative-snapshot collapse.

A chat service that logs the whole history at every turn stores each
conversation many times, as ever longer prefixes. Rolling turn-prefix hashes
name every prefix of every conversation; an anti-join drops the
conversations whose whole is a proper prefix of another, and what is left
is rendered. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import write_cut


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv, at, n, role, text``: turns numbered from 1 in their order, and
    how many their conversation has. A row without ``conv_id`` is a
    conversation of its own, so none of these meet in one window."""
    rows = conversations.select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    named = rows.where("conv is not null").select(
        "conv", F.row_number().over(order).alias("at"), F.count("*").over(Window.partitionBy("conv")).alias("n"), "role", "text")
    return named.unionByName(rows.where("conv is null").select("conv", F.lit(1).alias("at"), F.lit(1).cast("long").alias("n"), "role", "text"))


def _hashed(turns: DataFrame) -> DataFrame:
    """``turns`` with ``x, y``, 128 bits of a hash of position, role and text."""
    turn = [F.col("at"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return turns.withColumns({"x": F.xxhash64(F.lit(1), *turn), "y": F.xxhash64(F.lit(2), *turn)})


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """``conv, at, n, a, b``: for each turn, the 128-bit hash of the prefix
    that ends there. Each turn's hash is salted with its position, so the
    running XOR of turn hashes names the sequence."""
    hashed = _hashed(_turns(conversations))
    so_far = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    named = hashed.where("conv is not null").select("conv", "at", "n", F.bit_xor("x").over(so_far).alias("a"), F.bit_xor("y").over(so_far).alias("b"))
    return named.unionByName(hashed.where("conv is null").select("conv", "at", "n", F.col("x").alias("a"), F.col("y").alias("b")))


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv, n, logged, a, b``: the conversations that prefix no longer one,
    with their hash. Equal conversations collapse to the smallest id (null
    where none has any); ``logged`` counts them."""
    prefixes = write_cut(prefix_hashes(conversations), "chat-prefixes")
    whole = prefixes.where("at = n").groupBy("n", "a", "b").agg(F.min("conv").alias("conv"), F.count("*").alias("logged"))
    inner = prefixes.where("at < n").select(F.col("at").alias("n"), "a", "b").distinct()
    return whole.join(inner, ["n", "a", "b"], "left_anti").select("conv", "n", "logged", "a", "b")


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_logged, text``: the maximal conversations, one
    row each, in ChatML (``<|im_start|>role\\ntext<|im_end|>`` lines).

    Turns stand in the order of ``turn``; ties by role, then text, nulls
    first; a repeated turn stays. A null role or text is rendered empty but
    differs from an empty one when conversations are compared. A row with a
    null ``conv_id`` is a conversation of one turn. No rows give no rows.
    """
    kept = maximal(conversations).withColumnRenamed("conv", "kept")
    line = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    turns = _turns(conversations)
    named = turns.where("conv is not null").select("conv", F.struct("at", line.alias("line")).alias("t"))
    named = (named.join(kept.select("kept", F.col("n").alias("turns"), "logged").where("kept is not null"), F.col("conv") == F.col("kept"))
             .groupBy("conv", "turns", "logged").agg(F.sort_array(F.collect_list("t")).alias("t"))
             .select(F.col("conv").alias("conv_id"), F.col("turns").alias("n_turns"), F.col("logged").alias("n_logged"),
                     F.concat_ws("", F.col("t.line")).alias("text")))
    single = _hashed(turns.where("conv is null")).select("conv", F.col("x").alias("a"), F.col("y").alias("b"), line.alias("line"))
    single = single.groupBy("a", "b").agg(F.min("conv").alias("conv"), F.min("line").alias("line"))
    single = single.join(kept.where("kept is null"), ["a", "b"])
    return named.unionByName(single.select(F.col("conv").alias("conv_id"), F.col("n").alias("n_turns"), F.col("logged").alias("n_logged"), F.col("line").alias("text")))
