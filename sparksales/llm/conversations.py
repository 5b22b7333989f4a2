"""Chat formatting: collapse cumulative snapshots of logged conversations, then render.

A log often holds a conversation several times, each time a few turns longer. Each
turn gets a rolling hash of everything said up to it. A conversation whose last hash
appears at the same turn number inside a longer one is a prefix of it and goes, through
an anti-join; of equal conversations the smallest id stays. What is left is rendered.

The rolling hash is a running sum of position-salted 64-bit hashes, as two pairs of
32-bit halves, so it needs no ordered fold: sums within chunks of turns plus the totals
of the chunks before. One conversation with very many turns is split between tasks.

Defined results: turns are ordered by turn number, null first, then role and text;
fully repeated rows count once. Null roles and texts are values of their own and are
rendered as empty. Rows with a null conv_id make up one conversation. An empty table
has no conversations. Other columns are not looked at.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.staging import stage

CHUNK_TURNS = 1024
START, END = "<|im_start|>", "<|im_end|>"


def _halves(seed: int) -> list[Column]:
    h = F.xxhash64(F.lit(seed), F.col("nth"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))
    return [F.shiftrightunsigned(h, 32), h.bitwiseAND(0xFFFFFFFF)]


_HALVES = ["h0", "h1", "h2", "h3"]


def rolling_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, nth, h0..h3): rolling hash of the first ``nth`` turns."""
    said = turns.select("conv_id", "turn", "role", "text").distinct()
    # Turn numbers give the chunks; ties of one number stay together.
    said = said.withColumn("chunk", F.floor(F.coalesce(F.col("turn"), F.lit(-1)).cast("double") / CHUNK_TURNS))
    within = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    def with_totals_before(df: DataFrame, totals: dict[str, Column]) -> DataFrame:
        sums = df.groupBy("conv_id", "chunk").agg(*[total.alias(name) for name, total in totals.items()])
        sums = sums.select(
            F.col("conv_id").alias("_conv"),
            F.col("chunk").alias("_chunk"),
            *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"before_{name}") for name in totals],
        )
        return df.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))).drop(
            "_conv", "_chunk"
        )

    said = with_totals_before(said, {"rows": F.count(F.lit(1))})
    said = said.withColumn("nth", F.row_number().over(within) + F.col("before_rows")).drop("before_rows")
    said = said.select("*", *[h.alias(name) for name, h in zip(_HALVES, _halves(1) + _halves(2))])
    said = with_totals_before(said, {name: F.sum(name) for name in _HALVES})
    running = {name: F.sum(name).over(within) + F.col(f"before_{name}") for name in _HALVES}
    return said.select("conv_id", "turn", "role", "text", "nth", *[c.alias(name) for name, c in running.items()])


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are not a prefix of another.

    ``n_copies``: conversations equal to it, itself included.
    """
    last = F.max_by(F.struct(*_HALVES), "nth")
    ends = prefixes.groupBy("conv_id").agg(F.max("nth").alias("n_turns"), last.alias("last"))
    ends = ends.select("conv_id", "n_turns", "last.*")
    # One row for each different conversation, so a conversation logged very often is one row below.
    different = ends.groupBy("n_turns", *_HALVES).agg(
        F.min(F.struct(F.col("conv_id").isNull(), "conv_id")).alias("first"), F.count(F.lit(1)).alias("n_copies")
    )
    inner = prefixes.join(
        ends.select(F.col("conv_id").alias("_conv"), "n_turns"), F.col("conv_id").eqNullSafe(F.col("_conv"))
    )
    inner = inner.where(F.col("nth") < F.col("n_turns")).select(F.col("nth").alias("n_turns"), *_HALVES).distinct()
    return different.join(inner, ["n_turns", *_HALVES], "left_anti").select(
        F.col("first.conv_id").alias("conv_id"), F.col("n_turns").cast("bigint"), "n_copies"
    )


def render(turns: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """(conv_id, text): every turn as start + role, a line feed, its text and end."""
    said = F.concat(
        F.lit(start), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(end + "\n")
    )
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("nth", said.alias("said")))).alias("said"))
    return listed.select("conv_id", F.array_join(F.col("said.said"), "").alias("text"))


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies, text) of the maximal conversations."""
    # Staged, because ends, inner prefixes and texts all come from it.
    prefixes = stage(rolling_prefixes(turns))
    kept = maximal_conversations(prefixes)
    names = kept.select(F.col("conv_id").alias("_conv"), "n_turns", "n_copies")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    texts = render(prefixes.join(names.select("_conv"), same, "left_semi"))
    return texts.join(names, same).select("conv_id", "n_turns", "n_copies", "text")
