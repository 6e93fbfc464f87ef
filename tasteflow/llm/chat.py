"""Chat formatting after collapsing cumulative snapshots.

A service may log a conversation again after every turn, so one log holds a
conversation and its prefixes.  Each turn gets a rolling hash of all turns up to
it; a conversation whose last hash is some longer conversation's earlier hash is
a prefix of it and goes, and of equal conversations the smallest id stays.  The
rest are rendered.

Turns are ordered by (turn, role, text); the hash is the XOR of position-salted
64-bit hashes, kept twice with different salts.  The prefix hashes are made
distinct before the anti join and equal conversations are counted before it, so
neither side has a hot key, however often one first turn or one conversation is
logged.  Only a single conversation is ever held together, as its rendering is
one text.

Defined results: rows without a conversation id are no conversation and are
left out; null turns come first, null roles render as ``user`` and null texts as
empty; repeated turns are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The rendered form of one turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("user")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def rolled(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv, k, h1, h2): the hashes of each conversation's first k turns."""
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "turn_text")
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), turn_text(F.col(role), F.col(text)).alias("turn_text")
    ).select("conv", "turn", F.xxhash64("turn_text").alias("t1"), F.md5("turn_text").alias("t2"), "turn_text")
    numbered = rows.select("conv", "t1", "t2", F.row_number().over(order).alias("k"))
    upto = Window.partitionBy("conv").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered.select(
        "conv", "k", F.bit_xor(F.xxhash64("k", "t1", F.lit("a"))).over(upto).alias("h1"),
        F.bit_xor(F.xxhash64("t2", "k", F.lit("b"))).over(upto).alias("h2"))


def maximal(turns: DataFrame, **columns) -> DataFrame:
    """(conv, n_turns, n_logged): conversations that prefix no longer one, once each, with the number of equal logs."""
    prefixes = rolled(turns, **columns)
    last = Window.partitionBy("conv")
    marked = prefixes.withColumn("n", F.max("k").over(last))
    whole = marked.where(F.col("k") == F.col("n")).groupBy("k", "h1", "h2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_logged"))
    shorter = marked.where(F.col("k") < F.col("n")).select("k", "h1", "h2").distinct()
    return whole.join(shorter, ["k", "h1", "h2"], "left_anti").select(
        "conv", F.col("k").cast("bigint").alias("n_turns"), "n_logged")


def render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Per maximal conversation: id, n_turns, n_logged and the rendered text."""
    heads = maximal(turns, conv=conv, turn=turn, role=role, text=text)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), turn_text(F.col(role), F.col(text)).alias("turn_text"))
    texts = rows.join(heads.select("conv"), "conv", "left_semi").groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "turn_text"))).alias("all")).select(
        "conv", F.array_join(F.transform("all", lambda t: t["turn_text"]), "").alias("rendered"))
    return heads.join(texts, "conv").select(F.col("conv").alias(conv), "n_turns", "n_logged", "rendered")
