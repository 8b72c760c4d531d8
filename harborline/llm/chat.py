"""Chat formatting with collapse of cumulative snapshots.

Only native expressions. A chat log often holds each conversation once a turn,
every snapshot a prefix of the next. Rolling prefix hashes find a conversation
that is a prefix of a longer one without comparing pairs; an anti-join keeps
the maximal ones, and those are rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle


def turn_prefixes(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, at, n, p1, p2): the 128-bit hash of the first ``at`` turns of ``n``.

    A turn's hash is mixed with its position and folded by exclusive or in a
    running window, so a prefix hash depends on order and no conversation is
    gathered into an array. Texts aren't shuffled, only their hashes.
    """
    same = [F.coalesce(F.col(role_col), F.lit("")), F.col(role_col).isNull(), F.coalesce(F.col(text_col), F.lit("")),
        F.col(text_col).isNull()]
    hashed = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.xxhash64(*same).alias("h1"), F.xxhash64(F.lit(7), *same).alias("h2"),
    )
    order = W.partitionBy("conv").orderBy("turn", "h1", "h2")
    run = order.rowsBetween(W.unboundedPreceding, 0)
    return (
        hashed.withColumn("at", F.row_number().over(order))
        .withColumn("m1", F.xxhash64("at", "h1"))
        .withColumn("m2", F.xxhash64(F.lit(7), "h2", "at"))
        .select(
            "conv", "at",
            F.expr("bit_xor(m1)").over(run).alias("p1"),
            F.expr("bit_xor(m2)").over(run).alias("p2"),
            F.lead("at").over(order).isNull().alias("last"),
        )
    )


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text") -> DataFrame:
    """(conv, n_turns, n_absorbed) of conversations that are a prefix of no other.

    Of equal conversations the one with the least id is kept. ``n_absorbed``
    counts equal conversations that the kept one stands for, itself not
    included. Rows with a null id form one conversation; a null turn sorts
    first, equal turns by content; a repeated row is a turn of its own.
    """
    prefixes = settle(turn_prefixes(turns, conv_col, turn_col, role_col, text_col))
    whole = (
        prefixes.where("last")
        .groupBy("at", "p1", "p2")
        .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"))
    )
    inner = prefixes.where(~F.col("last")).select("at", "p1", "p2").distinct()
    return whole.join(inner, ["at", "p1", "p2"], "left_anti").select(
        "conv", F.col("at").cast("long").alias("n_turns"), (F.col("n") - 1).alias("n_absorbed")
    )


def render_chats(turns: DataFrame, kept: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``kept`` with ``rendered``: its turns in order, each in role markers.

    Null role is "unknown", null text is empty. One conversation is one row, as
    long as its turns together.
    """
    same = [F.coalesce(F.col(role_col), F.lit("")), F.col(role_col).isNull(), F.coalesce(F.col(text_col), F.lit("")),
        F.col(text_col).isNull()]
    body = F.concat(
        F.lit("<|"), F.coalesce(F.col(role_col), F.lit("unknown")), F.lit("|>\n"),
        F.coalesce(F.col(text_col), F.lit("")), F.lit("\n<|end|>"),
    )
    said = turns.select(
        F.col(conv_col).alias("c"),
        F.struct(F.col(turn_col).alias("turn"), F.xxhash64(*same).alias("h1"), F.xxhash64(F.lit(7), *same).alias("h2"),
            body.alias("body")).alias("t"),
    )
    return (
        kept.join(said, F.col("conv").eqNullSafe(F.col("c")))
        .groupBy("conv", "n_turns", "n_absorbed")
        .agg(F.sort_array(F.collect_list("t")).alias("ts"))
        .select("conv", "n_turns", "n_absorbed", F.array_join(F.transform("ts", lambda t: t["body"]), "\n")
            .alias("rendered"))
    )


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text") -> DataFrame:
    """Maximal conversations, rendered. An empty table gives an empty table."""
    kept = maximal_conversations(turns, conv_col, turn_col, role_col, text_col)
    return render_chats(turns, kept, conv_col, turn_col, role_col, text_col)
