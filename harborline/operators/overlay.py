"""Edits by hand over a built table: the last edit of a cell wins, and the cell's origin stays beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import named

#: The columns of a table of edits.
EDITS = "key, column, value (text), time, author"


def overlay(df: DataFrame, edits: DataFrame, key: str, editable: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(``df`` with edited cells and ``origin``, exceptions).

    ``edits``: key, column, value (text; null or blank clears the cell), time,
    author. Of a cell's edits the latest wins; of several at one time the one
    of the greatest author, then value. ``origin`` maps each edited column to
    struct(author, time, was), ``was`` being the built value as text. Edits
    that can't be applied are rows of (key, column, value, time, author,
    reason): ``unknown column`` (not of ``editable``), ``unknown key``,
    ``not a <type>`` (the cell keeps its built value), and ``conflict`` for
    every edit of a cell whose latest time has several values, the one that
    wins too. Edits are brought into one map a key, and the table is joined
    with them once.
    """
    types = {c: df.schema[c].dataType for c in editable}
    told = edits.select("key", "column", F.nullif(F.trim("value"), F.lit("")).alias("value"), "time", "author")
    fits = F.col("value").isNull()
    for c, t in types.items():
        fits = fits | ((F.col("column") == c) & F.col("value").try_cast(t).isNotNull())
    known = F.col("column").isin(list(editable))
    good = told.where(F.coalesce(known & fits, F.lit(False)))
    cell = F.struct("value", "author", "time")
    last = good.groupBy("key", "column").agg(F.max_by(cell, F.struct("time", "author", "value")).alias("cell"))
    by_key = last.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("column", "cell"))).alias("_edits"))
    met = df.alias("l").join(by_key.alias("r"), F.col(f"l.`{key}`") == F.col("r.key"), "left")

    def edited(c: str):
        own = F.col(f"l.`{c}`")
        if c not in types:
            return own
        there = F.coalesce(F.map_contains_key("_edits", F.lit(c)), F.lit(False))
        return F.when(there, F.col("_edits")[c]["value"].try_cast(types[c])).otherwise(own).alias(c)

    was = F.create_map(*[x for c in editable for x in (F.lit(c), F.col(f"l.`{c}`").cast("string"))])
    origin = F.transform_values("_edits", lambda c, e: F.struct(e["author"].alias("author"), e["time"].alias("time"),
        F.element_at(was, c).alias("was")))
    out = met.select(*[edited(c) for c in df.columns], origin.alias("origin"))

    at_last = good.join(last.select("key", "column", F.col("cell.time").alias("_time")), ["key", "column"]).where(
        F.col("time").eqNullSafe(F.col("_time")))
    several = at_last.groupBy("key", "column").agg(F.count_distinct(F.struct("value")).alias("n")).where("n > 1")
    wrong = F.lit("unknown column")
    for c, t in types.items():
        wrong = F.when(F.col("column") == c, f"not a {t.simpleString()}").otherwise(wrong)
    lost = told.where(~F.coalesce(known & fits, F.lit(False))).withColumn("reason", wrong)
    keys = df.select(named(key).alias("key")).distinct()
    return out, lost.unionByName(good.join(keys, "key", "left_anti").withColumn("reason", F.lit("unknown key"))).unionByName(
        at_last.join(several, ["key", "column"], "left_semi").drop("_time").withColumn("reason", F.lit("conflict")))
