"""Mixing sources to target weights by hash-threshold histograms.

Only native expressions, and nothing but the small source plan is ordered.
Each document has a 48-bit hash of its id and text. Words are summed by source
and leading hash digits; the bucket in which a source's budget ends is summed
again by the next digits, and so on. The result is one threshold a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, settle, whole_row

#: Hex digits a level: 4096 buckets, four levels.
DIGITS, LEVELS = 3, 4


def word_count(text):
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixing_plan(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, size), one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words; no target exceeds ``most`` times its source, and
    what is above is shared again by weight. Filled in order of cap over
    weight, a source is capped if its fair share of what is left reaches its
    cap. The windows see one summary row for each source.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    every = W.partitionBy()
    filled = W.orderBy("ratio", "place")
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    onwards = filled.rowsBetween(0, W.unboundedFollowing)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    plan = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", w)
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
        .withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(onwards))
        .withColumn("full", F.col("cap") * F.col("open_weight") <= F.col("weight") * (F.col("budget") - F.col("spent")))
        .withColumn("spent", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0)))
        .withColumn("open_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
    )
    fair = F.col("weight") * (F.col("budget") - F.col("spent")) / F.col("open_weight")
    return plan.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(fair).alias("target"))


def _thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, edge, edge_in, rounds) by nested histograms.

    A document is taken ``rounds`` times, and once more if its key is under
    ``edge`` (or is ``edge``, if ``edge_in``).
    """
    size = F.greatest(F.col("source_size"), F.lit(1))
    state = settle(
        plan.where("source_size > 0")
        .withColumn("rounds", F.floor(F.col("target") / size).cast("long"))
        .select("source", "rounds", (F.col("target") - F.col("rounds") * size).alias("left"), F.lit("").alias("edge"))
    )
    inside = sizes.where("size > 0")
    for level in range(1, LEVELS + 1):
        s = state.select(F.col("source").alias("src"), "edge", "left")
        held = inside.join(s, F.col("source").eqNullSafe(F.col("src")) & F.col("key").startswith(F.col("edge")))
        counted = held.groupBy("source", "left", F.substring("key", 1, DIGITS * level).alias("bucket")).agg(
            F.sum("size").alias("size")
        )
        run = W.partitionBy("source").orderBy("bucket")
        below = counted.withColumn("upto", F.sum("size").over(run)).where(F.col("upto") > F.col("left"))
        cut = below.groupBy("source").agg(
            F.min(F.struct("bucket", "size", (F.col("left") - F.col("upto") + F.col("size")).alias("left"))).alias("c")
        )
        c = cut.select(F.col("source").alias("src"), "c")
        state = settle(
            state.join(c, F.col("source").eqNullSafe(F.col("src"))).select(
                "source", "rounds", F.col("c.left").alias("left"), F.col("c.bucket").alias("edge"),
                    F.col("c.size").alias("size")
            )
        )
    edge_in = F.col("size") - F.col("left") < F.col("left")
    return state.select("source", "rounds", "edge", edge_in.alias("edge_in"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep_row: bool = True,
) -> DataFrame:
    """(doc, size, source_size, target, taken) for each row of ``docs``.

    ``taken`` is the number of words the mix takes of the document, a whole
    multiple of its size: 0, 1 or (with ``most`` 2) 2 times. The last document
    within a budget is taken if that brings the source nearer to its target.
    Null text has size 0; a null source is a source; a null id is hashed like
    any other. Rows with the same id and text share one hash and so one fate.
    An empty table gives an empty table. With ``keep_row`` false ``doc`` has
    the id alone and no text is shuffled.
    """
    row = whole_row(docs) if keep_row else F.struct(F.col(id_col))
    key = F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        F.coalesce(F.md5(F.col(text_col)), F.lit("")))), 1, DIGITS * LEVELS)
    base = docs.select(row.alias("doc"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        key.alias("key"))
    sizes = settle(base if not keep_row else base.drop("doc"))
    plan = settle(mixing_plan(sizes, weights, share, most))
    cut = _thresholds(sizes, plan)
    both = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("p.source").alias("src"), "source_size", "target",
        F.coalesce("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))),
            F.lit(0)).cast("long").alias("rounds"),
        F.coalesce("edge", F.lit("")).alias("edge"), F.coalesce("edge_in", F.lit(False)).alias("edge_in"),
    )
    rows = base if keep_row else sizes
    met = rows.join(both, F.col("source").eqNullSafe(F.col("src")))
    once_more = (F.col("key") < F.col("edge")) | ((F.col("key") == F.col("edge")) & F.col("edge_in"))
    taken = F.col("size") * (F.col("rounds") + F.when(once_more, 1).otherwise(0))
    return met.select("doc", "size", "source_size", "target", taken.alias("taken"))
