"""Consecutive numbers in a global order, without a task that orders a whole group.

``binned`` cuts all rows into ranges of the order, one to a partition, and
writes them down with the number of their range. ``numbered`` counts the rows
of each group in each range, adds up what lies in earlier ranges, and orders
only the rows of one group and range together. Rows that are the same in all
that orders them are cut apart by the place they were read at, so a group of
equal rows of any size fills several ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, settle


def binned(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df``, settled, with ``_bin`` (number of its range of the order) and ``_tie`` (unique).

    The ranges are found by a sample, which reads the rows once more; they are
    written first, so that what made them isn't run twice.
    """
    tied = settle(df.withColumn("_tie", F.monotonically_increasing_id()))
    out = settle(tied.repartitionByRange(*order, "_tie").withColumn("_bin", F.spark_partition_id()))
    forget(tied)
    return out


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], idx: str = "_idx", n: str = "_n") -> DataFrame:
    """Binned rows with ``idx``, their place in their group from 0 on, and ``n``, the rows of the group.

    ``order`` must be the order of the bins; columns of ``group`` hold no null.
    """
    every = W.partitionBy(*group)
    before = every.orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy(*group, "_bin").agg(F.count(F.lit(1)).alias("_rows")).select(
        *group, "_bin", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_above"),
        F.sum("_rows").over(every).alias(n))
    own = W.partitionBy(*group, "_bin").orderBy(*order, "_tie")
    return rows.withColumn("_own", F.row_number().over(own)).join(counts, [*group, "_bin"]).withColumn(
        idx, F.col("_above") + F.col("_own") - 1).drop("_own", "_above")
