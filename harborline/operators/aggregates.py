"""Aggregates whose null and order semantics differ from Spark's own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(c: Column, zero_fill: bool = False) -> Column:
    """Sum; of nothing but nulls it is null, or 0 with ``zero_fill``."""
    return F.coalesce(F.sum(c), F.lit(0)) if zero_fill else F.sum(c)


def exact_total(c: Column, places: int = 4) -> Column:
    """Sum of doubles as decimals of ``places`` decimals, so that the result doesn't depend on the order of rows.

    Whole digits may be 38 - ``places``; a value or a sum beyond that, or one
    that isn't finite, makes the sum null instead of failing the job.
    """
    return F.try_sum(c.try_cast(f"decimal(38,{places})")).cast("double")


def first_known(c: Column, *order: Column) -> Column:
    """The first non-null value by an explicit order."""
    return F.min_by(c, F.when(c.isNotNull(), F.struct(*order)))


def sum_if(cond: Column, c: Column) -> Column:
    """Conditional sum, 0 if no row meets the condition."""
    return F.coalesce(F.sum(F.when(cond, c)), F.lit(0))


def min_if(cond: Column, c: Column) -> Column:
    """Conditional minimum, 0 if no row meets the condition, as spreadsheets have it."""
    return F.coalesce(F.min(F.when(cond, c)), F.lit(0))


def max_if(cond: Column, c: Column) -> Column:
    return F.coalesce(F.max(F.when(cond, c)), F.lit(0))


def dominant(df: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """Each group's most frequent value (ties: the earliest by ``order``, then the smaller), cells and share."""
    counted = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("at"))
    return counted.groupBy(*by).agg(
        F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col("at"), F.col(value))).alias("top"),
        F.sum("n").alias("cells"),
        F.count(F.lit(1)).alias("patterns"),
    ).select(*by, F.col(f"top.{value}").alias(value), "cells", "patterns",
        (F.col("top.n") / F.col("cells")).alias("share"))
