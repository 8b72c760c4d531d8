"""Sketches of a month that add up: quantiles and distinct counts of any window without reading its rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named

#: Size of a quantile sketch: its rank error is under 1.65 % with it, for 99 of 100.
KLL_SIZE = 200
#: Logarithm of a distinct sketch's size (16 KB): its relative error is about 0.8 %, so 6 % are over seven standard errors.
HLL_BITS = 14


def monthly(df: DataFrame, by: Sequence[str], when: str, value: Column, item: Column) -> DataFrame:
    """(by, month, rows, values, items): one row a month, with sketches of a number and of an item's distinct values.

    ``month`` is a whole number, 12 a year. Rows without a date have none and
    go. Nulls are in no sketch. Sketches are made where rows are read and are
    of bounded size, so a month of any size is a few KB of a shuffle.
    """
    day = named(when)
    month = (F.year(day) * 12 + F.month(day) - 1).alias("month")
    return df.where(day.isNotNull()).groupBy(*map(named, by), month).agg(F.count(F.lit(1)).alias("rows"),
        F.kll_sketch_agg_double(value.cast("double"), F.lit(KLL_SIZE)).alias("values"),
        F.hll_sketch_agg(item, F.lit(HLL_BITS)).alias("items"))


def trailing(stored: DataFrame, by: Sequence[str], months: int) -> DataFrame:
    """(by, month, rows, values, items) over each stored month and the ``months`` - 1 before it.

    Only the stored sketches are read: each is part of ``months`` windows, and
    what meets is merged. Months without a row end no window.
    """
    keys = [named(c) for c in by]
    ends = stored.select(*keys, F.col("month").alias("_end")).distinct()
    part = stored.withColumn("_end", F.explode(F.sequence(F.col("month"), F.col("month") + months - 1)))
    met = part.groupBy(*keys, "_end").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("values", F.lit(KLL_SIZE))
        .alias("values"), F.hll_union_agg("items").alias("items"))
    cond = F.col("l._end") == F.col("r._end")
    for c in by:
        cond = cond & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    return met.alias("l").join(ends.alias("r"), cond, "left_semi").select(*[F.col(f"l.`{c}`") for c in by],
        F.col("l._end").alias("month"), "rows", "values", "items")


def trailing_distinct(df: DataFrame, by: Sequence[str], when: str, item: Column, months: int) -> DataFrame:
    """(by, month, step): exact distinct items of every window of ``months`` months, as steps from month to month.

    A window that ends in a month has as many items as the steps up to that
    month add up to. Rows travel once, as the set of months of each item: it is
    in the windows from one of its months to ``months`` later or its next month.
    """
    day = named(when)
    month = F.year(day) * 12 + F.month(day) - 1
    own = df.where(day.isNotNull() & item.isNotNull()).groupBy(*map(named, by), item.alias("_item")).agg(
        F.array_sort(F.collect_set(month)).alias("_months"))
    until = lambda m, i: F.least(m + months, F.get("_months", i + 1))  # noqa: E731  (least passes over null)
    steps = F.flatten(F.transform("_months", lambda m, i: F.array(F.struct(m.alias("month"), F.lit(1).alias("n")),
        F.struct(until(m, i).alias("month"), F.lit(-1).alias("n")))))
    return own.select(*map(named, by), F.inline(steps)).groupBy(*map(named, by), "month").agg(F.sum("n").alias("step"))


def quantile(values: Column, share: float) -> Column:
    """The value at a share of the rows; null if there is none."""
    return F.when(F.kll_sketch_get_n_double(values) > 0, F.kll_sketch_get_quantile_double(values, F.lit(share)))


def distinct(items: Column) -> Column:
    return F.hll_sketch_estimate(items)
