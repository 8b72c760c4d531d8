"""Date ranges: overlaps and gaps of validity, values in force with their end dates, range joins.

A range is [since, until): it holds from its first day to the day before
``until``; a null ``until`` is open, a null ``since`` has held always. Both are
dates. A range that ends where it begins, or before, holds on no day.

Sweeps order the distinct days of a key, which the calendar bounds, after all
ranges that begin or end on one day have been added up. Joins on ranges are
equi-joins on (key, bin of ``WIDTH`` days), checked exactly; ranges are cut to
the days that the other side has before they are put into bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import named

#: Days of a bin.
WIDTH = 32
_FIRST, _LAST = "0001-01-01", "9999-12-31"


def _ranges(df: DataFrame, since: str, until: str, first=_FIRST, last=_LAST) -> DataFrame:
    """``df`` with ``_from`` and ``_to``, open ends as the first and last day of the calendar; empty ranges go."""
    days = lambda c, other: F.coalesce(named(c).cast("date"), F.lit(other).cast("date"))
    return df.withColumn("_from", days(since, first)).withColumn("_to", days(until, last)).where("_from < _to")


def _depths(df: DataFrame, by: Sequence[str], since: str, until: str) -> DataFrame:
    """(by, at, depth, next): how many ranges hold from ``at`` to before ``next``, the next day of a change."""
    keys = [named(c) for c in by]
    edge = F.explode(F.array(F.struct(F.col("_from").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("_to").alias("at"), F.lit(-1).alias("step")))).alias("e")
    days = _ranges(df, since, until).select(*keys, edge).groupBy(*keys, F.col("e.at").alias("at")).agg(
        F.sum("e.step").alias("step"))
    sweep = W.partitionBy(*keys).orderBy("at")
    return days.select(*keys, "at", F.sum("step").over(sweep.rowsBetween(W.unboundedPreceding, 0)).alias("depth"),
        F.lead("at").over(sweep).alias("next"))


def validity_issues(df: DataFrame, by: Sequence[str], since: str, until: str) -> DataFrame:
    """(by, kind, since, until, depth): each longest stretch of days on which ranges of a key overlap, or none holds.

    A gap lies between two ranges; before the first and after the last there is
    none. ``depth`` is the most ranges that hold at once, 0 in a gap.
    """
    keys = [named(c) for c in by]
    sweep = W.partitionBy(*keys).orderBy("at")
    kind = F.when(F.col("depth") > 1, "overlap").when(F.col("depth") == 0, "gap").otherwise("one")
    seen = _depths(df, by, since, until).where(F.col("next").isNotNull()).withColumn("kind", kind)
    begins = ~F.col("kind").eqNullSafe(F.lag("kind").over(sweep))
    runs = seen.withColumn("_run", F.sum(begins.cast("int")).over(sweep))
    found = runs.where("kind <> 'one'").groupBy(*keys, "_run", "kind").agg(F.min("at").alias("since"),
        F.max("next").alias("until"), F.max("depth").alias("depth"))
    return found.drop("_run")


def join_in_range(points: DataFrame, ranges: DataFrame, on: Sequence[str], at: str, since: str, until: str,
    take: Sequence[str], how: str = "inner") -> DataFrame:
    """Points with ``take`` of every range of their key that holds on their day, a row for each.

    Of the points' days the first and last are read (a job of one row), so that
    an open range fills no bins beyond them. A hot key is split by its bins.
    """
    first, last = points.agg(F.min(named(at).cast("date")), F.max(named(at).cast("date"))).first()
    bin_of = lambda day: F.floor(F.unix_date(day) / WIDTH)
    low = F.greatest(F.col("_from"), F.lit(first).cast("date"))
    high = F.least(F.date_sub("_to", 1), F.lit(last).cast("date"))
    put = _ranges(ranges, since, until).where(low <= high).select(*[named(c).alias(f"_{c}") for c in on], "_from", "_to",
        *[named(c).alias(f"_take_{c}") for c in take], F.explode(F.sequence(bin_of(low), bin_of(high))).alias("_bin"))
    cond = (bin_of(named(at).cast("date")) == F.col("_bin")) & (F.col("_from") <= named(at).cast("date")) & (
        named(at).cast("date") < F.col("_to"))
    for c in on:
        cond = cond & (named(c) == named(f"_{c}"))
    return points.join(put, cond, how).select(*map(named, points.columns), *[named(f"_take_{c}").alias(c) for c in take])


def pieces(rates: DataFrame, on: Sequence[str], since: str, until: str, values: Sequence[str]) -> DataFrame:
    """(on, since, until, values): stretches that don't overlap, each with the values of the latest range that holds.

    A range that ends gives way to an earlier one that still holds. Of ranges
    that begin on one day the one with the larger values counts. The first and
    last day that any range names are read (a job of one row), so that open
    ends fill no bins beyond them.
    """
    keys = [named(c) for c in on]
    day = lambda c: named(c).cast("date")
    low, high = rates.agg(F.min(F.least(day(since), day(until))), F.max(F.greatest(day(since), day(until)))).first()
    first = F.date_sub(F.lit(low).cast("date"), 1) if low else F.lit(_FIRST).cast("date")
    last = F.date_add(F.lit(high).cast("date"), 1) if high else F.date_add(first, 1)
    held = _ranges(rates, since, until, first, last).select(*keys, F.col("_from").alias("_since"), F.col("_to").alias(
        "_until"), F.struct("_from", *map(named, values)).alias("_held"))
    cut = _depths(held, on, "_since", "_until").where("depth > 0").select(*keys, F.col("at").alias("_at"),
        F.col("next").alias("_next"))
    met = join_in_range(cut, held, on, "_at", "_since", "_until", ["_held"])
    best = met.groupBy(*keys, "_at", "_next").agg(F.max("_held").alias("_held"))
    return best.select(*keys, F.nullif(F.col("_at"), first).alias(since), F.nullif(F.col("_next"), last).alias(until),
        *[F.col(f"_held.`{c}`").alias(c) for c in values])


def in_force(facts: DataFrame, rates: DataFrame, on: Sequence[str], when: str, since: str, until: str,
    values: Sequence[str]) -> DataFrame:
    """Facts with the values in force on their day and the range's end; null where none is. End dates hold."""
    return join_in_range(facts, pieces(rates, on, since, until, values), on, when, since, until, [*values, until], "left")


def sum_in_range(rows: DataFrame, facts: DataFrame, on: Sequence[str], at: str, since: str, until: str,
    sums: dict[str, Column]) -> DataFrame:
    """``rows`` with sums over the facts of their key whose day lies in the row's own range; 0 where none does.

    Facts of one key and day are added up first. Equal rows are looked up once.
    """
    keys = [named(c) for c in on]
    days = facts.groupBy(*keys, named(at).cast("date").alias("_at")).agg(*[c.alias(n) for n, c in sums.items()])
    asked = rows.select(*keys, named(since).alias("_since"), named(until).alias("_until")).distinct()
    met = join_in_range(days, asked, on, "_at", "_since", "_until", ["_since", "_until"])
    got = met.groupBy(*keys, "_since", "_until").agg(*[F.sum(named(n)).alias(f"_sum_{n}") for n in sums])
    same = F.col("l._since_").eqNullSafe(F.col("r._since")) & F.col("l._until_").eqNullSafe(F.col("r._until"))
    for c in on:
        same = same & (F.col(f"l.`{c}`") == F.col(f"r.`{c}`"))
    l = rows.withColumn("_since_", named(since)).withColumn("_until_", named(until)).alias("l")
    return l.join(got.alias("r"), same, "left").select(*[F.col(f"l.`{c}`") for c in rows.columns],
        *[F.coalesce(F.col(f"r.`_sum_{n}`"), F.lit(0)).alias(n) for n in sums])
