"""Ordered operators: waterfall, duplicates, ABC classes, cumulative totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import floor_zero
from ..functions.text import named


#: Parts that a table is cut into by an order.
PARTS = 64


def cuts(df: DataFrame, order: str, parts: int = PARTS) -> list:
    """Bounds that cut the rows into parts of about one size by ``order``; at most ``parts`` - 1 values.

    Runs a job, a sketch of quantiles. Bounds are literals from then on, so
    that every branch of a plan cuts alike; where rows lie close together, in a
    large group above all, the bounds lie close too.
    """
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    return sorted(set(df.agg(F.percentile_approx(named(order), shares, F.lit(100 * parts))).first()[0] or []))


def part_of(order: Column, bounds: Sequence) -> Column:
    """The part of a row: how many bounds its order has reached; null is -1."""
    if not bounds:
        return F.when(order.isNull(), -1).otherwise(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= order)), F.lit(-1))


def _same(keys: Sequence[str], l: str = "l", r: str = "r") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{l}.`{k}`").eqNullSafe(F.col(f"{r}.`{k}`"))
    return cond


def _prior(sums: DataFrame, by: Sequence[str], order: str, value: str, name: str, bounds: Sequence,
    group: Mapping[str, Column] | None = None) -> DataFrame:
    """``sums`` (one row for each (by, order)) with the sum of ``value`` over lower orders, and ``group`` totals.

    The totals of a group's parts are added up, at most as many rows as there
    are parts, and a window orders one part of one group: no task gets a group.
    """
    keys = [named(c) for c in by]
    cut = sums.withColumn("_part", part_of(named(order), bounds))
    known = F.when(named(order).isNotNull(), named(value))
    every = W.partitionBy(*keys)
    before = every.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    heads = cut.groupBy(*keys, "_part").agg(F.sum(known).alias("_sum"), *[c.alias(n) for n, c in (group or {}).items()])
    over = {n: (F.max(n) if n.startswith("max") else F.sum(n)).over(every) for n in group or {}}
    heads = heads.select(*keys, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        *[c.alias(n) for n, c in over.items()])
    own = W.partitionBy(*keys, "_part").orderBy(named(order)).rowsBetween(W.unboundedPreceding, -1)
    mine = cut.withColumn("_own", F.coalesce(F.sum(known).over(own), F.lit(0)))
    met = mine.alias("l").join(heads.alias("r"), _same(by) & (F.col("l._part") == F.col("r._part")))
    prior = F.when(F.col(f"l.`{order}`").isNull(), F.lit(0)).otherwise(F.col("r._before") + F.col("l._own"))
    return met.select(*[F.col(f"l.`{c}`") for c in (*by, order)], prior.alias(name), *[F.col(f"r.`{n}`") for n in over])


def prior_totals(df: DataFrame, by: Sequence[str], order: str, value: Column, name: str,
    bounds: Sequence | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over rows of the group of strictly lower order; 0 if none.

    Peers don't count. A row without an order counts for no other and gets 0.
    Equal orders are added up before any row is ordered. ``bounds`` cut the
    orders into parts; see ``cuts``, which finds them if none are given.
    """
    bounds = cuts(df, order) if bounds is None else bounds
    sums = df.groupBy(*[named(c) for c in by], named(order)).agg(F.sum(value).alias("_value"))
    got = _prior(sums, by, order, "_value", name, bounds)
    met = df.alias("l").join(got.alias("r"), _same([*by, order]), "left")
    return met.select(*[F.col(f"l.`{c}`") for c in df.columns], F.col(f"r.`{name}`"))


def waterfall(df: DataFrame, by: Sequence[str], order: str, supply: str, held: str, wanted: str,
    quota: str, bounds: Sequence | None = None) -> DataFrame:
    """Base allocation, unmet demand and the sweep of what is left, by priority.

    base = floor(min(quota, max(0, supply - held))); unmet = max(0, wanted - base);
    what supply leaves after all bases is swept to unmet demand in order. Sums
    run over parts of a group, see ``prior_totals``.
    """
    free = floor_zero(named(supply) - named(held))
    out = df.withColumn("base", F.floor(F.least(named(quota), free)).cast("long"))
    out = out.withColumn("unmet", floor_zero(named(wanted) - F.col("base")))
    bounds = cuts(df, order) if bounds is None else bounds
    sums = out.groupBy(*[named(c) for c in by], named(order)).agg(F.sum("unmet").alias("_unmet"),
        F.sum("base").alias("_base"), F.max(free).alias("_free"))
    got = _prior(sums, by, order, "_unmet", "prior_unmet", bounds, {"sum_base": F.sum("_base"), "max_free": F.max("_free")})
    met = out.alias("l").join(got.alias("r"), _same([*by, order]))
    out = met.select(*[F.col(f"l.`{c}`") for c in out.columns],
        floor_zero(F.col("r.max_free") - F.col("r.sum_base")).alias("leftover"), F.col("r.prior_unmet"))
    return out.withColumn("sweep", F.least(F.col("unmet"), floor_zero(F.col("leftover") - F.col("prior_unmet"))))


def duplicated(by: Sequence[str]) -> Column:
    """True on every row whose key occurs more than once; nulls are equal."""
    return F.count(F.lit(1)).over(W.partitionBy(*by)) > 1


def cumulative_share(df: DataFrame, value: str, tie: str) -> DataFrame:
    """``df`` with ``cumulative`` and ``grand``, running from the largest value down.

    Values (whole, not negative) fall into bins by magnitude, sixteen to a
    power of two. A bin's total is added to all that lie below it; only a bin
    is ordered, in its own task, so no window spans the table.
    """
    v = F.col(value)
    binned = df.withColumn("_bin", F.when(v > 0, F.floor(F.log2(v) * 16).cast("int")).otherwise(-1))
    bins = binned.groupBy("_bin").agg(F.sum(value).alias("_sum"))
    above = W.orderBy(F.desc("_bin")).rowsBetween(W.unboundedPreceding, -1)  # at most 1,025 bins
    every = W.partitionBy()
    bins = bins.withColumn("_above", F.coalesce(F.sum("_sum").over(above), F.lit(0))).withColumn("grand",
        F.sum("_sum").over(every))
    own = W.partitionBy("_bin").orderBy(F.desc(value), tie).rowsBetween(W.unboundedPreceding, 0)
    return (
        binned.join(F.broadcast(bins), "_bin")
        .withColumn("cumulative", F.col("_above") + F.sum(value).over(own))
        .drop("_bin", "_sum", "_above")
    )


def ranked(df: DataFrame, by: Sequence[str], value: str, tie: str, name: str = "rank") -> DataFrame:
    """``df`` with the rank of each row in its group, the largest ``value`` first, ties by ``tie``.

    As in ``cumulative_share`` only rows of one bin by magnitude are ordered
    together, so a group of any size is no single task.
    """
    v = named(value)
    place = F.when(v > 0, F.floor(F.log2(v) * 16).cast("int")).when(v.isNotNull(),
        F.lit(-20_000)).otherwise(F.lit(-30_000))
    binned = df.withColumn("_bin", place)
    keyed = [named(c) for c in by]
    bins = binned.groupBy(*keyed, "_bin").agg(F.count(F.lit(1)).alias("_rows"))
    above = W.partitionBy(*keyed).orderBy(F.desc("_bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("_above", F.coalesce(F.sum("_rows").over(above), F.lit(0))).drop("_rows")
    own = W.partitionBy(*keyed, "_bin").orderBy(v.desc_nulls_last(), named(tie))
    keys = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in by]
    met = binned.withColumn("_own", F.row_number().over(own)).alias("l").join(bins.alias("r"),
        [*keys, F.col("l._bin") == F.col("r._bin")])
    return met.select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col("r._above") + F.col("l._own")).alias(name))


def abc_class(cumulative: Column, grand: Column, a: float = 0.8, b: float = 0.95) -> Column:
    """A up to 80 % of the total, B up to 95 %, C beyond."""
    share = F.round(cumulative / grand, 9)
    return F.when(share <= a, "A").when(share <= b, "B").otherwise("C")
