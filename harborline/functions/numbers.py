"""Numeric scalars: parsing, rounding, safe division, cover, clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_all

_PLAIN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def parse_number(c: Column) -> Column:
    """Text as double: thousands commas dropped, (x) is -x, anything else null.

    The guard keeps out what a cast would take: 1d, NaN, inf.
    """
    t = F.replace(strip_all(c), F.lit(","), F.lit(""))
    inner = strip_all(F.regexp_replace(t, r"^\((.*)\)$", "$1"))
    value = F.when(inner.rlike(_PLAIN), inner.try_cast("double"))
    return F.when(t.rlike(r"^\(.*\)$"), -value).otherwise(value)


def parse_whole(c: Column) -> Column:
    """Text as long, half to even."""
    return F.bround(parse_number(c), 0).try_cast("bigint")


def parse_flag(c: Column) -> Column:
    """yes/no words as boolean; unknown is null."""
    t = F.lower(strip_all(c))
    return F.when(t.isin("yes", "true", "t", "y", "1"), True).when(t.isin("no", "false", "f", "n", "0"), False)


def floor_zero(c: Column) -> Column:
    """Negative to zero, null stays null; greatest() would turn null into zero."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def clamp(c: Column, low: float, high: float) -> Column:
    """The median of low, value and high; null stays null."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null if b is zero or null."""
    return F.try_divide(a, F.nullif(b, F.lit(0)))


def months_of_supply(on_hand: Column, forward12: Column, run_rate: Column) -> Column:
    """Cover by the 12-month forecast, else by the run rate; 999 with stock and neither; else 0."""
    return (
        F.when(forward12 > 0, on_hand / (forward12 / 12))
        .when(run_rate > 0, on_hand / run_rate)
        .when(on_hand > 0, F.lit(999.0))
        .otherwise(F.lit(0.0))
    )


def months_of_cover(on_hand: Column, forecast: Column, months: int, trailing: Column,
    trailing_months: int = 3) -> Column:
    """On hand by mean monthly demand: the forecast of ``months`` where there is one, else what was sold lately; null without demand."""
    monthly = F.when(forecast > 0, forecast / F.lit(float(months))).otherwise(trailing / F.lit(float(trailing_months)))
    return F.when(monthly > 0, on_hand / monthly)


def capped_risk(weights_and_hits: list[tuple[float, Column]], most: int = 3) -> Column:
    """Sum of weight times hits, each rule's hits counted ``most`` times at most."""
    total = F.lit(0.0)
    for weight, hits in weights_and_hits:
        total = total + F.lit(float(weight)) * F.least(hits, F.lit(most))
    return total


def risk_band(score: Column) -> Column:
    return F.when(score >= 70, "critical").when(score >= 40, "high").when(score >= 15, "medium").otherwise("low")
