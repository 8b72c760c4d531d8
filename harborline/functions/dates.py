"""Date scalars; the day of reference is always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "M/d/yyyy H:mm", "MM-yyyy", "dd-MMM-yyyy")


def parse_date(c: Column, formats: Sequence[str] = FORMATS) -> Column:
    """The first format that fits; otherwise null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def year_month(c: Column) -> Column:
    """YYYYMM as a whole number."""
    return F.year(c) * 100 + F.month(c)


def days_late(due: Column, remaining: Column, as_of: str) -> Column:
    """Whole days past due, at least 0; null without a date or with nothing remaining."""
    late = F.datediff(F.lit(as_of).cast("date"), due)
    return F.when(due.isNotNull() & (remaining > 0), F.greatest(late, F.lit(0)))
