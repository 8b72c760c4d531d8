"""Unpivots and ragged unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str,
    keep_null: bool = True) -> DataFrame:
    """Listed columns to rows; nulls stay or go."""
    out = df.unpivot(list(ids), list(values), name, value)
    return out if keep_null else out.where(F.col(value).isNotNull())


def unpivot_others(df: DataFrame, ids: Sequence[str], name: str, value: str) -> DataFrame:
    """All columns but ``ids`` to rows, nulls dropped."""
    return unpivot(df, ids, [c for c in df.columns if c not in ids], name, value, keep_null=False)


def union_ragged(*frames: DataFrame) -> DataFrame:
    """Union by name; what a frame lacks is null."""
    first, *rest = (f.toDF(*f.columns) for f in frames)
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def move_first(df: DataFrame, *columns: str) -> DataFrame:
    """Named columns first, all others after them in order."""
    return df.select(*columns, *[c for c in df.columns if c not in columns])
