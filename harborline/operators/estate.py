"""Judgements on a swept estate: upstream identity, key roles, bloat, formula maps, order of work."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .aggregates import dominant


def upstream_identity(source: Column, kind: str = "name") -> Column:
    """One name for one upstream however it is written.

    The media id of a file-cabinet address (``media.nl?...id=``) is the
    identity, whatever token goes with it; else a team site or other web
    address without query, else a path's file name, else ``kind`` and the text.
    """
    whole = text.strip_all(source)
    low = F.lower(whole)
    media = F.regexp_extract(whole, r'(?i)media\.nl\?[^"]*?\bid=(\d+)', 1)
    bare = F.regexp_replace(low, r"[?#].*$", "")
    name = F.substring_index(F.regexp_replace(F.translate(low, "\\", "/"), "/+$", ""), "/", -1)
    return (
        F.when(media != "", F.concat(F.lit("media:"), media))
        .when(F.contains(low, F.lit("sharepoint.com")), F.concat(F.lit("sharepoint:"), bare))
        .when(low.rlike("^https?://"), F.concat(F.lit("web:"), bare))
        .when(low.rlike(r"[\\/]"), F.concat(F.lit("file:"), F.when(name != "", name).otherwise(low)))
        .otherwise(F.concat(F.lit(f"{kind}:"), low))
    )


def assign_roles(scores: DataFrame, sheet: str, header: str, role: str, score: str) -> DataFrame:
    """Greedy one-to-one roles: within a sheet the best score is fixed first, then the best of what is left.

    A sheet has as many rows as it has headers times roles, so it fits a task.
    Ties go to the smaller role, then header.
    """

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        taken_h, taken_r, out = set(), set(), []
        for row in pdf.sort_values([score, role, header], ascending=[False, True, True]).itertuples(index=False):
            h, r = getattr(row, header), getattr(row, role)
            if h not in taken_h and r not in taken_r:
                taken_h.add(h)
                taken_r.add(r)
                out.append(row)
        return pd.DataFrame(out, columns=pdf.columns)

    cols = [sheet, header, role, score]
    return scores.select(*cols).groupBy(sheet).applyInPandas(greedy, scores.select(*cols).schema)


def is_bloated(rows: Column, valued: Column, least: int = 5000, share: float = 0.1) -> Column:
    """Many rows, few of which hold a value."""
    return (rows >= least) & (valued < share * rows)


def work_order(df: DataFrame, failed: str, risk: str, rows: str, tie: str) -> DataFrame:
    """Failed sources first, then by falling risk and size."""
    return df.orderBy(F.desc(failed), F.desc_nulls_last(risk), F.desc_nulls_last(rows), tie)


def finding_order(df: DataFrame, severity: str, *rest: str) -> DataFrame:
    """Blocking, warning, info; then the other columns, so that the order is total."""
    rank = F.when(F.col(severity) == "blocking", 0).when(F.col(severity) == "warning", 1).otherwise(2)
    return df.orderBy(rank, *rest)


def nest(left: DataFrame, right: DataFrame, key: str, name: str, order: Sequence[str]) -> DataFrame:
    """Left outer join whose right rows become one array a left row, in order; empty if none.

    The right side is grouped before the join, so left rows aren't multiplied.
    """
    cols = [*order, *[c for c in right.columns if c not in (*order, key)]]
    grouped = right.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))
    out = left.join(grouped, key, "left")
    return out.withColumn(name, F.coalesce(name, F.filter(F.array(F.lit(None)
        .cast(grouped.schema[name].dataType.elementType)), lambda x: x.isNotNull())))


def formula_map(cells: DataFrame, least_formulas: int = 100, least_cells: int = 20,
    consistent: float = 0.98) -> DataFrame:
    """Dominant pattern of every formula column of ``cells`` (path, sheet, row, col, formula).

    Sheets with fewer than ``least_formulas`` are left out. A column is
    suspicious if it is large and inconsistent, unless it is constant.
    """
    f = cells.where(F.col("formula").isNotNull())
    large = f.groupBy("path", "sheet").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_formulas).drop("n")
    f = f.join(large, ["path", "sheet"]).withColumn("pattern", text.formula_pattern(F.col("formula")))
    top = dominant(f, ["path", "sheet", "col"], "pattern", "row")
    odd = (F.col("cells") >= least_cells) & (F.col("share") < consistent) & ~text.is_literal(F.col("pattern"))
    return top.withColumn("suspicious", odd)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, change): rows ``added``, ``removed`` or ``changed`` between two snapshots with one row a key.

    All other columns of ``after`` are compared, by digests: no content is joined.
    """
    rest = [c for c in after.columns if c not in keys]
    digest = lambda df, name: df.select(*keys, F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)
        .alias(name))
    both = digest(after, "_now").join(digest(before, "_then"), list(keys),
        "full").where(~F.col("_now").eqNullSafe(F.col("_then")))
    return both.select(*keys, F.when(F.col("_then").isNull(), "added").when(F.col("_now").isNull(), "removed")
        .otherwise("changed").alias("change"))
