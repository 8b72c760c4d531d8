"""Quality gates: one aggregation an entity, verdicts as rows, publish decision.

Every gate is a (failed, checked) pair of aggregates over the same frame, so an
entity is scanned once for all of them. A verdict row has the same columns for
gates and for source conflicts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BLOCKING, WARNING = "blocking", "warning"


@dataclass(frozen=True)
class Gate:
    """``failed`` and ``checked`` are aggregates; it fails if failed > allowed * checked."""

    name: str
    severity: str
    failed: Column
    checked: Column
    allowed: float = 0.0
    message: str = ""


def min_rows(least: int = 1) -> Gate:
    n = F.count(F.lit(1))
    return Gate("min_rows", BLOCKING, F.when(n < least, F.lit(least) - n).otherwise(F.lit(0)), n,
        message=f"fewer than {least} rows")


def no_null_keys(df: DataFrame, keys: Sequence[str], allowed: float = 0.0) -> list[Gate]:
    """One gate a key; a key column that is absent fails on every row."""
    n = F.count(F.lit(1))
    return [
        Gate(f"no_null_keys:{k}", BLOCKING, F.count_if(F.col(k).isNull()) if k in df.columns else n, n, allowed,
            f"{k} is null" if k in df.columns else f"{k} is absent")
        for k in keys
    ]


def known_members(df: DataFrame, key: str, marker: str, allowed: float = 0.02) -> Gate:
    """Non-null keys that the dimension lacks: rows whose ``marker``, taken from it, is null."""
    if key not in df.columns or marker not in df.columns:
        return Gate(f"known_members:{key}", WARNING, F.lit(0).cast("long"), F.count(F.lit(1)),
            message=f"{key} is absent")
    bad = F.count_if(F.col(key).isNotNull() & F.col(marker).isNull())
    return Gate(f"known_members:{key}", BLOCKING, bad, F.count(F.lit(1)), allowed, f"{key} is not in the dimension")


def non_negative(columns: Sequence[str]) -> list[Gate]:
    return [Gate(f"non_negative:{c}", WARNING, F.count_if(F.col(c) < 0), F.count(F.col(c)), message=f"{c} is negative")
        for c in columns]


def _metrics(gates: Sequence[Gate]) -> list[Column]:
    """Two aggregates a gate, f0, c0, f1, ...: rows that fail it and rows that it looks at."""
    return [F.coalesce(c, F.lit(0)).cast("long").alias(f"{s}{i}") for i, g in enumerate(gates) for s, c in (("f", g.failed),
        ("c", g.checked))]


def observed(df: DataFrame, gates: Sequence[Gate]) -> tuple[DataFrame, Observation]:
    """``df`` that counts for all gates while it is written, and where the counts will be."""
    counts = Observation()
    return df.observe(counts, *_metrics(gates)), counts


def told(spark: SparkSession, source: str, entity: str, gates: Sequence[Gate], counts: Mapping[str, int]) -> DataFrame:
    """Verdict rows from the counts that a write has observed; of the same columns as ``evaluate``."""
    rows = [(f"{source}:{entity}:{g.name}", g.name, g.severity, counts[f"f{i}"], counts[f"c{i}"],
        counts[f"f{i}"] <= g.allowed * counts[f"c{i}"], g.message) for i, g in enumerate(gates)]
    return spark.createDataFrame(rows, "exception_id string, gate string, severity string, failed bigint, checked bigint, "
        "passed boolean, message string")


def evaluate(df: DataFrame, source: str, entity: str, gates: Sequence[Gate]) -> DataFrame:
    """One verdict row a gate, from one aggregation."""
    one = df.agg(*_metrics(gates))
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{source}:{entity}:{g.name}").alias("exception_id"),
                F.lit(g.name).alias("gate"), F.lit(g.severity).alias("severity"),
                F.col(f"f{i}").alias("failed"), F.col(f"c{i}").alias("checked"),
                (F.col(f"f{i}") <= F.lit(g.allowed) * F.col(f"c{i}")).alias("passed"),
                    F.lit(g.message).alias("message"),
            )
            for i, g in enumerate(gates)
        ]
    )
    return one.select(F.explode(rows).alias("g")).select("g.*")


def unique_grain(df: DataFrame, source: str, entity: str, grain: Sequence[str]) -> DataFrame:
    """Verdict on duplicate keys: all rows that share a key count; nulls are equal."""
    twice = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    one = twice.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"))
    name = "unique_grain"
    return one.select(
        F.lit(f"{source}:{entity}:{name}").alias("exception_id"), F.lit(name).alias("gate"),
            F.lit(BLOCKING).alias("severity"),
        "failed", "checked", (F.col("failed") == 0).alias("passed"),
            F.lit("rows share " + " x ".join(grain)).alias("message"),
    )


def verdict(failing: DataFrame, checked: DataFrame, source: str, entity: str, name: str, message: str,
    severity: str = BLOCKING) -> DataFrame:
    """One verdict row for a gate whose offenders are a frame: how many there are, of how many checked."""
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    return n(failing, "failed").crossJoin(n(checked, "checked")).select(  # one row each
        F.lit(f"{source}:{entity}:{name}").alias("exception_id"), F.lit(name).alias("gate"),
            F.lit(severity).alias("severity"),
        "failed", "checked", (F.col("failed") == 0).alias("passed"), F.lit(message).alias("message"),
    )


def orphans(facts: DataFrame, items: DataFrame, key: str, crosswalk: DataFrame | None = None) -> DataFrame:
    """(key, n_rows): keys of the facts that ``items`` lacks, after ``crosswalk`` (key, mapped) has renamed them.

    A null key is no orphan: ``no_null_keys`` is for that. Rows are counted
    before the join, so a frequent key is one row there.
    """
    counted = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    named = counted.withColumn("_name", F.col(key))
    if crosswalk is not None:
        named = counted.join(crosswalk.select(F.col(key), F.col("mapped").alias("_mapped")), key, "left").select(key,
            "n_rows", F.coalesce("_mapped", key).alias("_name"))
    return named.join(items.select(F.col(key).alias("_name")).distinct(), "_name", "left_anti").select(key, "n_rows")


def stale(snapshots: DataFrame, source: str, as_of: str, today: Column, most_days: int = 7) -> DataFrame:
    """(source, data_as_of, age_days, stale) by source; a source without any date has an unknown age and isn't stale."""
    last = snapshots.groupBy(source).agg(F.max(as_of).cast("date").alias("data_as_of"))
    age = F.datediff(today.cast("date"), "data_as_of")
    return last.select(source, "data_as_of", age.alias("age_days"),
        F.coalesce(age > most_days, F.lit(False)).alias("stale"))


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def incomplete_transit(lines: DataFrame, container: str = "container", eta: str = "eta") -> DataFrame:
    """Lines in transit with neither a container nor an expected arrival."""
    return lines.where(_blank(container) & F.col(eta).isNull())


def over_allocated(allocated: DataFrame, supplies: Sequence[tuple[DataFrame, str]], key: str,
    quantity: str) -> DataFrame:
    """(key, allocated, supply): keys with more allocated than all supplies hold together.

    ``supplies`` are frames with their quantity columns, say stock, in transit
    and on order. Each is summed by key before they meet.
    """
    parts = [allocated.select(key, F.col(quantity).alias("allocated"), F.lit(0).alias("supply"))]
    parts += [df.select(key, F.lit(0).alias("allocated"), F.col(c).alias("supply")) for df, c in supplies]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return every.groupBy(key).agg(total("allocated"), total("supply")).where("allocated > supply")


def unit_mismatches(lines: DataFrame, key: str, unit: str, quantities: Sequence[str]) -> DataFrame:
    """(key, units, undeclared): keys with more than one unit of measure, or with quantities that have none."""
    some = F.lit(False)
    for c in quantities:
        some = some | F.col(c).isNotNull()
    found = lines.groupBy(key).agg(F.countDistinct(F.upper(F.trim(F.col(unit)))).alias("units"),
        F.count_if(some & _blank(unit)).alias("undeclared"))
    return found.where("units > 1 or undeclared > 0")


def undeclared_money(rows: DataFrame, amounts: Sequence[str], currency: str) -> DataFrame:
    """Rows with an amount and no currency."""
    some = F.lit(False)
    for c in amounts:
        some = some | F.col(c).isNotNull()
    return rows.where(some & _blank(currency))


def unresolved(conflicts: DataFrame, precedence: DataFrame, rule: str = "gate") -> DataFrame:
    """Conflicts whose ``rule`` has no entry in ``precedence``, which says which side wins."""
    return conflicts.join(precedence.select(rule).distinct(), rule, "left_anti")


def offenders(df: DataFrame, bad: Column, order: Sequence[str], n: int = 5) -> DataFrame:
    """A few rows that offend, the same ones each time."""
    return df.where(bad).orderBy(*order).limit(n)


def exceptions(verdicts: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """Failed verdicts and conflicts in one table."""
    failed = verdicts.where(~F.col("passed"))
    return failed if conflicts is None else failed.unionByName(conflicts, allowMissingColumns=True)


def may_publish(verdicts: DataFrame) -> bool:
    """False if a blocking gate failed."""
    return verdicts.where((F.col("severity") == BLOCKING) & ~F.col("passed")).limit(1).count() == 0
