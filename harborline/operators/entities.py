"""Canonical entities from typed exports: inventory, open orders, allocation."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import floor_zero
from ..functions.text import canonical_sku
from . import gates
from .aggregates import first_known, total
from .joins import many_to_one
from .reshape import unpivot

#: Side of supply to owner.
OWNERS = {"consigned": "consigned", "company": "company_paid", "vendor": "vendor_owned"}


@dataclass
class EntityBuild:
    """A lazy entity with its grain and gates, and how its source's conflicts follow from its rows."""

    frame: DataFrame
    grain: list[str]
    checks: list[gates.Gate] = field(default_factory=list)
    name: str = ""
    conflicts_of: Callable[[DataFrame], DataFrame] | None = None
    notes: list[str] = field(default_factory=list)

    def on(self, frame: DataFrame) -> EntityBuild:
        """The same over another frame, such as its written table."""
        return replace(self, frame=frame)

    @property
    def conflicts(self) -> DataFrame | None:
        return self.conflicts_of(self.frame) if self.conflicts_of else None

    @property
    def duplicates(self) -> DataFrame:
        return gates.unique_grain(self.frame, self.name, self.name, self.grain)

    @property
    def verdicts(self) -> DataFrame:
        return gates.evaluate(self.frame, self.name, self.name, self.checks).union(self.duplicates)

    def exceptions(self) -> DataFrame:
        return gates.exceptions(self.verdicts, self.conflicts)


def map_values(column, mapping: dict[str, str]):
    """Dictionary lookup; what isn't in it is null."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), column)


def inventory_onhand(export: DataFrame, locations: DataFrame, zero_fill: bool = False) -> EntityBuild:
    """Stock by sku and location.

    ``export``: item, location_id, on_hand, available, average_cost, lead_time,
    description, row_id; ``locations``: location_id, regional_id, supply_side.
    """
    grain = ["sku", "location_id"]
    frame = (
        export.withColumn("sku", canonical_sku(F.col("item")))
        .groupBy(*grain)
        .agg(
            total(F.col("on_hand"), zero_fill).alias("on_hand"),
            total(F.col("available"), zero_fill).alias("available"),
            F.max("average_cost").alias("average_cost"),
            F.avg("lead_time").alias("lead_time"),
            first_known(F.col("description"), F.col("row_id")).alias("description"),
            F.count(F.lit(1)).alias("source_rows"),
        )
    )
    frame = many_to_one(frame, locations, "location_id").withColumn("ownership",
        map_values(F.col("supply_side"), OWNERS))
    checks = [
        gates.min_rows(), *gates.no_null_keys(frame, ["sku", "location_id"]),
        gates.known_members(frame, "location_id", "regional_id"), *gates.non_negative(["on_hand", "available"]),
    ]
    return EntityBuild(frame, grain, checks, "inventory")


def open_po(export: DataFrame) -> EntityBuild:
    """Open purchase order lines, what remains computed again.

    ``export``: po_number, po_line, item, ordered, received, remaining, closed.
    A source that states another remainder is a conflict; neither side wins.
    """
    grain = ["po_number", "po_line"]
    received = F.coalesce("received", F.lit(0))
    frame = export.select(
        *grain, canonical_sku(F.col("item")).alias("sku"), "ordered", received.alias("received"),
        floor_zero(F.col("ordered") - received).alias("qty_remaining"), F.col("remaining").alias("stated_remaining"),
        F.coalesce(F.lower(F.trim("closed")).isin("yes", "true", "t", "y"), F.lit(False)).alias("is_closed"),
    )
    conflicts = lambda rows: rows.where(F.coalesce("qty_remaining", F.lit(0)) != F.coalesce("stated_remaining", F.lit(0))).select(
        F.concat(F.lit("open_po:remaining:"), F.coalesce(F.col("po_number").cast("string"), F.lit("")), F.lit("|"),
            F.coalesce(F.col("po_line").cast("string"), F.lit(""))).alias("exception_id"),
        F.lit("remaining_mismatch").alias("gate"), F.lit("warning").alias("severity"),
        F.col("qty_remaining").cast("string").alias("left_value"),
            F.col("stated_remaining").cast("string").alias("right_value"),
        (F.coalesce("qty_remaining", F.lit(0)) - F.coalesce("stated_remaining", F.lit(0))).cast("double")
            .alias("delta"),
    )
    checks = [gates.min_rows(), *gates.no_null_keys(frame, ["po_number", "sku"]),
        *gates.non_negative(["qty_remaining"])]
    return EntityBuild(frame, grain, checks, "open_po", conflicts)


def allocation(export: DataFrame, channels: dict[str, str] | None = None) -> EntityBuild:
    """Allocation by sku and channel from one column a channel; no number is zero.

    ``export``: name and a column for each key of ``channels``, which gives the
    channels' codes; without it every other whole-number column is a channel,
    its code the header's letters and digits.
    """
    if channels is None:
        whole = ("bigint", "int", "smallint", "tinyint")
        channels = {c: re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") for c, t in export.dtypes if t in whole
            and c not in ("name", "row_id")}
    grain = ["sku", "region_channel"]
    frame = unpivot(export.withColumn("sku", canonical_sku(F.col("name"))), ["sku"], list(channels), "channel_column",
        "qty").select(
        "sku", map_values(F.col("channel_column"), channels).alias("region_channel"),
        F.coalesce("qty", F.lit(0)).alias("qty_allocated"), F.lit("launch_control").alias("basis"),
    )
    checks = [gates.min_rows(), *gates.no_null_keys(frame, grain), *gates.non_negative(["qty_allocated"])]
    return EntityBuild(frame, grain, checks, "allocation")


#: Export slug to builder: the extension point.
BUILDERS: dict[str, Callable[..., EntityBuild]] = {"inventory": inventory_onhand, "open_po": open_po,
    "allocation": allocation}


#: Columns of an entity that are quantities of goods, and that are money.
QUANTITIES = ("on_hand", "available", "ordered", "received", "qty_remaining", "qty_allocated", "qty")
MONEY = ("unit_price", "amount", "average_cost", "standard_cost")


def cross_checks(built: dict[str, EntityBuild], items: DataFrame | None = None, precedence: DataFrame | None = None,
    crosswalk: DataFrame | None = None, today: str | None = None, most_days: int = 7) -> DataFrame | None:
    """Verdicts of the gates beyond one entity's own, those for which all that they need is there.

    Orphans need ``items``, allocation over supply the entities that it
    compares, unresolved conflicts a table of ``precedence``. A snapshot can be
    stale where rows say their source and date, lines in transit are held
    against their ``container`` and ``eta``, quantities against ``uom`` and
    money against ``currency``, in every entity that has these columns.
    """
    out = []
    tell = lambda bad, every, name, gate, why: out.append(gates.verdict(bad, every, name, name, gate, why))
    for name, one in built.items():
        rows, has = one.frame, set(one.frame.columns)
        if items is not None:
            tell(gates.orphans(rows, items, "sku", crosswalk), rows.select("sku").distinct(), name, "orphan_sku",
                "sku is no item")
        if {"source_slug", "data_as_of"} <= has:
            day = F.lit(today).cast("date") if today else F.current_date()
            aged = gates.stale(rows, "source_slug", "data_as_of", day, most_days)
            tell(aged.where("stale"), aged, name, "stale_snapshot", f"older than {most_days} days")
        if {"container", "eta"} <= has:
            tell(gates.incomplete_transit(rows), rows, name, "in_transit_complete", "neither container nor eta")
        amounts = [c for c in QUANTITIES if c in has]
        if {"sku", "uom"} <= has and amounts:
            tell(gates.unit_mismatches(rows, "sku", "uom", amounts), rows.select("sku").distinct(), name, "uom_mismatch",
                "no unit of measure, or several")
        money = [c for c in MONEY if c in has]
        if "currency" in has and money:
            tell(gates.undeclared_money(rows, money, "currency"), rows, name, "currency_undeclared",
                "an amount has no currency")
    if "allocation" in built and "inventory" in built:
        supplies = [(built["inventory"].frame, "on_hand")]
        if "in_transit" in built:
            supplies.append((built["in_transit"].frame, "qty"))
        if "open_po" in built:
            supplies.append((built["open_po"].frame.where("not is_closed"), "qty_remaining"))
        given = built["allocation"].frame
        bad = gates.over_allocated(given, supplies, "sku", "qty_allocated")
        tell(bad, given.select("sku").distinct(), "allocation", "allocation_over_supply", "more is allocated than there is")
    if precedence is not None:
        for name, one in built.items():
            if (conflicts := one.conflicts) is not None:
                tell(gates.unresolved(conflicts, precedence), conflicts, name, "unresolved_conflict",
                    "no rule says which side wins")
    every = None
    for v in out:
        every = v if every is None else every.unionByName(v)
    return every


def percentiles(df: DataFrame, by: Sequence[str], value: str, approximate: bool = False) -> DataFrame:
    """Median and 90th percentile of a value by group.

    Equal values are counted first, with a combine before the shuffle, so a
    group's state grows with its distinct values, not its rows; approximate
    has bounded state.
    """
    if approximate:
        at = lambda p: F.percentile_approx(value, F.lit(p))
        return df.groupBy(*by).agg(at(0.5).alias("p50"), at(0.9).alias("p90"), F.count(value).alias("n"))
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    at = lambda p: F.percentile(value, F.lit(p), F.col("_n"))
    every = df.select(*by).distinct()
    some = counted.groupBy(*by).agg(at(0.5).alias("p50"), at(0.9).alias("p90"), F.sum("_n").alias("n"))
    same = None
    for c in by:
        one = every[c].eqNullSafe(some[c])
        same = one if same is None else same & one
    return every.join(some, same, "left").select(*[every[c] for c in by], "p50", "p90",
        F.coalesce("n", F.lit(0)).alias("n"))
