"""The named queries and sheets of the planning workbooks, as functions of typed tables.

What a sheet looks up cell by cell is here one aggregation of each source by
its key, joined once. Names of columns are the functions' own; a caller renames
an export's columns to them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text
from ..functions.dates import year_month
from ..sources.exports import typed
from .aggregates import exact_total, max_if, min_if, sum_if, total
from .entities import map_values
from .joins import ends_with_key, excluding
from .reshape import unpivot


def casts(sheet: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """A sheet of text cells under a contract's types; columns that aren't named keep their text. What doesn't parse is null."""
    return sheet.select(*[typed(F.col(f"`{c}`").cast("string"), types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in sheet.columns])


def month_rows(export: DataFrame, ids: Sequence[str], months: Sequence[str]) -> DataFrame:
    """(ids, month, qty): listed month columns (``... MM-YYYY``) as rows, the month as a date."""
    rows = unpivot(export, list(ids), list(months), "attribute", "qty")
    return rows.select(*ids, F.to_date(F.right("attribute", F.lit(7)), "MM-yyyy").alias("month"), "qty")


def grouped_forecast(rows: DataFrame, groups: Mapping[str, str], lead_groups: Mapping[str, str]) -> DataFrame:
    """(item, allocation_group, month, category, forecast_qty) of rows (item, category, territory, lead_group, month, qty).

    The group is the territory's, else the lead group's. Sums of null or zero are dropped.
    """
    group = F.coalesce(map_values(F.col("territory"), groups), map_values(F.col("lead_group"), lead_groups))
    by = rows.groupBy("item", group.alias("allocation_group"), "month",
        "category").agg(total(F.col("qty")).alias("forecast_qty"))
    return by.where("forecast_qty <> 0")


def full_forecast(rows: DataFrame, lead_groups: Mapping[str, str], sub_locations: Mapping[str, str]) -> DataFrame:
    """Forecast by sku, sub location, month, category, lead group, territory and region, with year and month number.

    The region is that of the lead group, else of the sub location: a map in two steps.
    """
    region = F.coalesce(map_values(F.col("lead_group"), lead_groups), map_values(F.col("sub_location"), sub_locations))
    keys = ["sub_location", "category", "lead_group", "territory"]
    by = rows.groupBy(text.canonical_sku(F.col("item")).alias("sku"), *keys, "month",
        region.alias("region")).agg(total(F.col("qty")).alias("forecast_qty"))
    return by.where("forecast_qty <> 0").select("sku", *keys, "region", F.year("month").alias("year"),
        year_month(F.col("month")).alias("yyyymm"), "forecast_qty")


def regional_inventory(stock: DataFrame, regions: Mapping[str, str]) -> DataFrame:
    """(sku, location, available, region) of stock (name, location, available).

    The sku is what follows the first colon, blanks kept, or the whole name.
    """
    by = stock.groupBy("name", "location").agg(total(F.col("available")).alias("available"))
    sku = F.coalesce(text.after_first(F.col("name"), ":"), F.col("name"))
    return by.select(sku.alias("sku"), "location", "available", map_values(F.col("location"), regions).alias("region"))


def validated_sales(rows: DataFrame, years: Sequence[int], without: Sequence[str]) -> DataFrame:
    """(location, yyyymm, name, year, sku, qty) of sales rows, two years say, without some locations."""
    some = rows.where(F.col("year").isin(*years) & ~F.coalesce(F.col("location").isin(*without), F.lit(False)))
    by = some.groupBy("location", "yyyymm", "name", "year").agg(total(F.col("qty")).alias("qty"))
    return by.withColumn("sku", text.strip_all(text.after_last(F.col("name"), ":")))


def open_orders_by_rep(rows: DataFrame) -> DataFrame:
    """(company, sales_rep, item, mean_rate, discounted, committed, ready, back_order)."""
    by = rows.groupBy("company", "sales_rep", "item")
    sums = {c: exact_total(F.col(c)).alias(c) for c in ("discounted", "committed", "ready", "back_order")}
    return by.agg(F.round(F.avg("rate"), 6).alias("mean_rate"), *sums.values())


def tradeline(territory: Column, lines: Mapping[str, str], default: str | None = None) -> Column:
    """The trade line of a territory."""
    return F.coalesce(map_values(territory, lines), F.lit(default))


def bill_master(bom: DataFrame, prefix: str = "TP ", word: str = "ARC") -> DataFrame:
    """Bill rows with the last parts of parent and member names, and a flag on parents of one kind."""
    tail = lambda c: text.after_last(F.col(c), " : ")
    rows = bom.withColumn("parent_sku", tail("parent")).withColumn("member_sku", tail("member"))
    kind = F.startswith("parent_sku", F.lit(prefix)) & F.contains(F.upper("parent_sku"), F.lit(word.upper()))
    return rows.withColumn("is_kind", F.coalesce(kind, F.lit(False)).cast("int"))


def hold_list(held: DataFrame, stock: DataFrame) -> DataFrame:
    """Held rows (sku, back_order, rate) with the stock on hand (0 if none) and the value held back."""
    by = stock.groupBy("sku").agg(total(F.col("on_hand"), zero_fill=True).alias("on_hand"))
    return held.join(by, "sku", "left").withColumn("on_hand", F.coalesce("on_hand", F.lit(0))).withColumn("value",
        F.col("back_order") * F.col("rate"))


def closure_list(orders: DataFrame, stock: DataFrame, on_order: DataFrame, transfers: str = "TO",
    vendors: Sequence[str] = ()) -> DataFrame:
    """``hold_list`` with what is on purchase: rows (sku, document, vendor, remaining) that are no transfer and of no named vendor."""
    bought = on_order.where(~F.coalesce(F.startswith("document", F.lit(transfers)), F.lit(False)))
    for v in vendors:
        bought = bought.where(~F.coalesce(F.contains(F.lower("vendor"), F.lit(v.lower())), F.lit(False)))
    by = bought.groupBy("sku").agg(total(F.col("remaining"), zero_fill=True).alias("on_order"))
    return hold_list(orders, stock).join(by, "sku", "left").withColumn("on_order", F.coalesce("on_order", F.lit(0)))


def purchase_price(items: DataFrame) -> DataFrame:
    """(sku, parent, category, average_cost): the greatest cost of each (name, parent, category); the sku is the name's
    text after the first colon, or all of it."""
    by = items.groupBy("name", "parent", "category").agg(F.max("average_cost").alias("average_cost"))
    tail = F.coalesce(text.after_first(F.col("name"), ":"), "name")
    return by.select(text.strip_all(tail).alias("sku"), "parent", "category", "average_cost")


def readiness(plan: DataFrame, stock: DataFrame, vendor_stock: DataFrame, production: DataFrame, shipments: DataFrame,
    as_of: str, least: float = 0.85, transit_days: int = 10, ahead_days: int = 45) -> DataFrame:
    """Whether what a launch needs will be there: ten columns for each row of ``plan``.

    ``plan`` (sku, needed, due, own: whether one's own plant makes it),
    ``stock`` and ``vendor_stock`` (sku, qty), ``production`` and ``shipments``
    (sku, day, qty). Production counts up to the due day, shipments that arrive
    by it after ``transit_days``; without a due day all count. What isn't one's
    own has neither vendor stock nor production, and no state.
    """
    by = lambda df, name: df.groupBy("sku").agg(total(F.col("qty"), zero_fill=True).alias(name))

    def due(df: DataFrame, name: str, lag: int) -> DataFrame:
        daily = df.groupBy("sku", "day").agg(F.sum("qty").alias("qty"), F.max("day").alias("last"))
        met = daily.join(plan.select("sku", "due"), "sku")
        ready = F.col("due").isNull() | (F.date_add("day", lag) <= F.col("due"))
        return met.groupBy("sku").agg(sum_if(ready, F.col("qty")).alias(name), F.max("last").alias(f"{name}_last"))

    out = plan.join(by(stock, "on_hand"), "sku", "left").join(by(vendor_stock, "vendor_held"), "sku", "left").join(
        due(production, "made", 0), "sku", "left").join(due(shipments, "arriving", transit_days), "sku", "left")
    some = lambda c: F.coalesce(c, F.lit(0))
    own = lambda c: F.when(F.col("own"), some(F.col(c)))
    out = out.select("sku", "needed", "due", "own", F.date_diff("due", F.lit(as_of).cast("date")).alias("days_to_due"),
        some(F.col("on_hand")).alias("on_hand"), own("vendor_held").alias("vendor_held"), own("made").alias("made"),
        some(F.col("arriving")).alias("arriving"), F.when(F.col("own"), F.col("made_last")).alias("last_made"))
    there = F.col("on_hand") + some(F.col("vendor_held")) + some(F.col("made")) + F.col("arriving")
    wanted = F.coalesce(F.col("needed"), F.lit(0)) != 0
    out = out.withColumn("available", there).withColumn("completion", F.when(wanted, F.col("available") / F.col("needed")))
    ahead = F.col("last_made").isNull() | (F.col("last_made") <= F.date_sub("due", ahead_days))
    state = F.when(~F.col("own") | (F.col("due").isNotNull() & ~wanted), "N/A").when(F.col("due").isNull(),
        "TBD Date").when(F.col("completion") < least, "Behind").when(ahead, "Ahead of Schedule").otherwise("On Track")
    return out.withColumn("state", state).drop("own")


def launch_status(readiness: DataFrame, on_order: DataFrame, least: float = 0.85) -> DataFrame:
    """Readiness rows (sku, name, status, completion) with what is on purchase and a flag on those short of ``least``."""
    by = on_order.groupBy("sku").agg(total(F.col("remaining"), zero_fill=True).alias("po_qty"),
        F.count(F.lit(1)).alias("po_lines"))
    flag = F.when(F.col("completion").isNull(), "no completion data").when(F.col("completion") < least,
        "below target").otherwise("on track")
    out = readiness.join(by, "sku", "left")
    return out.select(*readiness.columns, flag.alias("flag"),
        F.coalesce(F.col("po_lines") > 0, F.lit(False)).alias("po_exists"),
            F.coalesce("po_qty", F.lit(0)).alias("po_qty"))


def container_validation(
    skus: DataFrame, orders: DataFrame, review: DataFrame, stock: DataFrame, forecast: DataFrame, shipments: DataFrame,
        on_order: DataFrame,
    prices: DataFrame, positions: DataFrame, allocations: DataFrame, region: str, months: Sequence[int],
        lanes: Mapping[str, str], eta: dt.date,
    due: tuple[dt.date, dt.date],
) -> DataFrame:
    """What speaks for and against a container, 27 columns for each sku.

    ``orders`` (sku, region, back_order, rate), ``review`` (sku, held, on_po,
    forecast_12m, inv_months, inv_cost, total_inv), ``stock`` (sku, region,
    on_hand), ``forecast`` (sku, region, yyyymm, qty), ``shipments`` (sku,
    lane, qty), ``on_order`` (sku, expected, remaining), ``prices`` and
    ``positions`` (sku, average_cost; of several the least counts),
    ``allocations`` (name that ends with the sku, base_price). ``lanes`` names
    the group of each of two lanes, the first that has goods wins. Each source
    is aggregated once by sku.
    """
    own, paid = F.col("region") == region, F.col("rate") > 0
    o = orders.groupBy("sku").agg(
        sum_if(own, F.col("back_order")).alias("bo_region"), total(F.col("back_order"), zero_fill=True).alias("bo_all"),
        min_if(own & paid, F.col("rate")).alias("rate_min_region"),
            max_if(own & paid, F.col("rate")).alias("rate_max_region"), F.count_if(own & paid).alias("lines_region"),
        min_if(paid, F.col("rate")).alias("rate_min_all"), max_if(paid, F.col("rate")).alias("rate_max_all"),
            F.count_if(paid).alias("lines_all"),
    )
    v = review.groupBy("sku").agg(
        *[F.sum(c).alias(c) for c in ("held", "on_po", "forecast_12m", "inv_months")],
            F.try_divide(F.sum("inv_cost"), F.sum("total_inv")).alias("implied_cost")
    )
    s = stock.groupBy("sku").agg(sum_if(own, F.col("on_hand")).alias("on_hand_region"))
    names = [f"forecast_{m}" for m in months]
    f = forecast.groupBy("sku").agg(*[sum_if(own & (F.col("yyyymm") == m), F.col("qty")).alias(n) for m,
        n in zip(months, names, strict=True)])
    first, second = lanes
    h = shipments.groupBy("sku").agg(sum_if(F.col("lane") == first, F.col("qty")).alias("transit_first"),
        sum_if(F.col("lane") == second, F.col("qty")).alias("transit_second"))
    p = on_order.groupBy("sku").agg(sum_if(F.col("expected").between(F.lit(due[0]), F.lit(due[1])), F.col("remaining"))
        .alias("po_due"))
    c = prices.groupBy("sku").agg(F.min("average_cost").alias("unit_cost"))
    e = positions.groupBy("sku").agg(F.min("average_cost").alias("position_cost"))
    listed = ends_with_key(skus.select("sku"), allocations, "name", "sku", text.after_last(F.col("name"), " : "))
    a = listed.groupBy("sku").agg(F.min("base_price").alias("list_price"))
    out = skus.select("sku")
    for part in (o, v, s, f, h, p, c, e, a):
        out = out.join(part, "sku", "left")
    zero = ["bo_region", "bo_all", "rate_min_region", "rate_max_region", "lines_region", "rate_min_all", "rate_max_all",
        "lines_all", "on_hand_region", *names]
    out = out.fillna(0, [*zero, "transit_first", "transit_second", "po_due", "held", "on_po", "forecast_12m",
        "inv_months"])
    transit = F.col("transit_first") + F.col("transit_second")
    no_cost = F.col("unit_cost").isNull() & F.col("position_cost").isNull() & F.col("implied_cost").isNull()
    return out.select(
        "*", sum((F.col(n) for n in names[1:]), F.col(names[0])).alias("forecast_total"),
        F.when(F.col("transit_first") > 0, lanes[first]).when(F.col("transit_second") > 0, lanes[second])
            .alias("container_group"),
        F.when(transit > 0, F.lit(eta)).alias("eta"), transit.alias("transit"),
        F.when(no_cost & F.col("list_price").isNull() & (F.col("lines_all") == 0), "no price or cost data")
            .when(F.col("lines_all") == 0, "no realized price")
        .when(no_cost, "no cost data").otherwise("ok").alias("price_flag"),
    )


def clean_back_orders(orders: DataFrame, names: Sequence[str], since: dt.date,
    lists: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Back orders (sku, customer, ship_date, qty, rate, ...) that count, with their ``value``.

    Left out: blank skus, quantities of zero or less, customers whose name
    holds one of ``names`` in any case, dates before ``since`` (no date
    passes), and what meets a row of one of ``lists`` on its keys, blank
    meeting blank.
    """
    kept = orders.where((text.strip_all(F.col("sku").cast("string")) != "") & (F.col("qty") > 0) & (F.col("ship_date")
        .isNull() | (F.col("ship_date") >= F.lit(since))))
    for n in names:
        kept = kept.where(~F.coalesce(F.contains(F.lower("customer"), F.lit(n.lower())), F.lit(False)))
    for others, on in lists:
        kept = excluding(kept, others, on)
    return kept.withColumn("value", F.col("qty") * F.coalesce("rate", F.lit(0)))


def allocation_mix(parts: Sequence[DataFrame]) -> DataFrame:
    """(sku, channel, qty, share) of frames (sku, channel, qty), say back orders and forecasts: each channel's share of a sku's sum."""
    every = parts[0].select("sku", "channel", "qty")
    for p in parts[1:]:
        every = every.unionByName(p.select("sku", "channel", "qty"))
    by = every.groupBy("sku", "channel").agg(total(F.col("qty"), zero_fill=True).alias("qty"))
    whole = by.groupBy("sku").agg(F.sum("qty").alias("_whole"))
    return by.join(whole, "sku").withColumn("share", numbers.ratio(F.col("qty"), F.col("_whole"))).drop("_whole")


def positions(
    stock: DataFrame, back_orders: DataFrame, bought: DataFrame, forecast: DataFrame, demand: DataFrame,
        aliases: Mapping[str, str], as_of: dt.date,
    lead_days: float, run_months: int = 3, since: dt.date = dt.date(2020, 1, 1),
) -> DataFrame:
    """The position of every sku and channel that has stock, back orders, forecast or demand.

    ``stock`` (sku, channel, on_hand), ``back_orders`` (sku, channel,
    ship_date, qty), ``bought`` (sku, expected, qty, value; see
    ``closure_list`` for what to leave out), ``forecast`` and ``demand`` (sku,
    channel, month, qty). ``aliases`` name channels that count for another.
    What is bought belongs to the sku and shows in each of its channels.
    """
    channel = F.coalesce(map_values(F.col("channel"), aliases), F.col("channel")).alias("channel")
    month = F.trunc(F.lit(as_of), "month")
    ahead = lambda n: (F.col("month") >= month) & (F.col("month") < F.add_months(month, n))
    past = (F.col("month") < month) & (F.col("month") >= F.add_months(month, -run_months))
    value = lambda name, c: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    held = stock.groupBy("sku", channel).agg(value("on_hand", F.col("on_hand")))
    owed = back_orders.groupBy("sku", channel).agg(value("live_bo",
        F.when(F.col("ship_date") >= F.lit(since), F.col("qty"))))
    monthly = forecast.groupBy("sku", channel, "month").agg(F.sum("qty").alias("qty"))
    due = monthly.groupBy("sku", "channel").agg(
        value("forecast3", F.when(ahead(3), F.col("qty"))), value("forecast12", F.when(ahead(12), F.col("qty"))),
            F.count_if(ahead(12) & (F.col("qty") > 0)).alias("_months")
    )
    sold = demand.groupBy("sku", channel).agg(value("_sold", F.when(past, F.col("qty"))))
    come = bought.where(F.col("expected").isNotNull()).groupBy("sku").agg(
        value("inbound", F.col("qty")), exact_total(F.col("value")).alias("inbound_value"),
            F.min(F.when(F.col("expected") > F.lit(as_of), F.col("expected"))).alias("next_due")
    )
    out = held
    for part in (owed, due, sold):
        out = out.join(part, ["sku", "channel"], "full")
    out = out.join(come, "sku", "left").fillna(0, ["on_hand", "live_bo", "forecast3", "forecast12", "_months", "_sold",
        "inbound", "inbound_value"])
    rate = F.col("_sold") / F.lit(float(run_months))
    supply = numbers.months_of_supply(F.col("on_hand"), F.col("forecast12"), rate)
    return out.select(
        F.concat_ws("|", F.col("sku").cast("string"), "channel").alias("key"), "sku", "channel", "on_hand", "live_bo",
            (F.col("on_hand") - F.col("live_bo")).alias("net"), "inbound", "inbound_value", "next_due",
        "forecast3", "forecast12", numbers.floor_zero(F.lit(12) - F.col("_months")).alias("zero_months"),
            rate.alias("run_rate"), F.lit(lead_days / 30).alias("lead_months"),
        supply.alias("months_of_supply"), (supply - lead_days / 30).alias("coverage"),
    )
