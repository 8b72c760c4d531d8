"""Sheets and named queries on blanks, ties and missing partners."""

import datetime as dt

from harborline.functions import numbers
from harborline.operators import workbook
from pyspark.sql import functions as F

DAY = dt.date(2024, 5, 1)


def test_clean_back_orders_blank_meets_blank(spark):
    schema = "sku string, customer string, ship_date date, qty int, rate double"
    rows = [
        ("a", "Shop", None, 1, 2.0), ("a", "Shop", DAY, 1, None), ("a", None, DAY, 1, 3.0), (" ", "Shop", DAY, 1, 1.0),
            (None, "Shop", DAY, 1, 1.0),
        ("a", "Shop", dt.date(2019, 1, 1), 1, 1.0), ("a", "The BIG Club", DAY, 1, 1.0), ("a", "Shop", DAY, 0, 1.0),
            ("b", "Shop", DAY, 2, 1.5),
    ]
    orders = spark.createDataFrame(rows, schema)
    gone = spark.createDataFrame([("a", None), ("c", DAY)], "sku string, ship_date date")
    kept = workbook.clean_back_orders(orders, ["big club"], dt.date(2020, 1, 1), [(gone, ["sku", "ship_date"])])
    got = sorted((r.sku, r.customer or "", r.value) for r in kept.collect())
    assert got == [("a", "", 3.0), ("a", "Shop", 0.0), ("b", "Shop", 3.0)]


def test_regional_inventory_keeps_blanks_of_the_tail(spark):
    stock = spark.createDataFrame([("P : A ", "x", 1), ("P : A ", "x", None), ("plain", "y", None), ("a:b:c", "z", 2)],
        "name string, location string, available int")
    got = sorted((r.sku, r.location, r.available, r.region) for r in workbook.regional_inventory(stock, {"x": "East"})
        .collect())
    assert got == [(" A ", "x", 1, "East"), ("b:c", "z", 2, None), ("plain", "y", None, None)]


def test_lists_without_partners(spark):
    held = spark.createDataFrame([("a", 2, 1.5), ("b", 1, None)], "sku string, back_order int, rate double")
    stock = spark.createDataFrame([("a", 3), ("a", None), ("c", 1)], "sku string, on_hand int")
    got = {r.sku: (r.on_hand, r.value) for r in workbook.hold_list(held, stock).collect()}
    assert got == {"a": (3, 3.0), "b": (0, None)}
    bought = spark.createDataFrame(
        [("a", "PO1", "Maker", 5), ("a", "TO2", "Maker", 7), ("a", "PO3", "Our Own Group", 9), ("b", None, None, 1)],
            "sku string, document string, vendor string, remaining int"
    )
    got = {r.sku: r.on_order for r in workbook.closure_list(held, stock, bought, vendors=["own group"]).collect()}
    assert got == {"a": 5, "b": 1}


def test_launch_status_and_bills(spark):
    ready = spark.createDataFrame([("a", 0.9), ("b", 0.5), ("c", None)], "sku string, completion double")
    bought = spark.createDataFrame([("a", 5), ("a", None), ("b", None)], "sku string, remaining int")
    got = {r.sku: (r.flag, r.po_exists, r.po_qty) for r in workbook.launch_status(ready, bought).collect()}
    assert got == {"a": ("on track", True, 5), "b": ("below target", True, 0), "c": ("no completion data", False, 0)}
    bom = spark.createDataFrame([("X : TP arc 1", "X : m"), ("TP other", "n : m : o"), (None, None)],
        "parent string, member string")
    got = [(r.parent_sku, r.member_sku, r.is_kind) for r in workbook.bill_master(bom).collect()]
    assert got == [("TP arc 1", "m", 1), ("TP other", "o", 0), (None, None, 0)]


def test_positions_with_an_alias_and_without_partners(spark):
    month = lambda m: dt.date(2024, m, 1)
    of = lambda rows, schema: spark.createDataFrame(rows, schema)
    stock = of([("a", "web", 10), ("a", "shop2", 5)], "sku string, channel string, on_hand int")
    owed = of([("a", "shop", DAY, 4), ("a", "shop", dt.date(2010, 1, 1), 99), ("z", "web", None, 3)],
        "sku string, channel string, ship_date date, qty int")
    bought = of([("a", DAY, 7, 70.0), ("a", None, 9, 90.0), ("a", month(9), 1, None)],
        "sku string, expected date, qty int, value double")
    monthly = "sku string, channel string, month date, qty int"
    forecast = of([("a", "web", month(6), 6), ("a", "web", month(6), 6), ("a", "web", month(5), 50),
        ("a", "web", dt.date(2025, 6, 1), 50)], monthly)
    demand = of([("a", "shop2", month(5), 6), ("a", "shop2", month(2), 60)], monthly)
    out = workbook.positions(stock, owed, bought, forecast, demand, {"shop2": "shop"}, dt.date(2024, 6, 10),
        lead_days=30)
    got = {r.key: r for r in out.collect()}
    assert set(got) == {"a|web", "a|shop", "z|web"}
    web, shop = got["a|web"], got["a|shop"]
    assert (web.on_hand, web.net, web.forecast3, web.forecast12, web.zero_months, web.months_of_supply) == (10, 10, 12,
        12, 11, 10.0)
    assert (shop.on_hand, shop.live_bo, shop.run_rate, shop.months_of_supply, shop.coverage) == (5, 4, 2.0, 2.5, 1.5)
    assert (web.inbound, web.inbound_value, web.next_due) == (8, 70.0, month(9))
    assert (got["z|web"].live_bo, got["z|web"].inbound, got["z|web"].months_of_supply) == (0, 0, 0.0)


def test_forecasts_are_named_by_group(spark):
    export = spark.createDataFrame([("i", "c", "North", "L1", 1, None), ("i", "c", "Other", "L1", 2, 0),
        ("i", "c", "Other", "L9", -1, 5)],
            "item string, category string, territory string, lead_group string, `F 01-2025` int, `F 02-2025` int")
    rows = workbook.month_rows(export, ["item", "category", "territory", "lead_group"], ["F 01-2025", "F 02-2025"])
    got = {(r.allocation_group, r.month.month): r.forecast_qty
        for r in workbook.grouped_forecast(rows, {"North": "A"}, {"L1": "B"}).collect()}
    assert got == {("A", 1): 1, ("B", 1): 2, (None, 1): -1, (None, 2): 5}


def test_cover_needs_demand(spark):
    df = spark.createDataFrame([(12, 24, 9), (12, 0, 9), (12, 0, 0), (0, None, 3)], "h int, f int, t int")
    got = [r[0] for r in df.select(numbers.months_of_cover(F.col("h"), F.col("f"), 12, F.col("t"))).collect()]
    assert got == [6.0, 4.0, None, 0.0]


def test_shares_of_a_mix(spark):
    of = lambda *rows: spark.createDataFrame(rows, "sku string, channel string, qty int")
    got = {(r.sku, r.channel): r.share for r in workbook.allocation_mix([of(("a", "x", 1), ("b", "x", 0)),
        of(("a", "y", 3), ("b", "x", None))]).collect()}
    assert got == {("a", "x"): 0.25, ("a", "y"): 0.75, ("b", "x"): None}
