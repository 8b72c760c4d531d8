"""Gates over several entities, on small cases."""

import datetime as dt

from pyspark.sql import functions as F

from harborline.operators import entities, gates


def test_orphans_after_the_crosswalk(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "sku string")
    items, walk = spark.createDataFrame([("a",), ("z",)], "sku string"), spark.createDataFrame([("c", "z")],
        "sku string, mapped string")
    assert [tuple(r) for r in gates.orphans(facts, items, "sku", walk).collect()] == [("b", 2)]
    assert sorted(map(tuple, gates.orphans(facts, items, "sku").collect())) == [("b", 2), ("c", 1)]


def test_stale_snapshots(spark):
    day = lambda d: dt.datetime(2024, 1, d, 12)
    df = spark.createDataFrame([("new", day(10)), ("old", day(1)), ("old", day(2)), ("none", None)],
        "source string, at timestamp")
    got = {r.source: (r.age_days, r.stale) for r in gates.stale(df, "source", "at", F.lit("2024-01-10")).collect()}
    assert got == {"new": (0, False), "old": (8, True), "none": (None, False)}


def test_transit_needs_a_container_or_an_arrival(spark):
    df = spark.createDataFrame([(1, "C", None), (2, None, dt.date(2024, 1, 1)), (3, " ", None), (4, None, None)],
        "i int, container string, eta date")
    assert sorted(r.i for r in gates.incomplete_transit(df).collect()) == [3, 4]


def test_units_and_money(spark):
    rows = [("a", "EA", 1), ("a", "ea ", 2), ("b", "EA", 1), ("b", "CS", 1), ("c", None, 1), ("d", None, None)]
    df = spark.createDataFrame(rows, "sku string, uom string, q int")
    assert sorted(map(tuple, gates.unit_mismatches(df, "sku", "uom", ["q"]).collect())) == [("b", 2, 0), ("c", 0, 1)]
    assert sorted(r.sku for r in gates.undeclared_money(df, ["q"], "uom").collect()) == ["c"]


def test_gates_over_several_entities(spark):
    build = lambda rows, schema, conflicts=None: entities.EntityBuild(spark.createDataFrame(rows, schema), ["sku"],
        conflicts_of=conflicts and (lambda rows: conflicts))
    clash = spark.createDataFrame([("x", "remaining_mismatch"), ("y", "settled")], "exception_id string, gate string")
    built = {
        "allocation": build([("a", 5), ("a", 6), ("b", 9)], "sku string, qty_allocated bigint"),
            "inventory": build([("a", 4), ("b", 9), ("c", None)], "sku string, on_hand bigint"),
        "open_po": build([("a", 6, False), ("b", 1, True)], "sku string, qty_remaining bigint, is_closed boolean",
            clash),
    }
    items, rules = spark.createDataFrame([("a",), ("b",)], "sku string"), spark.createDataFrame([("settled",)],
        "gate string")
    got = {r.exception_id: (r.failed, r.checked, r.passed) for r in entities.cross_checks(built, items, rules)
        .collect()}
    assert got == {
        "allocation:allocation:orphan_sku": (0, 2, True), "inventory:inventory:orphan_sku": (1, 3, False),
            "open_po:open_po:orphan_sku": (0, 2, True),
        "allocation:allocation:allocation_over_supply": (1, 2, False),
            "open_po:open_po:unresolved_conflict": (1, 2, False),
    }
    assert entities.cross_checks({"open_po": built["open_po"]}) is None


def test_gates_that_an_entity_has_the_columns_for(spark):
    rows = [("a", 1, None, None, "EA", 2.0, "USD", "s", "2024-01-01 05:00:00"), ("b", 2, " ", "2024-02-01", "EA", 1.0, None, "s",
        "2024-01-03 00:00:00"), ("b", 1, "C1", None, "CS", None, None, "s", None)]
    df = spark.createDataFrame(rows, "sku string, qty bigint, container string, eta string, uom string, amount double, "
        "currency string, source_slug string, data_as_of string")
    got = {r.gate: (r.failed, r.checked) for r in entities.cross_checks({"in_transit": entities.EntityBuild(df, ["sku"])},
        today="2024-01-11").collect()}
    assert got == {"stale_snapshot": (1, 1), "in_transit_complete": (1, 3), "uom_mismatch": (1, 2),
        "currency_undeclared": (1, 3)}
    held = entities.cross_checks({"in_transit": entities.EntityBuild(df, ["sku"])}, today="2024-01-10").collect()
    assert {r.gate: r.passed for r in held}["stale_snapshot"]


def test_counts_of_a_write_are_those_of_a_read(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, -2), ("a", None)], "sku string, q bigint")
    checks = [gates.min_rows(5), *gates.no_null_keys(df, ["sku", "gone"]), *gates.non_negative(["q"])]
    seen, counts = gates.observed(df, checks)
    seen.write.parquet(str(tmp_path / "t"))
    assert sorted(gates.told(spark, "s", "e", checks, counts.get).collect()) == sorted(gates.evaluate(df, "s", "e", checks)
        .collect())
