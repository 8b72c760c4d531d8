import pytest
from pyspark.sql import functions as F

from harborline.functions.numbers import parse_whole
from harborline.operators import aggregates, entities, gates, joins, reconcile, reshape, windows

DIM = [("JAX", "East", "company"), ("LAX", "West", "vendor")]


def stock(spark, rows):
    raw = spark.createDataFrame(rows, "item string, location_id string, q string, row_id int")
    return raw.select(
        "item", "location_id", parse_whole(F.col("q")).alias("on_hand"), parse_whole(F.col("q")).alias("available"),
        F.lit(1.5).alias("average_cost"), F.lit(3).alias("lead_time"),
            F.when(F.col("row_id") > 1, F.col("item")).alias("description"), "row_id",
    )


def test_inventory_hazards(spark):
    dim = spark.createDataFrame(DIM, "location_id string, regional_id string, supply_side string")
    rows = [("P : A ", "JAX", "1,204", 1), ("p : a", "JAX", None, 2), ("P : A", "MARS", "(35)", 3),
        ("   ", "LAX", "1", 4), ("P : N", "LAX", None, 5)]
    built = entities.inventory_onhand(stock(spark, rows), dim)
    got = {(r.sku, r.location_id): r for r in built.frame.collect()}
    assert got["A", "JAX"].on_hand == 1204 and got["A", "JAX"].description == "p : a" and got["A",
        "JAX"].source_rows == 2
    assert got["A", "MARS"].regional_id is None and got["A", "JAX"].ownership == "company_paid" and got["N",
        "LAX"].on_hand is None
    failed = {r.gate: r.severity for r in built.exceptions().collect()}
    assert failed == {"no_null_keys:sku": "blocking", "known_members:location_id": "blocking",
        "non_negative:on_hand": "warning", "non_negative:available": "warning"}
    assert not gates.may_publish(built.verdicts)
    zero = entities.inventory_onhand(stock(spark, rows), dim, zero_fill=True).frame.where("sku = 'N'").first()
    assert zero.on_hand == 0


def test_inventory_of_nothing_blocks(spark):
    dim = spark.createDataFrame(DIM, "location_id string, regional_id string, supply_side string")
    built = entities.inventory_onhand(stock(spark, []), dim)
    assert [r.gate for r in built.exceptions().collect()] == ["min_rows"]


def test_open_po(spark):
    rows = [(1, 1, "P : x", 200, 0, 150, "No"), (1, 2, "P : y", 10, 12, 0, " YES "), (2, 1, "P : z", 5, None, 5, None)]
    built = entities.open_po(spark.createDataFrame(
        rows, "po_number int, po_line int, item string, ordered int, received int, remaining int, closed string"))
    got = [(r.qty_remaining, r.is_closed) for r in built.frame.orderBy("po_number", "po_line").collect()]
    assert got == [(200, False), (0, True), (5, False)]
    c = built.conflicts.collect()
    assert [(x.exception_id, x.delta) for x in c] == [("open_po:remaining:1|1", 50.0)]
    assert gates.may_publish(built.verdicts)


def test_allocation_unpivots_all(spark):
    df = spark.createDataFrame([("P : a", 1, None), ("P : b", 2, 3)], "name string, B2C int, ASIA int")
    got = entities.allocation(df, {"B2C": "b2c", "ASIA": "apac"}).frame.collect()
    assert sorted((r.sku, r.region_channel, r.qty_allocated) for r in got) == [("A", "apac", 0), ("A", "b2c", 1),
        ("B", "apac", 3), ("B", "b2c", 2)]


def test_many_to_one_refuses_duplicates(spark):
    dim = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(joins.NotUnique):
        joins.many_to_one(spark.createDataFrame([("a",)], "k string"), dim, "k")


def test_unique_grain_counts_all_rows_and_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    r = gates.unique_grain(df, "s", "e", ["k", "v"]).first()
    assert (r.failed, r.checked, r.passed) == (2, 3, False)


def test_waterfall_with_tie_and_gap(spark):
    rows = [("s", 1, 100, 10, 30, 20), ("s", 3, 100, 10, 30, 20), ("s", 3, 100, 10, 40, 30), ("t", 1, None, 0, 5, 5)]
    df = spark.createDataFrame(rows, "sku string, p int, supply int, held int, wanted int, quota int")
    out = windows.waterfall(df, ["sku"], "p", "supply", "held", "wanted", "quota").where("sku = 's'").orderBy("p",
        "wanted").collect()
    assert [(r.base, r.unmet, r.prior_unmet, r.leftover, r.sweep) for r in out] == [(20, 10, 0, 20, 10),
        (20, 10, 10, 20, 10), (30, 10, 10, 20, 10)]


def test_abc_boundaries(spark):
    df = spark.createDataFrame([("a", 80), ("b", 15), ("c", 5), ("d", 0)], "sku string, v long")
    r = windows.cumulative_share(df, "v", "sku").select("sku",
        windows.abc_class(F.col("cumulative"), F.col("grand")).alias("c"))
    assert dict(r.collect()) == {"a": "A", "b": "B", "c": "C", "d": "C"}


def test_first_match_and_default(spark):
    right = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early")], "k string, pos int, v string")
    got = joins.first_match(spark.createDataFrame([("a",), ("z",)], "k string"), right, "k", [F.col("pos")],
        {"v": "none"})
    assert dict(got.collect()) == {"a": "early", "z": "none"}


def test_excluding_meets_null_with_null(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "k string, d int")
    got = joins.excluding(df, spark.createDataFrame([("a", None)], "k string, d int"), ["k", "d"]).collect()
    assert sorted((r.k, r.d) for r in got if r.d or r.k) == [("a", 1), ("b", None)]


def test_effective_on_the_boundary_day(spark):
    rates = spark.createDataFrame([("x", 10, 1.0), ("x", 20, 2.0)], "k string, since int, rate double")
    facts = spark.createDataFrame([("x", 9), ("x", 10), ("x", 20), ("y", 20)], "k string, day int")
    assert sorted(joins.effective(facts, rates, ["k"], "day", "since", ["rate"]).collect(),
        key=str) == sorted([("x", 9, None), ("x", 10, 1.0), ("x", 20, 2.0), ("y", 20, None)], key=str)


def test_set_overlap_is_exact(spark):
    sets = {1: "abcde", 2: "abcdf", 3: "abcdeg", 4: "abc", 5: "vwxyz"}
    rows = [(o, o, i) for o, s in sets.items() for i in s]
    got = joins.set_overlap(spark.createDataFrame(rows, "owner int, file int, item string"), "owner", "item", "file",
        0.6).collect()
    want = {(a, b) for a in sets for b in sets if a < b and min(len(sets[a]), len(sets[b])) >= 4
        and len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= 0.6}
    assert {(r.a, r.b) for r in got} == want


def test_dominant_pattern(spark):
    df = spark.createDataFrame([("c", "x", i) for i in range(3)] + [("c", "y", 9), ("d", "q", 5), ("d", "p", 6)],
        "col string, p string, row int")
    got = {r.col: (r.p, r.cells, r.share) for r in aggregates.dominant(df, ["col"], "p", "row").collect()}
    assert got == {"c": ("x", 4, 0.75), "d": ("q", 2, 0.5)}


def test_union_ragged_and_unpivot(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumn("y", F.lit("q"))
    assert sorted(reshape.union_ragged(a, b).columns) == ["id", "x", "y"]
    assert reshape.move_first(a, "x").columns == ["x", "id"]


def test_identical_queries_have_no_findings(spark):
    row = ("a", "w", "u", {"Columns": "3"}, [("Q", "sum([x])")], [("k", ["trim"], "Text.Trim([k])")], ["k"], ["f"],
        ["k"])
    df = spark.createDataFrame([row, ("b", *row[1:])], reconcile.PROFILE)
    assert reconcile.findings(df).count() == 0


def test_keys_of_query_definitions(spark):
    """Other normalisers block, another expression warns, a key that the other side outputs is not missing."""
    row = lambda label, keys, outputs: (label, "w", "u", {}, [], keys, [], [], outputs)
    profiles = [
        row("a", [("k", ["trim"], "Text.Trim([k])"), ("m", [], "[m]")], []),
            row("b", [("k", ["trim"], "Text.Trim([j])")], ["m"]),
        row("c", [("k", [], "[k]")], []),
    ]
    got = {(r.left_label, r.right_label, r.kind, r.severity, r.subject)
        for r in reconcile.findings(spark.createDataFrame(profiles, reconcile.PROFILE)).collect()}
    assert got == {
        ("a", "b", "key_normalization", "warning", "k"), ("a", "c", "key_normalization", "blocking", "k"),
            ("b", "c", "key_normalization", "blocking", "k"),
        ("a", "c", "key_missing", "warning", "m"),
    }


def test_exact_total_keeps_digits_and_survives_any_number(spark):
    rows = [(1, 0.12345), (1, 0.00001), (2, 1e18), (2, 1.0), (3, float("nan")), (4, None)]
    got = {r.k: r.s for r in spark.createDataFrame(rows, "k int, x double").groupBy("k")
        .agg(aggregates.exact_total(F.col("x"), 5).alias("s")).collect()}
    assert got == {1: 0.12346, 2: 1e18 + 1, 3: None, 4: None}


def test_wildcard_lookup_never_broadcasts_pieces(spark):
    """Pieces are many times the texts: a broadcast of them, chosen by the size of the texts, filled the driver."""
    keys = spark.createDataFrame([(1, "Ring"), (2, "xyz"), (3, "q"), (4, ""), (5, None), (6, "ringo")], "k int, key string")
    texts = spark.createDataFrame([(1, "a ring"), (1, "a ring"), (2, "BRING IT"), (3, "Q"), (4, None)], "id int, c string")
    got = joins.contains_key(keys, texts, "c", "key")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "Join" in plan
    assert sorted((r.k, r.id, r.c) for r in got.collect()) == [(1, 1, "a ring"), (1, 1, "a ring"), (1, 2, "BRING IT"), (3, 3, "Q")]
