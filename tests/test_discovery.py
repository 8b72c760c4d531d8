"""Judgements of discovery on small cases."""

import pytest
from pyspark.sql import functions as F

from harborline.operators import discovery, estate, joins, reconcile, windows


def roles(spark, *headers):
    df = spark.createDataFrame([("s", h) for h in headers], "sheet string, header string")
    return {r.role: (r.header, r.score, r.match, r.needs_confirmation)
        for r in discovery.key_roles(df, "sheet", "header").collect()}


def test_a_quantity_on_order_is_no_order_number(spark):
    got = roles(spark, "Qty on PO", "PO #", "SKU", "POL", "POD", " ", "Container #")
    assert got["quantity"] == ("Qty on PO", 0.75, "leading", False)
    assert got["po_number"][:3] == ("PO #", 1.0, "exact")
    assert (got["port_of_loading"][0], got["port_of_discharge"][0], got["sku"][0], got["container"][0]) == ("POL",
        "POD", "SKU", "Container #")


def test_a_guess_needs_confirmation(spark):
    got = roles(spark, "Qty on PO")
    assert set(got) == {"quantity"}
    assert roles(spark, "Our Warehouse")["location"] == ("Our Warehouse", 0.55, "contained", True)


def test_scores_are_ranked_before_they_are_cut(spark):
    """A longer exact name outranks a shorter one, though both show 1."""
    got = roles(spark, "Unit of measure", "uom")
    assert got == {"uom": ("Unit of measure", 1.0, "exact", False)}


def test_headers_without_separators_match(spark):
    assert roles(spark, "OnHand")["quantity"][2] == "exact" and roles(spark, "item_code")["sku"][2] == "exact"


@pytest.mark.parametrize("held,want", [(["sku", "po_number", "uom"], "po_number x sku"), (["uom"], "unresolved"),
    ([], "unresolved")])
def test_grain(spark, held, want):
    assert spark.range(1).select(discovery.grain(F.array(*map(F.lit, held)).cast("array<string>"))).first()[0] == want


def test_domain(spark):
    words = {"inventory": ["on hand", "stock status"], "open_po": ["purchase order", "po"],
        "transit": ["pol", "container"]}
    rows = [("x/OnHand.csv", ["a"]), ("x/ItemsPurchaseOrder.csv", ["container", "pol"]),
        ("x.csv", ["On Hand", "Container"]), ("x.csv", []), ("x/on hand.csv", ["on hand"]), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, path string, heads array<string>")
    got = [tuple(r.d) for r in df.select("i", discovery.domain(F.col("path"), F.col("heads"), words).alias("d"))
        .orderBy("i").collect()]
    assert [g[:2] for g in got] == [("inventory", 3), ("open_po", 4), ("inventory", 1), ("unclassified", 0),
        ("inventory", 3), ("unclassified", 0)]
    assert got[0][2] == ["on hand (path)"]


def test_part_played(spark):
    rows = [(0, 0, 0, 0, 0, False, True), (2, 0, 0, 900, 100, True, False), (0, 1, 0, 10, 100, False, False),
        (0, 0, 0, 900, 100, False, False), (0, 0, 0, 400, 100, False, False), (0,) * 5 + (False, False)]
    names = "query_sources links connections formulas rows macros is_csv".split()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
        "i int, " + ", ".join(f"{n} {'boolean' if n in ('macros', 'is_csv') else 'int'}" for n in names))
    got = [r.p for r in df.select("i", discovery.part_played(*map(F.col, names)).alias("p")).orderBy("i").collect()]
    assert [(g.role, g.confidence) for g in got] == [
        ("true_source", "high"), ("hybrid", "high"), ("derived_copy", "high"), ("calculated_output", "medium"),
            ("true_source", "medium"), ("unknown", "low")
    ]
    assert got[1].reasons == ["pulls from 2 queries, 0 links, 0 connections", "900 formulas, 9.0 a row", "has macros",
        "imports and recomputes"]
    how = df.select("i", discovery.refresh_mechanism(*map(F.col,
        ("query_sources", "connections", "links", "macros", "is_csv"))).alias("h")).orderBy("i").collect()
    assert [r.h for r in how] == ["export", "queries (2) + macro", "formula links (1)", "manual", "manual", "manual"]


def test_risk(spark):
    users = [f"C:\\Users\\u{i}\\b.xlsx" for i in range(5)]
    rows = [
        (users, False, False, 0, False, 0.9, 0), (["file:///\\\\srv\\a%20b.xlsx", "D:\\Downloads\\x.csv"], True, True,
            51, True, 0.3, 2),
        (["https://x.sharepoint.com/a"], False, False, 0, False, 0.0, 0), (None, False, False, 2, False, None, 0),
    ]
    cols = "locations macros protected hidden capped confidence errors".split()
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
        "i int, locations array<string>, macros boolean, protected boolean, hidden int, capped boolean, confidence double, errors int")
    got = [r.r for r in df.select("i", discovery.risk(*map(F.col, cols)).alias("r")).orderBy("i").collect()]
    assert [(g.score, g.band) for g in got] == [(120, "critical"), (25 + 45 + 10 + 10 + 24 + 15 + 12 + 20, "critical"),
        (8, "low"), (6, "low")]
    assert got[0].findings == ["user path"] and got[3].findings == ["hidden sheets"]


def test_overlaps_come_by_difference_of_rows(spark):
    sets = {1: ("f1", 10, "abcde"), 2: ("f2", 90, "abcde"), 3: ("f3", 10, "abcd"), 4: ("f3", 5, "abcde"),
        5: ("f4", 1, "xyzw")}
    rows = [(o, f, n, c) for o, (f, n, items) in sets.items() for c in items]
    got = discovery.overlaps(spark.createDataFrame(rows, "owner int, file string, n int, item string"), "owner", "item",
        "file", "n").collect()
    assert [(r.a, r.b, r.row_delta, r.conflict) for r in got] == [(2, 4, 85, True), (1, 2, -80, True), (2, 3, 80, True),
        (1, 4, 5, True), (1, 3, 0, False)]
    assert got[2].shared_columns == list("abcd")


def test_overlaps_show_headers_and_domain(spark):
    rows = [(1, "f1", 3, "sku", "SKU #", "stock"), (1, "f1", 3, "qty", "", "stock"), (1, "f1", 3, "po", None, "stock"),
        (1, "f1", 3, "loc", "Loc", "stock"), (2, "f2", 3, "sku", "Sku", "po"), (2, "f2", 3, "qty", "Qty.", "po"),
        (2, "f2", 3, "po", None, "po"), (2, "f2", 3, "loc", "L", "po"), (3, "f3", 9, "sku", "S", "po"),
        (3, "f3", 9, "qty", "Q", "po"), (3, "f3", 9, "po", "P", "po"), (3, "f3", 9, "loc", None, "po")]
    df = spark.createDataFrame(rows, "owner int, file string, n int, item string, shown string, domain string")
    got = discovery.overlaps(df, "owner", "item", "file", "n", shown="shown", domain="domain").collect()
    assert [(r.a, r.b, r.shared_columns, r.domain) for r in got] == [
        (1, 3, ["Loc", "P", "Q", "SKU #"], "stock|po"), (2, 3, ["L", "P", "Qty.", "Sku"], "po"),
        (1, 2, ["Loc", "Qty.", "SKU #", "po"], "stock|po")]


def test_risk_of_a_data_model_and_details(spark):
    df = spark.createDataFrame([(["C:\\Users\\me\\a.xlsx", "C:\\Users\\me\\b.xlsx"], 3)], "l array<string>, m int")
    no = F.lit(False)
    r = df.select(discovery.risk(F.col("l"), no, no, F.lit(0), no, F.lit(1.0), F.lit(0), data_model_parts=F.col("m"))
        .alias("r")).first().r
    plain = df.select(discovery.risk(F.col("l"), no, no, F.lit(0), no, F.lit(1.0), F.lit(0)).alias("r")).first().r
    assert r.score == plain.score + 8 and r.findings == [*plain.findings, "data model"]
    assert [(d.n, d.example) for d in r.details] == [(2, "C:\\Users\\me\\a.xlsx"), (3, None)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 7), (None, 3, 7)], "k string, i int, v int").toDF("a.b", "i", "v.w")
    assert sorted(map(str, discovery.capped(df, ["a.b"], ["i"], 1).select("i", "capped").collect())) == [
        "Row(i=1, capped=True)", "Row(i=3, capped=False)"]
    assert [r.rank for r in windows.ranked(df, ["a.b"], "v.w", "i").orderBy("i").collect()] == [2, 1, 1]
    assert joins.excluding(df, df.where("i = 3"), ["a.b"]).count() == 2
    rates = spark.createDataFrame([("x", 1, 9)], "k string, since int, r int").toDF("a.b", "s.t", "r.r")
    assert [r["r.r"] for r in joins.effective(df, rates, ["a.b"], "i", "s.t", ["r.r"]).orderBy("i").collect()] == [9, 9,
        None]


def test_version_skew_counts_names_of_files_only(spark):
    rows = [("\\\\a\\x\\Plan.xlsx", "c1"), ("\\\\b\\y\\Plan.xlsx", "c1"), ("final.xlsx", "c2"), ("draft.xlsx", "c2"),
        ("d/final.xlsx", "c2"), ("d/copy 2.xlsx", "c2"), ("https://h/a.csv?x=1", "c3"), ("https://h/a.csv?x=2", "c3"),
        ("d/Plan v2.xlsx", "c4"), ("e/plan.xlsx", "c4"), ("e\\Plan_2024.xlsx ", "c4"), ("d/plan.xlsx", "c4"), (None, "c4"),
        ("d/2024.xlsx", "c5"), ("d/2024 new.xlsx", "c5")]
    got = reconcile.version_skew(spark.createDataFrame(rows, "src string, dst string")).collect()
    assert sorted((r.consumer, r.stem, r.files, r.variants) for r in got) == [
        ("c4", "plan", 3, ["Plan v2.xlsx", "Plan_2024.xlsx", "plan.xlsx"]), ("c5", "2024", 2, ["2024 new.xlsx", "2024.xlsx"])]


def test_capped_groups(spark):
    df = spark.createDataFrame([("a", i) for i in range(4)] + [("b", 1), (None, 1), (None, 2)], "g string, i int")
    got = sorted(((r.g or "-", r.i, r.capped) for r in discovery.capped(df, ["g"], ["i"], 2).collect()))
    assert got == [("-", 1, False), ("-", 2, False), ("a", 0, True), ("a", 1, True), ("b", 1, False)]


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("https://1.app.example.com/core/media/media.nl?id=5&c=1&h=x",
            "https://1.app.example.com/core/media/media.nl?c=1&h=y&id=5", True),
        ("https://a.example.com/p?id=5", "https://b.example.org/other?id=5", False),
            ("\\\\srv\\a\\Book.xlsx", "C:/x/book.XLSX", True),
        ("https://t.sharepoint.com/B.xlsx?web=1", "https://t.sharepoint.com/b.xlsx#s", True),
            ("Table1", "table1", True), ("Table1", "x/Table1", False),
    ],
)
def test_upstream_identity(spark, a, b, same):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(*[estate.upstream_identity(F.col(c))
        for c in "ab"]).first()
    assert (r[0] == r[1]) is same


def test_snapshot_diff(spark):
    before, after = (spark.createDataFrame(r, "k int, x string, y int")
        for r in ([(1, "a", None), (2, "b", 1), (3, "c", 1)], [(1, None, None), (2, "b", 1), (4, "d", 1)]))
    assert sorted(map(tuple, estate.snapshot_diff(before, after, ["k"]).collect())) == [(1, "changed"), (3, "removed"),
        (4, "added")]


def test_findings_of_representatives_stand_for_all_pairs(spark):
    rows = [(f"q{i}", f"w{i}", "u", {"QuoteStyle": "QuoteStyle.None" if i % 3 else "QuoteStyle.Csv"}, [("m", f"sum{i % 2}")],
        [("k", ["trim"], "x")], ["sku"], [], ["sku"]) for i in range(12)] + [("z", "w", "v", {}, [], [], [], [], [])]
    profiles = spark.createDataFrame(rows, reconcile.PROFILE)
    ones, members = reconcile.representatives(profiles)
    assert ones.count() == 5 and ones.columns == profiles.columns
    of = {r.label: r.representative for r in members.collect()}
    assert len(of) == 13 and of["q6"] == "q0" and of["z"] == "z"
    pairs = lambda df, name: {(*sorted((name(r.left_label), name(r.right_label))), r.kind, r.subject,
        *sorted((r.left_value, r.right_value))) for r in df.collect()}
    few = reconcile.findings(ones)
    assert pairs(few, lambda x: x) == pairs(reconcile.findings(profiles), of.get)
    assert few.count() < reconcile.findings(profiles).count() / 5


def _uses(df, word: str) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().lower().count(word)


def test_risk_searches_each_location_once_a_rule(spark):
    row = [([r"C:\Users\a\b.xlsx", r"D:\x\Downloads\b.csv", None], 2)]
    df = spark.createDataFrame(row, "at array<string>, hidden int").select(discovery.risk(F.col("at"), F.lit(True),
        F.lit(False), F.col("hidden"), F.lit(True), F.lit(0.3), F.lit(0)).alias("r")).select("r.score", "r.band", "r.findings")
    assert _uses(df, "rlike") <= len(discovery.FRAGILE) and _uses(df, "regexp_replace") <= 2
    assert [tuple(r) for r in df.collect()] == [(128, "critical", ["user path", "download or desktop folder", "macros",
        "hidden sheets", "row count capped", "weak header"])]


def test_a_domain_drops_separators_once_a_text(spark):
    df = spark.createDataFrame([("Stock/on_hand.csv", ["Qty"]), ("a/b.csv", ["Purchase-Order", "x"]), (None, None)],
        "path string, heads array<string>").select(discovery.domain(F.col("path"), F.col("heads"), {"inventory": ["on hand",
        "stock"], "purchasing": ["purchase order"]}).alias("d")).select("d.domain", "d.score", "d.hits")
    assert _uses(df, "regexp_replace") == 2
    assert [tuple(r) for r in df.collect()] == [("inventory", 6, ["on hand (path)", "stock (path)"]),
        ("purchasing", 1, ["purchase order"]), ("unclassified", 0, [])]


def test_version_skew_judges_a_location_once(spark):
    df = spark.createDataFrame([(r"d/Plan v2.xlsx", f"c{i}") for i in range(5)] + [("d/Plan.xlsx", "c1"), ("e/Plan.xlsx", "c1"),
        (None, "c1")], "src string, dst string")
    got = reconcile.version_skew(df)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    judged = plan[: plan.index("file:")]
    assert "Join" in judged and [(r.consumer, r.stem, r.files, r.variants) for r in got.collect()] == [("c1", "plan", 2,
        ["Plan v2.xlsx", "Plan.xlsx"])]


def test_version_skew_judges_no_edge(spark):
    """What judges a location stands only above the list of distinct ones; odd rows are as they were."""
    rows = [("d/Plan v2.xlsx", None), ("d/Plan.xlsx", None), ("d/Plan.xlsx", None), ("", "c1"), (" ", "c1"), ("d/", "c1"), ("e//", "c1"),
        (" https://h/Plan.xlsx", "c1"), ("HTTPS://h/Plan v2.xlsx", "c1"), ("d/Plan.xlsx", "c1"), ("d/final.xlsx", "c2"),
        ("d/copy.xlsx", "c2"), ("d/a\nb.xlsx", "c3"), ("\te\\a b v2.xlsx\n", "c3"), ("x/media.nl?id=1", "c4"), ("x/media", "c4"),
        ("media", "c4"), (None, None)]
    got = reconcile.version_skew(spark.createDataFrame(rows, "src string, dst string"))
    judging = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "media" in x]
    assert judging and not any("Filter" in x or "Join" in x for x in judging)
    assert sorted(map(str, got.collect())) == [
        "Row(consumer='c3', stem='ab', files=2, variants=['a\\nb.xlsx', 'a b v2.xlsx'])",
        "Row(consumer=None, stem='plan', files=2, variants=['Plan v2.xlsx', 'Plan.xlsx'])"]
