"""Expected assets, sketches and edits by hand on small cases."""

import fnmatch
import random

from pyspark.sql import functions as F

from harborline.operators import assets, overlay, sketches


def test_globs_against_names(spark):
    names = ["Supply Chain Update.xlsm", "supply_chain.xlsx", "DSR tool.xls", "a+b (1).csv", "x[1].csv", "In Transit.xlsx",
        "in transit 2.XLSX", "no", ".", "a\\b", "q?", ""]
    globs = ["*supply*chain*.xls*", "*DSR*.xls?", "a+b (?).csv", "x[[]1].csv", "x[1].csv", "[!a-h]n *transit*", "*", "??",
        "q[?]", "*.xls[xm]", "a\\b", "", "[ab", "no", "*zz*"]
    got = assets.matched(spark.createDataFrame([(g,) for g in globs], "g string"), spark.createDataFrame([(n, 1)
        for n in names] + [(None, 1)], "n string, other int"), "g", "n")
    want = {(g, n) for g in globs for n in names if fnmatch.fnmatchcase(n.lower(), g.lower())}
    assert {(r.g, r.n) for r in got.collect()} == want


def test_assets_present_absent_ambiguous(spark):
    seeds = [("one", ["*transit*.xlsx", "IN *"]), ("none", ["*missing*"]), ("two", ["*.csv"]), ("empty", [])]
    names = ["In Transit.xlsx", "b.csv", "a.csv", "a.csv"]
    got = assets.confirm(spark.createDataFrame(seeds, "seed string, patterns array<string>"), spark.createDataFrame(
        [(n,) for n in names], "name string"))
    assert sorted(map(tuple, got.collect())) == [("empty", "absent", 0, None), ("none", "absent", 0, None),
        ("one", "present", 1, "In Transit.xlsx"), ("two", "ambiguous", 2, "a.csv")]


def test_sketches_add_up(spark):
    r = random.Random(4)
    rows = [(f"2023-{1 + i % 12:02}-{1 + i % 28:02}", "g" if i % 5 else None, r.gauss(0, 1) * (1 + i % 12), r.randrange(5000))
        for i in range(30_000)] + [(None, "g", 1.0, 1), ("2024-03-01", "g", None, None)]
    df = spark.createDataFrame(rows, "d string, k string, v double, item int").withColumn("d", F.col("d").cast("date"))
    stored = sketches.monthly(df, ["k"], "d", F.col("v"), F.col("item"))
    assert stored.count() == 25
    got = sketches.trailing(stored, ["k"], 3).select("k", "month", "rows", sketches.quantile(F.col("values"), 0.9).alias("q"),
        sketches.distinct(F.col("items")).alias("items")).collect()
    assert len(got) == 25
    for g in got:
        y, m = divmod(g.month, 12)
        own = [x for x in rows if x[0] and x[1] == g.k and 0 <= g.month - (int(x[0][:4]) * 12 + int(x[0][5:7]) - 1) < 3]
        assert g.rows == len(own)
        values = [x[2] for x in own if x[2] is not None]
        items = {x[3] for x in own if x[3] is not None}
        if values:
            assert abs(sum(v <= g.q for v in values) / len(values) - 0.9) < 0.03 and abs(g.items - len(items)) <= 0.06 * len(
                items)
        else:
            assert g.q is None and g.items == 0 and (y, m) == (2024, 2)


def test_distinct_sketches_are_close_in_many_windows(spark):
    """The worst of 120 windows is far within 6 %: a large table has hundreds, and one that is off is a wrong row."""
    df = spark.range(120 * 20_000).selectExpr("id div 20000 AS k", "id * 1000003 AS item", "DATE'2024-01-01' AS d")
    stored = sketches.monthly(df.repartition(4), ["k"], "d", F.lit(1), F.col("item"))
    got = sketches.trailing(stored, ["k"], 12).select(sketches.distinct(F.col("items")).alias("n")).collect()
    assert len(got) == 120 and max(abs(g.n - 20_000) for g in got) < 0.03 * 20_000


def test_exact_distinct_items_of_trailing_windows(spark):
    r = random.Random(5)
    rows = [(r.choice("ab"), r.randrange(36), r.randrange(60)) for _ in range(400)]
    df = spark.createDataFrame([(k, f"{2020 + m // 12}-{1 + m % 12:02}-07", i) for k, m, i in rows] + [("a", None, 1),
        ("a", "2020-01-01", None)], "k string, d string, item int").withColumn("d", F.col("d").cast("date"))
    steps = sketches.trailing_distinct(df, ["k"], "d", F.col("item"), 5).collect()
    for k in "ab":
        for end in range(40):
            own = {i for x, m, i in rows if x == k and 0 <= end - m < 5}
            assert sum(s.step for s in steps if s.k == k and s.month <= 2020 * 12 + end) == len(own)


def test_the_last_edit_of_a_cell_wins(spark):
    df = spark.createDataFrame([("a", "old", 1.5, 7), ("b", "old", 2.5, 7), ("c", None, None, 7), (None, "n", 0.0, 7)],
        "sku string, status string, share double, n int")
    edits = [("a", "status", "new", 1, "x"), ("a", "status", "newer", 2, "x"), ("a", "share", "abc", 3, "x"),
        ("b", "share", " ", 5, "y"), ("b", "status", "p", 4, "x"), ("b", "status", "q", 4, "y"), ("b", "n", "8", 1, "x"),
        ("z", "status", "s", 1, "x"), ("c", "share", "1e3", 1, "z"), (None, "status", "t", 1, "x"), ("c", None, "t", 1, "x"),
        ("a", "share", "9", 1, "x")]
    out, lost = overlay.overlay(df, spark.createDataFrame(edits, "key string, column string, value string, time int, "
        "author string"), "sku", ["status", "share"])
    got = {r.sku: r for r in out.collect()}
    assert [(r.status, r.share, r.n) for r in (got["a"], got["b"], got["c"], got[None])] == [("newer", 9.0, 7),
        ("q", None, 7), (None, 1000.0, 7), ("n", 0.0, 7)]
    assert got["a"].origin["status"].asDict() == {"author": "x", "time": 2, "was": "old"} and got[None].origin is None
    assert got["b"].origin["share"].was == "2.5" and got["c"].origin["share"].was is None
    why = sorted((r.reason, r.key, r.column, r.value) for r in lost.fillna("-", ["key", "column", "value"]).collect())
    assert why == [("conflict", "b", "status", "p"), ("conflict", "b", "status", "q"), ("not a double", "a", "share", "abc"),
        ("unknown column", "b", "n", "8"), ("unknown column", "c", "-", "t"), ("unknown key", "-", "status", "t"),
        ("unknown key", "z", "status", "s")]


def test_names_and_pieces_are_not_broadcast(spark):
    seeds = spark.createDataFrame([(i, ["*a?.csv", "*.X"]) for i in range(50)] + [(None, ["*"]), (90, None), (91, ["*"])],
        "seed int, patterns array<string>")
    got = assets.confirm(seeds, spark.createDataFrame([(f"a{i}.csv",) for i in range(9)] + [("b.x",)], "name string"))
    assert got._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") <= 1  # globs without a literal
    told = {r.seed: (r.status, r.files, r.first) for r in got.collect()}
    assert len(told) == 53 and all(told[i] == ("ambiguous", 10, "a0.csv") for i in [*range(50), 91])
    assert told[None] == told[90] == ("absent", 0, None)
