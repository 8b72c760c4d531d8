"""Sums over parts of a group, date ranges and set similarity, against brute force."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.functions import text
from harborline.operators import cells, intervals, joins, windows


def brute_waterfall(rows):
    out = {}
    for i, (sku, order, supply, held, wanted, quota) in enumerate(rows):
        base = min(quota, max(0, supply - held))
        out[i] = [sku, order, base, max(0, wanted - base), max(0, supply - held)]
    for i, (sku, order, base, unmet, _) in out.items():
        own = [x for x in out.values() if x[0] == sku]
        left = max(0, max(x[4] for x in own) - sum(x[2] for x in own))
        prior = sum(x[3] for x in own if None not in (order, x[1]) and x[1] < order)
        yield i, base, unmet, left, prior, min(unmet, max(0, left - prior))


@pytest.mark.parametrize("bounds", [None, [], [3, 5]])
def test_waterfall_against_brute_force(spark, bounds):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None, "hot", "hot", "hot"]), r.choice([None, *range(12)]), r.randrange(40), 3,
        r.randrange(9), r.randrange(4)) for _ in range(200)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)],
        "i int, sku string, `p.q` int, supply int, held int, wanted int, quota int")
    got = windows.waterfall(df, ["sku"], "p.q", "supply", "held", "wanted", "quota", bounds)
    assert sorted((x.i, x.base, x.unmet, x.leftover, x.prior_unmet, x.sweep) for x in got.collect()) == list(
        brute_waterfall(rows))


def test_a_hot_group_is_cut_into_parts(spark):
    """One sku has half of the rows: no part of a group holds more than twice the median's rows of that sku."""
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"),
        F.col("id") % 500)).alias("sku"), F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("prio"), F.lit(1).alias("v"))
    bounds = windows.cuts(df, "prio")
    assert len(bounds) == windows.PARTS - 1
    sizes = [r["count"] for r in df.where("sku = 'hot'").groupBy(windows.part_of(F.col("prio"), bounds).alias("p")).count()
        .collect()]
    assert len(sizes) == windows.PARTS and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2] and max(sizes) < 40_000 / 50
    plan = windows.prior_totals(df, ["sku"], "prio", F.col("v"), "before", bounds)
    every = plan._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part" in line or "rowsBetween" not in line for line in every.splitlines() if "Window" in line)
    hot = plan.where("sku = 'hot'").select("prio", "before").collect()
    order = sorted(r.prio for r in hot)
    first = {p: i for i, p in reversed(list(enumerate(order)))}
    assert all(r.before == first[r.prio] for r in hot)


def days(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def hard_ranges(n=60, seed=5):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a = r.randrange(120)
        out.append((r.choice("abc"), None if r.random() < 0.05 else days(a), None if r.random() < 0.1 else days(
            a + r.randrange(-3, 25)), i))
    return out + [out[0], ("d", days(3), days(4), 100), ("d", days(6), days(9), 101), ("d", days(9), days(9), 102)]


def holds(rng, day):
    return (rng[1] is None or rng[1] <= day) and (rng[2] is None or day < rng[2]) and (rng[1] is None or rng[2] is None or
        rng[1] < rng[2])


SPAN = "k string, since date, until date, v int"


def test_overlaps_and_gaps_against_every_day(spark):
    for seed in range(3):
        rows = [x for x in hard_ranges(25, seed) if x[1] is not None]
        got = intervals.validity_issues(spark.createDataFrame(rows, SPAN), ["k"], "since", "until").collect()
        last = max(x[2] for x in rows if x[2]) + dt.timedelta(9)
        depth = {(k, n): sum(x[0] == k and holds(x, days(n)) for x in rows) for k in "abcd" for n in range(-5, 160)}
        seen = {}
        for g in got:
            n = (g.since - days(0)).days
            while days(n) < min(g.until, last):
                assert (g.k, n) not in seen
                seen[g.k, n] = g.kind
                n += 1
            if g.until <= last:
                assert g.depth == max(depth[g.k, i] for i in range((g.since - days(0)).days, (g.until - days(0)).days))
        for k in "abcd":
            held = [n for n in range(-5, 160) if depth[k, n]]
            for n in range(-5, 160):
                want = "overlap" if depth[k, n] > 1 else "gap" if held and held[0] < n < held[-1] and not depth[k, n] else None
                if days(n) < last:
                    assert seen.get((k, n)) == want, (k, n)


def test_values_in_force_end(spark):
    rows = hard_ranges()
    facts = [(k, days(n), f"{k}{n}") for k in "abcde" for n in range(-10, 170, 3)] + [("a", None, "none"), (None, days(3), "x")]
    got = intervals.in_force(spark.createDataFrame(facts, "k string, day date, id string"), spark.createDataFrame(rows, SPAN),
        ["k"], "day", "since", "until", ["v"]).collect()
    assert len(got) == len(facts)
    for g in got:
        held = [x for x in rows if g.day and x[0] == g.k and holds(x, g.day)]
        best = max(held, key=lambda x: (x[1] or dt.date.min, x[3]), default=None)
        assert g.v == (best[3] if best else None), g
        assert g.v is None or g.until is None or g.until > g.day


def test_join_in_range_has_no_nested_loop(spark):
    rows = spark.createDataFrame(hard_ranges(), SPAN)
    points = spark.createDataFrame([(k, days(n), n) for k in "abcd" for n in range(0, 140, 7)], "k string, day date, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = intervals.join_in_range(points, rows, ["k"], "day", "since", "until", ["v"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan
        assert sorted((g.k, g.n, g.v) for g in got.collect()) == sorted((k, n, x[3]) for k in "abcd" for n in range(0, 140, 7)
            for x in hard_ranges() if x[0] == k and holds(x, days(n)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_in_own_range(spark):
    rows = hard_ranges()
    facts = [(k, days(n), n) for k in "abd" for n in range(0, 150)] * 2
    got = intervals.sum_in_range(spark.createDataFrame(rows, SPAN), spark.createDataFrame(facts, "k string, day date, q int"),
        ["k"], "day", "since", "until", {"q": F.sum("q"), "n": F.count(F.lit(1))}).collect()
    assert sorted((g.v, g.q, g.n) for g in got) == sorted((x[3], sum(f[2] for f in facts if f[0] == x[0] and holds(x, f[1])),
        sum(f[0] == x[0] and holds(x, f[1]) for f in facts)) for x in rows)
    none = intervals.sum_in_range(spark.createDataFrame(rows, SPAN), spark.createDataFrame([], "k string, day date, q int"),
        ["k"], "day", "since", "until", {"q": F.sum("q")})
    assert {r.q for r in none.collect()} == {0}


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("least", [0.5, 0.7, 0.8, 1.0])
def test_set_overlap_against_brute_force(spark, least):
    r = random.Random(7)
    sets = {}
    for i in range(120):
        base = set(r.choices(range(60), k=r.choice([3, 4, 8, 20, 40])))
        sets[2 * i] = base
        sets[2 * i + 1] = {x for x in base if r.random() > 0.15} | set(r.choices(range(300), k=r.randrange(3)))
    rows = [(o, o // 3, f"i{x}") for o, s in sets.items() for x in s] + [(1, 0, None), (0, 0, f"i{min(sets[0])}")]
    df = spark.createDataFrame(rows, "owner int, file int, item string")
    want = {(a, b): jaccard(sets[a], sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if a // 3 != b // 3
        and min(len(sets[a]), len(sets[b])) >= 4 and jaccard(sets[a], sets[b]) >= least}
    arrays = df.groupBy("owner", "file").agg(F.collect_list("item").alias("item"))
    for given in (df, arrays):
        got = joins.set_overlap(given, "owner", "item", "file", least).collect()
        assert {(g.a, g.b): g.jaccard for g in got} == want
        assert all(g.shared == len(g.common) and (g.na, g.nb) == (len(sets[g.a]), len(sets[g.b])) for g in got)


@pytest.mark.parametrize(("least", "block"), [(0.5, 1 << 24), (0.7, 200), (0.8, 1 << 24), (1.0, 10)])
def test_hashed_overlap_against_brute_force(spark, monkeypatch, least, block):
    """Counts of hashed sets, in one block or in many that cut the groups of neighbours."""
    monkeypatch.setattr(joins, "BLOCK", block)
    r = random.Random(9)
    sets = {}
    for i in range(60):
        base = set(r.choices(range(-(10**12), 10**12), k=r.choice([3, 4, 20, 60])))
        for k in range(3):
            sets[3 * i + k] = {x for x in base if r.random() > 0.1} | {r.randrange(20) for _ in range(3)}
    df = spark.createDataFrame([(o, list(s)) for o, s in sets.items()], "owner bigint, items array<bigint>")
    want = {(a, b): (len(sets[a] & sets[b]), jaccard(sets[a], sets[b])) for a, b in itertools.combinations(sorted(sets), 2)
        if min(len(sets[a]), len(sets[b])) >= 4 and jaccard(sets[a], sets[b]) >= least}
    got = joins.hashed_overlap(df, "owner", "items", least).collect()
    assert {(g.a, g.b): (g.shared, g.jaccard) for g in got} == want and len(got) == len(want)
    assert all((g.na, g.nb) == (len(sets[g.a]), len(sets[g.b])) for g in got) and (want or least == 1)


def near_sets(r, count, vocabulary=4000):
    """Sets of up to 3,000 items, each with two near copies and one with an equal set; items of low numbers are in most sets."""
    sets = {}
    for i in range(count):
        base = {min(r.randrange(vocabulary), r.randrange(vocabulary)) for _ in range(r.choice([5, 9, 30, 90, 250, 700, 3000]))}
        for k in range(3):
            sets[3 * i + k] = {x for x in base if r.random() > 0.06 * k} | {r.randrange(vocabulary) for _ in range(k)}
    sets[3 * count] = sets[21]
    return {o: [hash((x, 1)) for x in s] for o, s in sets.items()}


def similar(sets, least):
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if min(len(sets[a]), len(sets[b])) >= 4
        and jaccard(set(sets[a]), set(sets[b])) >= least}


@pytest.mark.parametrize(("least", "tile", "part"), [(0.7, 1 << 23, 48), (0.7, 1500, 48), (0.5, 4000, 16), (0.9, 1 << 23, 4),
    (1.0, 300, 48)])
def test_cells_miss_no_pair(spark, monkeypatch, least, tile, part):
    """All pairs of sets of all sizes, in cells that are whole or cut into tiles, with parts of which many are empty."""
    monkeypatch.setattr(cells, "TILE", tile)
    monkeypatch.setattr(cells, "PART", part)
    sets = near_sets(random.Random(5), 60)
    df = spark.createDataFrame(list(sets.items()), "owner bigint, items array<bigint>")
    want = similar(sets, least)
    met = joins.hashed_candidates(df, "owner", "items", least).collect()
    pairs = {(min(m.lo, m.ro), max(m.lo, m.ro)) for m in met}
    assert want <= pairs and len(met) == len(pairs) and want
    assert all((m.ln, m.rn) == (len(sets[m.lo]), len(sets[m.ro])) and m.ln <= m.rn for m in met)
    got = joins.hashed_overlap(df, "owner", "items", least).collect()
    assert {(g.a, g.b) for g in got} == want and len(got) == len(want)


def test_cells_of_equal_sets_and_equal_codes(spark):
    """Equal sets count once, for the smallest owner; a set whose items share a code is no pair with itself."""
    x = np.random.default_rng(1).integers(-(2**63), 2**63, 60_000)
    code = cells._mixed(x) >> np.uint64(16) & np.uint64(0xFFFFFF)
    order = np.argsort(code)
    at = np.flatnonzero(code[order][1:] == code[order][:-1])[:4]
    twins = [int(v) for i in at for v in x[order[i:i + 2]]]
    sets = {9: twins, 4: twins, 7: twins, 2: twins[:7], 3: [int(v) for v in x[:8]]}
    df = spark.createDataFrame([(o, sum(s) % 2**62, s) for o, s in sets.items()], "owner bigint, kind bigint, items array<bigint>")
    met = joins.hashed_candidates(df.repartition(3), "owner", "items", 0.7, same="kind").collect()
    assert {(m.lo, m.ro) for m in met} == {(2, 4)}


def test_overlap_shuffles_each_set_about_once(spark):
    """What leaves the tasks that read is some bytes an item, and only similar sets are looked at again."""
    sets = near_sets(random.Random(8), 150, 100_000)
    df = spark.createDataFrame(list(sets.items()), "owner bigint, items array<bigint>")
    planned = cells.plan({}, cells.bounds(0.7))
    dealt = df.select(F.col("owner").alias("o"), F.col("owner").alias("same"), F.col("items").alias("h")).mapInArrow(
        cells.deal(0.7, 4, planned), cells.DEALT)
    assert dealt.agg(F.sum(F.length("codes"))).first()[0] <= 6 * sum(map(len, sets.values()))
    assert joins.hashed_candidates(df, "owner", "items").count() <= 1.5 * len(similar(sets, 0.7))


def test_few_pairs_are_looked_at(spark, sf):
    """Words of all texts as sets: at most ten pairs are counted for each that is similar."""
    d = spark.read.parquet(f"{sf}/documents.parquet")
    kinds = d.groupBy(F.array_sort(F.array_distinct(text.header_tokens(F.col("text")))).alias("items")).agg(
        F.min("doc_id").alias("owner"))
    whole = joins._similar_sets(kinds, "owner", "items", "owner", 4).persist()
    n = joins.set_overlap(kinds, "owner", "items", "owner").count()
    assert 0 < n <= joins.close_sets(whole, 0.7).count() <= 10 * n
    whole.unpersist()
