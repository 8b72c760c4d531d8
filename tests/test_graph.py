"""Graphs against plain Python: components, cycles, inherited facts, renames."""

import random
import time

import pytest

from harborline.operators import graph


def reach(edges, start):
    seen, todo = set(), [start]
    while todo:
        for b in edges.get(todo.pop(), ()):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


def adjacency(pairs):
    out = {}
    for a, b in pairs:
        if a is not None and b is not None:
            out.setdefault(a, set()).add(b)
    return out


@pytest.mark.parametrize("n,m,seed", [(12, 20, 1), (40, 45, 2), (30, 80, 3)])
def test_components_against_reachability(spark, n, m, seed):
    r = random.Random(seed)
    pairs = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(3, 3), (None, 1), (1, None)]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(pairs, "src int, dst int")).collect()}
    adj = adjacency(pairs)
    far = {v: reach(adj, v) for v in range(n)}
    assert got == {v: min(u for u in far[v] if v in far[u]) for v in range(n) if v in far[v]}


def test_no_cycle_no_component(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "src int, dst int")
    assert graph.components(df).count() == 0 and graph.cycles(df).count() == 0
    assert graph.cycles(df.limit(0)).count() == 0


def test_planted_cycles_in_a_large_graph(spark):
    """100,000 edges downhill, of which a path search keeps millions open, and ten planted cycles."""
    r = random.Random(8)
    pairs = {tuple(sorted((r.randrange(30_000), r.randrange(30_000)))) for _ in range(100_000)}
    pairs = {(a, b) for a, b in pairs if a != b}
    want = set()
    for k in range(10):
        ring = [100_000 + 20 * k + i for i in range(2 + k)]
        pairs |= set(zip(ring, ring[1:] + ring[:1])) | {(r.randrange(30_000), ring[0]), (ring[-1], 200_000 + k)}
        want.add(",".join(map(str, sorted(ring))))
    df = spark.createDataFrame(list(pairs), "src int, dst int")
    began = time.time()
    got = {x.nodes for x in graph.cycles(df).collect()}
    assert got == want and time.time() - began < 60


def test_facts_are_passed_on_in_circles(spark):
    refs = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "e"), ("f", "g"), (None, "a"), ("a", "b")]
    facts = [("c", "x"), ("g", "y"), ("e", "z"), ("a", "x"), ("h", None), ("h", "w")]
    got = graph.passed_on(spark.createDataFrame(refs, "q string, r string"), spark.createDataFrame(facts,
        "q string, s string"), "q", "r", "s")
    assert sorted(map(tuple, got.collect())) == [("a", "x"), ("b", "x"), ("c", "x"), ("d", "x"), ("e", "z"), ("f", "y"),
        ("g", "y"), ("h", "w")]


def test_renames_are_replayed_in_order(spark):
    columns = [("q", "a"), ("q", "b"), ("q", "c"), ("none", "x"), ("gone", "k")]
    steps = [("q", 3, "rename", "b", "a"), ("q", 1, "rename", "a", "t"), ("q", 2, "rename", "zz", "c"),
        ("q", 4, "rename", "t", "b"), ("q", 5, "add", None, "n"), ("q", 6, "rename", "n", "m"), ("q", 7, "rename", "c", "c"),
        ("gone", 1, "remove", "k", None), ("gone", 2, "rename", "k", "l")]
    got = graph.replayed(spark.createDataFrame(columns, "query string, name string"), spark.createDataFrame(steps,
        "query string, pos bigint, kind string, old string, new string"))
    assert sorted(map(str, got.collect())) == sorted(f"Row(query={q!r}, column={c!r}, original={o!r})" for q, c, o in [
        ("q", "b", "a"), ("q", "a", "b"), ("q", "c", "c"), ("q", "m", None), ("none", "x", "x")])


def test_facts_of_a_round_are_not_broadcast(spark, monkeypatch):
    plans = []
    keep = graph.checkpointed
    monkeypatch.setattr(graph, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
        or keep(df))
    refs = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 3)], "reader int, read int")
    got = graph.passed_on(refs, spark.createDataFrame([(3, "x"), (1, "y")], "reader int, fact string"), "reader", "read", "fact")
    assert sorted(map(tuple, got.collect())) == sorted([(i, f) for i in range(1, 5) for f in "xy"])
    assert len(plans) > 2 and not any("BroadcastExchange" in p for p in plans)


def inherited(refs, facts):
    up = adjacency(p for p in refs if p[0] != p[1])
    return sorted({(a, f) for a in {p[0] for p in refs + facts if p[0] is not None} for n, f in facts
        if n is not None and f is not None and (n == a or n in reach(up, a))})


@pytest.mark.parametrize("many,rows,pieces", [(1 << 20, 100_000, 8), (3, 40, 2)])
def test_facts_of_nodes_that_many_read(spark, monkeypatch, many, rows, pieces):
    """Also where some nodes are dealt in parts, the layout is made again and pieces become one; odd rows as before."""
    for k, v in (("_MANY", many), ("_ROWS", rows), ("_PIECES", pieces), ("_PARTS", 5)):
        monkeypatch.setattr(graph, k, v)
    r = random.Random(4)
    refs = [(i, i // 2 if i % 3 else 7) for i in range(120)] + [(r.randrange(120), r.randrange(120)) for _ in range(20)]
    refs += refs[:30] + [(None, 3), (4, None), (5, 5), (300, 7), (None, None)]
    facts = [(i, "ab"[i % 2]) for i in range(0, 120, 11)] * 2 + [(7, "x"), (None, "y"), (9, None), (400, "z"), (8, "")]
    settings = [spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")]
    got = graph.passed_on(spark.createDataFrame(refs, "reader int, read int"), spark.createDataFrame(facts,
        "reader int, fact string"), "reader", "read", "fact")
    assert sorted(map(tuple, got.collect())) == inherited(refs, facts)
    assert settings == [spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")]
    none = spark.createDataFrame([], "reader int, fact string")
    assert graph.passed_on(spark.createDataFrame(refs, "reader int, read int"), none, "reader", "read", "fact").count() == 0


def test_a_round_shuffles_only_new_facts(spark, monkeypatch):
    plans = []
    keep = graph.checkpointed
    monkeypatch.setattr(graph, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
        or keep(df))
    refs = spark.createDataFrame([(i, i + 1) for i in range(12)], "reader int, read int")
    got = graph.passed_on(refs, spark.createDataFrame([(12, "x")], "reader int, fact string"), "reader", "read", "fact")
    assert sorted(map(tuple, got.collect())) == [(i, "x") for i in range(13)]
    rounds = [p for p in plans if "LeftAnti" in p]
    assert len(rounds) > 10 and all(p.count("Exchange hashpartitioning") <= 2 for p in rounds)
