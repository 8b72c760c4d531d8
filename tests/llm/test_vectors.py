import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import ann, embed_dedup, queries
from harborline.llm.vectors import valid_vectors
from tests.llm.test_simhash import brute_components

SCHEMA = "vec_id bigint, embedding array<float>, key int, n string"
BAD = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [float("inf")] * 8, [1.0, 2.0]]


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], 1, "n") for i,
        v in rows], SCHEMA)


def clustered(r, n, d=8):
    base = r.standard_normal((n, d))
    return np.concatenate([base, base[:20] + 0.02 * r.standard_normal((20, d)),
        base[:10] + 0.2 * r.standard_normal((10, d)), base[5:8] * 3]).astype(np.float32)


@pytest.mark.parametrize("cell_rows,margin", [(10, 0.3123), (10, 0.16), (1000, 0.16)])
def test_links_against_brute_force(spark, cell_rows, margin):
    x = clustered(np.random.default_rng(2), 150)
    rows = [(1000 - i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, v) for i,
        v in enumerate(BAD)] + [(3000, x[0].tolist()), (3001, x[0].tolist()), (3001, x[0].tolist())]
    got = embed_dedup.near_duplicate_vectors(frame(spark, rows), cell_rows=cell_rows, margin=margin).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v, np.float32).astype(float)) for i,
        v in rows if v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    by = {}
    comp = brute_components([(i, k) for k, (i, _) in enumerate(good)], lambda a, b: near[a, b])
    for k, (i, _) in enumerate(good):
        by.setdefault(i, set()).add((int(near[k].sum()) - 1, comp[i, k]))
    for r in got:
        assert (r.n_links, r.component) in by.get(r.id, {(0, r.id)})


@pytest.mark.parametrize("dim,cells,flat", [(64, 20, 1024), (4, 20, 1024), (64, 60, 10)])
def test_planted_pairs_across_many_cells(spark, monkeypatch, dim, cells, flat):
    """Pairs of cosine 0.95 to 0.97, many of them across borders, and a chain; at 4 dimensions many are seen from one side."""
    monkeypatch.setattr(embed_dedup, "FLAT", flat)  # few are fitted at once: the rest in two levels
    r = np.random.default_rng(dim)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(r.standard_normal((1500, dim)))
    side = r.standard_normal((1500, dim))
    side = unit(side - (side * x).sum(1, keepdims=True) * x)
    c = r.uniform(0.95, 0.97, (1500, 1))
    y = c * x + np.sqrt(1 - c * c) * side
    every = np.concatenate([x, y, y[:5], x[:3] * 7]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(every)]
    got = {g.id: g for g in embed_dedup.near_duplicate_vectors(frame(spark, rows), cell_rows=len(rows) // cells)
        .collect()}
    u = unit(every.astype(float))
    near = u @ u.T >= 0.95
    comp = brute_components([(i, i) for i in range(len(u))], lambda a, b: near[a, b])
    assert near.sum() > len(u) + 2000
    for i in range(len(u)):
        assert (got[i].n_links, got[i].component) == (near[i].sum() - 1, comp[i, i])


def test_a_margin_that_could_miss_pairs_is_refused(spark):
    with pytest.raises(ValueError, match="margin"):
        embed_dedup.near_duplicate_vectors(frame(spark, []), threshold=0.9)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.vec_id: r for r in queries.op5_embed_dedup(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    assert all(got[r.vec_id].n_links == near[k].sum() - 1 and got[r.vec_id].kept == (got[
        r.vec_id].component_id == r.vec_id) for k, r in enumerate(rows))


def brute_nearest(rows, asked, k):
    out = {}
    for qi, q in rows:
        if asked(qi):
            s = sorted(((-float((np.array(q) * np.array(v)).sum()), i) for i, v in rows if i != qi))
            out[qi] = s[:k]
    return out


def test_nearest_is_exact_where_it_must_be(spark):
    """Fewer rows than k, ties, copies, unequal lengths, rows that take no part."""
    r = np.random.default_rng(4)
    x = [v.astype(np.float32).tolist() for v in r.standard_normal((9, 8)) * r.uniform(0.2, 5, (9, 1))]
    rows = [(i * 10, v) for i, v in enumerate(x)] + [(300 + i, x[0]) for i in range(30)] + [(5, x[1])]
    df = frame(spark, rows + [(2000 + i * 20, v) for i, v in enumerate(BAD)] + [(None, x[0])])
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=50, tables=2, probes=1).collect()
    want = brute_nearest(rows, lambda i: i % 20 == 0, 50)
    by = {}
    for g in sorted(got, key=lambda g: (g.query_id, g.rank)):
        by.setdefault(g.query_id, []).append((-g.score, g.vec_id))
    assert {q: [i for _, i in v] for q, v in by.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert all(np.allclose([s for s, _ in by[q]], [s for s, _ in want[q]], rtol=1e-12) for q in want)
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def recall(df, **how):
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, **how).collect():
        got.setdefault(r.query_id, []).append(r)
    rows = df.collect()
    x = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    hits = []
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        hits.append(len({r.vec_id for r in got[ids[k]]} & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
        assert sorted(r.rank for r in got[ids[k]]) == list(range(1, 21))
    return np.mean(hits)


@pytest.mark.parametrize("sf,how", [("sf0.01", {}), ("sf0.1", {}), ("sf0.1", {"turns": 2, "probes": 512})])
def test_recall_on_the_whole_table(spark, sf, how):
    assert recall(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet"), **how) >= 0.9


def test_the_plan_keeps_buckets_bounded():
    assert [ann.plan(n, 128)[0] for n in (0, 1000, 4096 * 128, 4096 * 128 + 1, 4096 * 128**2 + 1)] == [1, 1, 1, 2, 3]
    probes = [ann.plan(n, 128)[1] for n in (500, 2000, 10_000, 50_000, 500_000)]
    assert probes == sorted(probes, reverse=True)


def test_best_buckets_are_those_of_all_pairs():
    near = [np.random.default_rng(i).standard_normal((7, 16)) for i in range(2)]
    sums = (near[0][:, :, None] + near[1][:, None]).reshape(7, -1)
    assert (ann.best_buckets(near, 9) == np.argsort(-sums, axis=1)[:, :9]).all()
    assert sorted(ann.best_buckets(near, 256)[0]) == list(range(256))


def test_a_hot_bucket_and_many_queries(spark):
    """A third of all rows point one way; tasks give their best in parts."""
    r = np.random.default_rng(8)
    x = r.standard_normal((900, 8))
    x[:300] = x[0] + 1e-3 * r.standard_normal((300, 8))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got = {}
    for g in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5, probes=16, tables=2).collect():
        got.setdefault(g.query_id, []).append((g.rank, g.vec_id))
    want = brute_nearest([(i, np.array(v, np.float32).astype(float)) for i, v in rows], lambda i: i % 20 == 0, 5)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).standard_normal((5, 16))
    assert np.allclose(np.linalg.norm(ann.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_dimension_is_the_most_frequent(spark):
    df = frame(spark, [(1, [1.0, 2.0]), (2, [1.0]), (3, [2.0, 1.0])])
    good, dim = valid_vectors(df, "vec_id", "embedding")
    assert dim == 2 and sorted(r.id for r in good.collect()) == [1, 3]


def test_recall_where_buckets_take_a_second_turn(spark, monkeypatch):
    """What large tables use, on a small one: two turns, and buckets probed by the best sums of both."""
    monkeypatch.setattr(ann, "FULL", 4)
    r = np.random.default_rng(21)
    base = r.standard_normal((150, 64))
    x = (np.repeat(base, 20, 0) + 0.5 * r.standard_normal((3000, 64))).astype(np.float32)
    assert ann.plan(len(x), 128)[0] == 2
    got = {}
    for g in ann.nearest(frame(spark, list(enumerate(x.tolist()))), F.col("vec_id") % 20 == 0, k=10).collect():
        got.setdefault(g.query_id, {})[g.vec_id] = g.score
    d = x.astype(float)
    found = 0
    for q in range(0, len(x), 20):
        near = d @ d[q]
        near[q] = -np.inf
        top = np.argsort(-near, kind="stable")[:10]
        assert len(got[q]) == 10 and all(abs(near[v] - s) < 1e-9 for v, s in got[q].items())
        found += len(set(top.tolist()) & set(got[q]))
    assert found >= 0.9 * 10 * len(range(0, len(x), 20))


def test_planted_copies_in_the_whole_table_over_cells(spark, sf):
    """The given vectors hold no pair at 0.95; with near copies planted, and cells of 32, all of them link."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    r = np.random.default_rng(9)
    some = [(i, v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    for n, (i, v) in enumerate(some[::7]):
        noise = r.standard_normal(len(v))
        v = np.asarray(v, np.float64)
        rows.append((10**6 + n, (v + noise * 0.2 * np.linalg.norm(v) / np.linalg.norm(noise)).tolist()))
    got = {g.id: g for g in embed_dedup.near_duplicate_vectors(frame(spark, rows), cell_rows=32).collect()}
    good = [(i, np.asarray(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all()
        and any(v)]
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    comp = brute_components([(i, k) for k, (i, _) in enumerate(good)], lambda a, b: near[a, b])
    assert near.sum() > 2 * len(some[::7])
    for k, (i, _) in enumerate(good):
        assert (got[i].n_links, got[i].component) == (int(near[k].sum()) - 1, comp[i, k])


def test_listings_are_bounded_slices():
    from harborline.llm.embed_dedup import listings, unit

    r = np.random.default_rng(2)
    u, cells = unit(r.normal(size=(300, 16))), unit(r.normal(size=(40, 16)))
    whole = [np.concatenate(x) for x in zip(*listings(u, cells, 0.16, 1 << 30), strict=True)]
    parts = list(listings(u, cells, 0.16, 64))
    assert len(parts) > 10 and max(len(i) for i, _ in parts) <= 64 and len(whole[0]) > 640
    assert all((np.concatenate(x) == y).all() for x, y in zip(zip(*parts, strict=True), whole, strict=True))
    assert (np.bincount(whole[0], minlength=300) > 0).all()


def test_no_size_chooses_how_to_search(spark, sf, monkeypatch):
    monkeypatch.setattr(ann, "plan", None)
    got = queries.QUERIES["op3_ann_search"](spark, sf).groupBy("query_id").count().collect()
    assert got and all(r["count"] == 20 for r in got)
