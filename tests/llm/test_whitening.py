"""Whitening against plain numpy over all rows, and on hard rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, n int, x string, id int, component string"
BAD = [None, [], [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [float("inf")] * 8, [-float("inf")] * 8, [1.0, 2.0],
    [3e38] * 8]


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v], 1, "x", 7, "c")
        for i, v in rows], SCHEMA)


def brute(vectors):
    """(n, S, whole vectors, covariance centred before multiplying), in exact whole numbers as far as they go."""
    x = np.floor(1024 * np.asarray(vectors, np.float32).astype(float)).astype(object) + 100_000
    x = np.array([[int(c) for c in r] for r in x], object)
    n, s = len(x), x.sum(0)
    y = n * x - s
    return n, s, x, (y.T @ y / n**3).astype(float)


def check(rows, vectors, ids, k=8):
    n, s, x, cov = brute(vectors)
    value = np.linalg.eigvalsh(cov)[::-1]
    k = min(k, x.shape[1])
    assert len(rows) == n * k
    deviation = Counter((i, str(sum(int(c) ** 2 for c in n * r - s))) for i, r in zip(ids, x, strict=True))
    assert Counter((r.id, str(r.deviation)) for r in rows if r.component == 1) == deviation
    assert {r.n for r in rows} == {n}
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append((-1 if r.id is None else r.id, str(r.deviation), r.whitened, r.explained))
    order = sorted(range(n), key=lambda i: (-1 if ids[i] is None else ids[i], str(sum(int(c) ** 2 for c in n * x[i] - s))))
    centred = (x - s / n).astype(float)[order]
    w = np.array([[t[2] for t in sorted(by[c], key=lambda t: t[:2])] for c in range(1, k + 1)]).T
    seen = np.cov(w.T, bias=True)
    assert np.abs(seen - np.eye(k)).max() < 1e-9
    for c in range(k):
        assert math.isclose(by[c + 1][0][3], value[c] / np.trace(cov), rel_tol=1e-9)
        # the direction is an eigenvector: fitting the projections on the rows gives it back
        axis = centred.T @ w[:, c] / n
        assert np.linalg.norm(cov @ axis - value[c] * axis) < 1e-7 * value[0] * np.linalg.norm(axis)
        assert np.allclose(centred @ (axis / np.linalg.norm(axis)) / math.sqrt(value[c]), w[:, c], atol=1e-7)
    assert max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1


@pytest.mark.parametrize("dim,tile,block", [(8, 32, 1 << 18), (8, 3, 40), (11, 4, 1 << 18), (3, 1, 9)])
def test_against_numpy(spark, monkeypatch, dim, tile, block):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", block)
    r = np.random.default_rng(dim)
    v = (r.standard_normal((300, dim)) @ r.standard_normal((dim, dim)) + 5 * r.standard_normal(dim)).astype(np.float32)
    v[7] = 0
    v = np.concatenate([v, v[:3], np.repeat(v[4:5], 150, 0)])  # repeated rows, a third of them one vector
    ids = [None if i == 5 else i % 290 for i in range(len(v))]
    rows = list(zip(ids, v.tolist(), strict=True)) + [(2000 + i, b) for i, b in enumerate(BAD) if dim == 8 or not b or len(
        b) != 2]
    if dim != 8:  # of another length: left out
        rows = [x for x in rows if x[1] is None or len(x[1]) in (0, 8, dim)]
    check(whitening.whiten(frame(spark, rows), tile=tile).collect(), v, ids)


def test_one_row_equal_rows_and_no_rows(spark):
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    equal = whitening.whiten(frame(spark, [(i, [0.5, 1.0 + (i == 3)]) for i in range(9)])).collect()
    assert len(equal) == 18 and all((r.whitened is None) == (r.component == 2) for r in equal)
    assert equal[0].identity_error < 1e-9
    none = whitening.whiten(frame(spark, [(1, None), (2, [])]))
    assert none.count() == 0 and none.columns == ["id", "component", "n", "deviation", "whitened", "explained",
        "identity_error"]
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, [(1, [1.0] * (whitening.MAX_DIM + 1))]))


def test_whole_table(spark, sf):
    every = spark.read.parquet(f"{sf}/embeddings.parquet").where("embedding is not null").collect()
    got = queries.op11_whitening(spark, sf)
    assert dict(got.dtypes) | {"n": "bigint", "deviation": "bigint", "component": "int"} == dict(got.dtypes)
    rows = got.withColumn("id", F.col("vec_id")).collect()
    check(rows, [r.embedding for r in every], [r.vec_id for r in every])
    assert all(str(r.deviation) == r.deviation_exact for r in rows)
