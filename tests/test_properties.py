"""Scalars and operators against plain Python on generated values."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.functions import numbers, text
from harborline.operators import joins, windows

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
cell = st.one_of(st.none(), st.text(alphabet="ab: :\t(),.-+1290eE d", max_size=12))


def sku(x):
    if x is None:
        return None
    return " ".join(x.split(":")[-1].split()).upper() or None


def number(x):
    if x is None:
        return None
    t = x.strip().replace(",", "")
    m = re.fullmatch(r"\((.*)\)", t)
    inner = (m[1] if m else t).strip()
    if not re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?", inner):
        return None
    return -float(inner) if m else float(inner)


@few
@given(st.lists(cell, min_size=1, max_size=60))
def test_scalars(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: (r.s, r.n) for r in df.select("i", text.canonical_sku(F.col("x")).alias("s"),
        numbers.parse_number(F.col("x")).alias("n")).collect()}
    for i, v in enumerate(values):
        assert got[i][0] == sku(v)
        assert got[i][1] == pytest.approx(number(v), nan_ok=True)


@few
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 50)), min_size=1, max_size=40))
def test_cumulative_share(spark, values):
    df = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(values)], "k int, v long")
    got = {r.k: (r.cumulative, r.grand) for r in windows.cumulative_share(df, "v", "k").collect()}
    run = 0
    for k, v in sorted(enumerate(v for _, v in values), key=lambda x: (-x[1], x[0])):
        run += v
        assert got[k] == (run, sum(v for _, v in values))


@few
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9)), max_size=12),
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 9)), max_size=12))
def test_effective(spark, rates, facts):
    rates = {(k, d): float(i) for i, (k, d) in enumerate(rates)}
    r = spark.createDataFrame([(k, d, v) for (k, d), v in rates.items()], "k string, since int, rate double")
    f = spark.createDataFrame([(k, d) for k, d in facts], "k string, day int")
    got = sorted((x.k, x.day, x.rate) for x in joins.effective(f, r, ["k"], "day", "since", ["rate"]).fillna(-1.0)
        .collect())
    want = []
    for k, day in facts:
        ok = [(d, v) for (q, d), v in rates.items() if q == k and d <= day]
        want.append((k, day, max(ok)[1] if ok else -1.0))
    assert got == sorted(want)
