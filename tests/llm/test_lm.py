import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from harborline.llm import lm


def brute_of_order(rows, order, min_count=2, alpha=0.4):
    """The recursion as it is defined, over tuples of words."""
    texts = [(i, (t or "").lower().split()) for i, t in rows]
    count, total = Counter(), 0
    for _, ws in texts:
        total += len(ws)
        for k in range(1, order + 1):
            count.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))

    def score(p, w):
        if not p:
            return count[w,] / total
        return count[*p, w] / count[p] if count[*p, w] >= min_count else alpha * score(p[1:], w)

    return {i: sum(math.log(score(tuple(ws[max(0, j - order + 1) : j]), w)) for j, w in enumerate(ws)) for i,
        ws in texts}


@pytest.mark.parametrize("order,min_count,bits", [(1, 2, 20), (2, 1, 3), (3, 2, 20), (3, 3, 2), (4, 1, 4)])
def test_any_order(spark, order, min_count, bits):
    r = random.Random(order)
    docs = [(i, " ".join(r.choices("a b c d e f".split(), [6, 3, 2, 1, 1, 0.05], k=r.randint(0, 30))))
        for i in range(60)]
    got = {x.id: x.log_score for x in lm.score_documents(spark.createDataFrame(docs, "doc_id bigint, text string"),
        order=order, min_count=min_count, bits=bits).collect()}
    want = brute_of_order(docs, order, min_count)
    assert set(got) == set(want) and all(abs(got[i] - s) < 1e-5 for i, s in want.items())


def brute(rows, vocab, min_count=2, alpha=0.4):
    strip = lambda t: [w for w in (t or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
        if w]
    low = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
    texts = [(i, [low(w) for w in strip(t)]) for i, t in rows]
    uni = Counter(w for _, ws in texts for w in ws)
    keep = {w for w, _ in sorted(uni.items(), key=lambda x: -x[1])[:vocab]}
    texts = [(i, [w if w in keep else None for w in ws]) for i, ws in texts]
    uni, bi, n = Counter(), Counter(), 0
    for _, ws in texts:
        uni.update(ws)
        bi.update(zip(ws, ws[1:]))
        n += len(ws)
    out = {}
    for i, ws in texts:
        s = math.log(uni[ws[0]] / n) if ws else 0.0
        for p, w in zip(ws, ws[1:]):
            s += math.log(bi[p, w] / uni[p] if bi[p, w] >= min_count else alpha * uni[w] / n)
        a, b = out.get(i, (0, 0.0))
        out[i] = (a + len(ws), b + s)
    return out


@pytest.mark.parametrize("hot_bits", [20, 6, 0])
def test_against_brute_force(spark, sf, hot_bits):
    """All grams met in the task, few of them, and (almost) none."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs += [(10_000, None), (10_001, " \n"), (10_002, "One"), (None, "the the"), (None, "the end"), (0, "again"),
        (10_003, "the of " * 50_000)]
    df = spark.createDataFrame([(*d, 1, "s") for d in docs],
        "doc_id bigint, text string, n int, id string").repartition(5)
    got = {r.id: r for r in lm.score_documents(df, bits=hot_bits).collect()}
    want = brute(docs, 1 << 40)
    assert set(got) == set(want)
    for i, (n, s) in want.items():
        assert got[i].n_tokens == n and abs(got[i].log_score - s) < 1e-6 * max(1, abs(s))
        assert (got[i].mean_log_score is None) == (n == 0)


def test_result_does_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, many = (sorted(map(tuple, lm.score_documents(docs.repartition(k)).collect())) for k in (1, 7))
    assert one == many


def test_a_bound_of_the_histogram(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(7,)] * 5 + [(100,)] * 3 + [(101,)], "n bigint")
    assert [lm.most_frequent(df, k) for k in (0, 3, 4, 8, 9, 58, 59)] == [102, 102, 100, 100, 7, 7, 1]
    assert lm.most_frequent(df.limit(0), 5) == 1


def test_empty_and_wrong(spark):
    assert lm.score_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    blank = lm.score_documents(spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")).collect()
    assert sorted((r.id, r.n_tokens, r.log_score, r.mean_log_score) for r in blank) == [(1, 0, 0.0, None),
        (2, 0, 0.0, None)]


def test_all_words_count_in_a_large_vocabulary(spark):
    docs = [(i, " ".join(f"w{i * 100 + k}" for k in range(100))) for i in range(800)]
    docs += [(1000, "w1 w2 w3"), (1001, "w79998 w79999"), (1002, "w79998 w3 never seen")]
    got = {r.id: r.log_score for r in lm.score_documents(spark.createDataFrame(docs, "doc_id bigint, text string")
        .repartition(3)).collect()}
    want = brute(docs, 1 << 40)
    assert set(got) == set(want) and all(abs(got[i] - s) < 1e-6 * abs(s) for i, (_, s) in want.items())


def test_no_gram_that_is_shuffled_is_hot(spark):
    """From a share of all tokens on a gram is met in the task, so the rest has few occurrences each."""
    text = " ".join(["hot word"] * 50_000 + [f"w{i}" for i in range(50_000)])
    docs = spark.createDataFrame([(i, text) for i in range(2)], "id bigint, text string")
    model = lm.train(docs, bits=10)
    least = lm.hot_count(model.total)
    assert model.weights.where(F.col("n") >= least).count() <= 1 << 10
    assert model.weights.where(F.col("n") < least).agg(F.max("n")).first()[0] == 2


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_most_weights_come_from_the_join(spark, sf):
    """Of the weights, all of which some document meets, the broadcast table holds only the hot ones."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    model = lm.train(docs)
    least = lm.hot_count(model.total)
    rows, met = model.weights.select(F.count(F.lit(1)), F.count_if(F.col("n") < least)).first()
    uses, joined = model.weights.select(F.sum("n"), F.sum(F.when(F.col("n") < least, F.col("n")))).first()
    assert met > rows / 2 and joined > uses / 4
    assert lm.hot_count(10**12) * lm.HOT_SHARE >= 10**12 and lm.hot_count(0) == lm.HOT_LEAST
