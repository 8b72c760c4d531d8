import hashlib
import itertools
import random
import unicodedata
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
import tiktoken

import corpus_pipeline
from harborline.llm import bpe, queries
from harborline.llm.common import settle, table
from harborline.llm.simhash import shingle_hashes
from tests.llm.test_native import brute_lines


def test_stages_on_planted_cases(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choices(["th", "er", "ing", "an", "on", "re"], k=r.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = "all rights reserved by nobody at all"
    rows = [(i, text(120) + ("\n" + shared if i % 3 == 0 else ""), "en", f"s{i % 4}", 0, "extra") for i in range(80)]
    w = rows[1][1].split()
    w[60] = "changed"
    rows += [(100, rows[2][1], "en", "s0", 0, "x"), (101, " ".join(w), "en", "s1", 0, "x"),
        (102, "12 34 !!", None, "s1", 0, "x"), (103, None, None, None, 0, "x"), (104, shared, "en", "s2", 0, "x")]
    docs = spark.createDataFrame(rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, note string")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, docs, ""))
        out[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    ids = {k: sorted(x.doc_id for x in v) for k, v in out.items()}
    assert ids["language ID"] == [*range(80), 100, 101, 104]
    assert ids["line dedup"] == [*range(80), 100, 101, 104] and all(shared not in x.text for x in out["line dedup"])
    assert ids["near-dedup by shingle similarity"] == [*range(80), 104]  # nothing is left of 104, which the mix then passes over
    assert set(ids["mixing sources"]) <= set(range(80)) and ids["BPE tokens"] == ids["mixing sources"]
    assert all(x.n_tokens == len(x.token_ids) > 0 for x in out["BPE tokens"])
    texts = {x.doc_id: x.text for x in out["mixing sources"]}
    assert all(x.decoded_sha256 == hashlib.sha256(texts[x.doc_id].encode()).hexdigest() for x in out["BPE tokens"])


def brute_groups(docs):
    """Of each group of texts of similarity 0.8 or more, the least id."""
    sets = {i: set(shingle_hashes(t).tolist()) for i, t in docs.items()}
    group = {i: i for i in docs}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sorted(docs), 2):
        x, y = sets[a], sets[b]
        if docs[a] == docs[b] or (x and y and len(x & y) >= 0.8 * len(x | y)):
            a, b = sorted((top(a), top(b)))
            group[b] = a
    return {i for i in docs if group[i] == i}


def test_every_stage_of_a_run_against_plain_python(spark, sf):
    docs = {r.doc_id: (r.text, r.source) for r in table(spark, sf, "documents").collect()}
    want = {i: t for i, (t, _) in docs.items() if t and any(unicodedata.category(c)[0] == "L" for c in t)}
    want = {i: kept for i, _, _, kept in brute_lines(sorted(want.items()), 10)}
    want = {i: want[i] for i in brute_groups(want)}
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(want), "source": [docs[i][1] for i in want], "text": list(
        want.values())}))
    mixed = {i: taken // size for i, size, _, _, taken in con.execute("SELECT doc_id, size, source_size, target, taken FROM ("
        + queries.ORACLE["op7_mix_sources"] + ")").fetchall() if taken}
    with open(queries.ranks_path(), "rb") as f:
        ranks = bpe.Vocabulary(f.read()).ranks
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = corpus_pipeline.run(spark, sf).collect()
    assert Counter(r.doc_id for r in got) == Counter(mixed) and len(mixed) < len(want) < len(docs)
    for r in got:
        assert r.token_ids == coder.encode_ordinary(want[r.doc_id]) and r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


def test_stages_on_hard_tables(spark):
    """Empty tables, repeated rows, null columns and a very long text, in every stage."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string, body string"
    long = " ".join(f"w{i % 9973}" for i in range(200_000))
    rows = [(1, long, "en", None, None, "a", "b"), (1, long, "en", None, None, "a", "b"),
        (None, "some words here", None, "s", 1, None, None), (3, None, None, None, None, None, None)]
    for docs, want in ((spark.createDataFrame([], schema), set()),
        (spark.createDataFrame(rows + [(4, "was ist das", "de", "s", 9, "a", "b")], schema), {1, None, 4})):
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, ""))
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= want
            if name == "near-dedup by shingle similarity":
                assert sorted(r.doc_id or 0 for r in docs.collect()) == sorted(i or 0 for i in want)
