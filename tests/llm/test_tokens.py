import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from harborline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks,
        special_tokens={})


HARD = ["", "it's we're I'll 'st ''s '", "'", "a'", "x'l", "\n\n\n", " ", "  a", "a  ", "\t x", "　　y", "<|endoftext|>",
    "x" * 5000, " " * 3000, "é" * 300, "12 345", "😀😀 a", "..'s", " 's", "\r\n\r\nA"]


def test_boundaries_are_the_patterns():
    r = random.Random(2)
    alphabet = list("abst'rvelmd  \n\t .,!1²五éÉ𝒳😀　 _")
    for t in HARD + ["".join(r.choices(alphabet, k=r.randint(1, 50))) for _ in range(3000)]:
        points = np.array([ord(c) for c in t], np.uint32)
        first = np.arange(len(t)) == 0
        assert np.flatnonzero(bpe.boundaries(points, first)).tolist() == [m.start()
            for m in regex.finditer(public_tokenizers.PATTERN, t)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=6))
def test_as_the_library(vocabulary, library, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    n, ids, _ = vocabulary.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode_ordinary(t)
        for t in texts] if texts else True


def test_long_pieces_as_short(vocabulary):
    r = random.Random(4)
    for _ in range(300):
        piece = bytes(r.choices(b"abcdeing thio", k=r.randint(2, 90)))
        if piece not in vocabulary.ranks:
            assert vocabulary._merge_long(piece) == np.frombuffer(vocabulary.merge([piece])[0], np.int32).tolist()


def test_round_trip_and_offsets(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(9000 + i, t) for i, t in enumerate(HARD)] + [(None, "null id"), (9999, None),
        (1, "again"), (1, "again")], "doc_id bigint, text string")
    every = docs.union(extra)
    rows = bpe.decode(bpe.encode(every.withColumn("token_ids", every.doc_id), PATH), PATH).collect()
    once = bpe.round_trip(every, PATH).collect()
    assert sorted(once, key=str) == sorted(rows, key=str)
    want = Counter((r.doc_id, r.text or "") for r in every.collect())
    assert Counter((r.id, bytes(r.decoded).decode()) for r in rows) == want
    for r in rows:
        text = bytes(r.decoded)
        assert r.token_ids == library.encode_ordinary(text.decode())
        assert (r.token_ends or [0])[-1] == len(text)
        starts = [0, *r.token_ends[:-1]]
        assert all(text[a:b] == library.decode_single_token_bytes(t) for a, b,
            t in zip(starts, r.token_ends, r.token_ids))
    assert bpe.encode(every.limit(0), PATH).count() == 0
