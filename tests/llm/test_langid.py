import math
import zlib

import numpy as np

from harborline.llm import langid, queries

LANGS = ["a", "b", "c"]


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    data, label = r.integers(1, 255, (5, 7)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    mask = np.ones((5, 7))
    mask[2, 4:] = 0
    net = langid.ByteGRU.fresh(LANGS, 3, 1)
    net.x, net.u, net.out = (w.astype(np.float64) for w in (net.x, net.u, net.out))
    _, grads = net.gradients(data, label, mask)
    for w, g in zip((net.x, net.u, net.out), grads):
        for flat in np.argsort(-np.abs(g), axis=None)[:5]:
            i = np.unravel_index(flat, g.shape)
            old, e = w[i], 3e-3
            w[i] = old + e
            up = net.gradients(data, label, mask)[0]
            w[i] = old - e
            down = net.gradients(data, label, mask)[0]
            w[i] = old
            assert abs(g[i] - (up - down) / (2 * e)) < 2e-3 * max(1, abs(g[i]))


def forward(net, text):
    """Probabilities of a whole text, byte by byte, unit by unit, in plain Python."""
    hidden, classes = net.u.shape[2], len(net.langs)
    sums = [0.0] * classes
    for at in range(0, len(text), langid.WINDOW):
        window = text[at : at + langid.WINDOW]
        padded = list(window) + [0] * (langid.WINDOW - len(window))
        states = []
        for d in range(2):
            h, seen = [0.0] * hidden, []
            for byte in padded if d == 0 else padded[::-1]:
                a = [float(net.x[d, g, byte]) for g in range(3 * hidden)]
                uh = [sum(float(net.u[d, g, k]) * h[k] for k in range(hidden)) for g in range(3 * hidden)]
                z = [1 / (1 + math.exp(-a[k] - uh[k])) for k in range(hidden)]
                r = [1 / (1 + math.exp(-a[hidden + k] - uh[hidden + k])) for k in range(hidden)]
                n = [math.tanh(a[2 * hidden + k] + r[k] * uh[2 * hidden + k]) for k in range(hidden)]
                h = [(1 - z[k]) * n[k] + z[k] * h[k] for k in range(hidden)]
                seen.append(h)
            states.append(seen if d == 0 else seen[::-1])
        for t in range(len(window)):
            s = [*states[0][t], *states[1][t], 1.0]
            e = [math.exp(sum(float(w) * v for w, v in zip(net.out[c], s))) for c in range(classes)]
            for c in range(classes):
                sums[c] += e[c] / sum(e)
    return [v / max(1, len(text)) for v in sums]


def test_whole_documents_against_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = langid.train(docs, per_lang=30, steps=40, hidden=4)
    texts = sorted({r.text for r in docs.collect() if r.text and len(r.text) < 900})[:12] + ["x", "é" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in langid.predict(df, net).collect():
        p = forward(net, r.text.encode())
        assert abs(max(p) - r.score) < 1e-4
        assert r.lang_pred == net.langs[p.index(max(p))] or sorted(p)[-1] - sorted(p)[-2] < 2e-4


def test_windows_and_batches_dont_change_a_document():
    net = langid.ByteGRU.fresh(LANGS, 4, 2)
    texts = [b"x", b"hello there " * 300, b"", b"q" * langid.WINDOW, b"z" * (langid.WINDOW + 1)]
    together, alone = net.documents(texts), np.concatenate([net.documents([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    assert np.allclose(together.sum(1), [1, 1, 0, 1, 1], atol=1e-4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op10_language_id(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    right = [got[d.doc_id].lang_pred == d.lang for d in docs if got[d.doc_id].held_out]
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) for d in docs)
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in got.values())


def test_whole_training_texts_do_as_well_as_windows_of_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    right = {}
    for windows in (3, None):
        got = langid.identify(docs, windows=windows).where("held_out").select("doc.lang", "lang_pred").collect()
        right[windows] = np.mean([r.lang == r.lang_pred for r in got])
    assert abs(right[3] - right[None]) < 0.01 and right[None] > 0.97


def test_hard_rows(spark):
    en, de = "the of and in the word is ", "der und ist nicht ein wort das "
    rows = [(i, (en, de)[i % 2] * 20, ("en", "de")[i % 2]) for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 .. 34\n", "de"), (103, en * 20_000, None), (None, de, None),
        (7, rows[7][1], "de"), (104, "日本", None)]
    docs = spark.createDataFrame([(*r, "x", 1.0, True) for r in rows],
        "doc_id bigint, text string, lang string, lang_pred string, score double, held_out boolean")
    out = langid.identify(docs, steps=60, per_lang=20).select("doc.doc_id", "lang_pred", "score").collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert (got[103].lang_pred, got[None].lang_pred, got[104].lang_pred in ("en", "de")) == ("en", "de", True)
    unlabelled = docs.withColumn("lang", docs.lang.substr(9, 9)).where("lang is null or lang <> ''").where(
        "doc_id = 103")
    assert [tuple(r) for r in langid.identify(unlabelled).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0
