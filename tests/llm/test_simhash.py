import hashlib
import os
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from harborline.llm import simhash


def brute_fingerprint(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        bits.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(shingles))


def brute_components(items, linked):
    """items: [(id, key)]; the least id of each key's component."""
    keys = sorted({k for _, k in items})
    label = {k: k for k in keys}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if linked(a, b):
                label[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, k in items:
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return {(i, k): least.get(find(k)) for i, k in items}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "A b C d", "x y z w v u t", "é É x y b c d e",
    "w " * 3000, "\x0b\x0ca\rb"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(text, 1) == brute_fingerprint(text, 1)


def test_trees_find_all_within():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 20, np.uint64)
    fps = np.unique(np.array([b ^ np.uint64(sum(1 << int(x) for x in r.choice(64, r.integers(0, 7), False)))
        for b in base for _ in range(30)], np.uint64))
    trees = simhash.BKTrees(fps, np.zeros(len(fps), np.int64))
    for radius in (0, 3, 4, 9):
        who, node = trees.within(fps, np.zeros(len(fps), np.int64), radius)
        want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if bin(int(fps[i]) ^ int(fps[j]))
            .count("1") <= radius}
        assert set(zip(who.tolist(), node.tolist())) == want and len(who) == len(want)


def words(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=3)) for _ in range(n))


@pytest.mark.parametrize("tile", [simhash.TILE, 8])
def test_links_connect_as_brute_force(spark, tile):
    r = random.Random(3)
    fps = set()
    for _ in range(40):
        f = r.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            for b in r.sample(range(64), r.randint(1, 4)):
                f ^= 1 << b
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp bigint"), tile=tile).collect()
    near = lambda a, b: bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 4
    pairs = {(x.a, x.b) for x in links} | {(x.b, x.a) for x in links}
    items = [(f, f) for f in signed]
    assert brute_components(items, lambda a, b: (a, b) in pairs) == brute_components(items, near)


def test_near_duplicates_against_brute_force(spark):
    r = random.Random(5)
    rows = []
    for i in range(60):
        t = words(r, r.choice([1, 3, 60, 200]))
        rows.append((i, t))
        if i % 3 == 0:
            w = t.split()
            w[len(w) // 2] = "changed"
            rows += [(100 + i, " ".join(w)), (200 + i, t), (300 + i, t.upper() + "\n")]
    rows += [(400, None), (401, ""), (402, "  \n"), (None, rows[0][1]), (5, rows[5][1]), (999, "long " * 40_000)]
    docs = spark.createDataFrame([(*x, "x", 1) for x in rows], "doc_id bigint, text string, fp string, id int")
    got = simhash.near_duplicates(docs).collect()
    items = [(i, brute_fingerprint(t)) for i, t in rows]
    want = brute_components(items, lambda a, b: bin(a ^ b).count("1") <= 4)
    assert Counter((x.id, x.fp & ((1 << 64) - 1), x.component) for x in got) == Counter((i, k, want[i, k]) for i,
        k in items)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each_group(docs).count() == 0


def jaccard(a, b, width=5):
    s = [{" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}
        for w in (a.lower().split(), b.lower().split())]
    return len(s[0] & s[1]) / len(s[0] | s[1])


def near_copy(r, t, changes):
    w = t.split()
    for k in r.sample(range(len(w)), changes):
        w[k] = "new" + str(k)
    return " ".join(w)


def test_one_of_each_group_stays(spark):
    r = random.Random(8)
    rows, i = [], 0
    for g in range(25):
        t = words(r, 150)
        rows.append((i, t))
        for c in (0, 1, 2):
            i += 1
            rows.append((i, near_copy(r, t, c)))
        i += 1
        rows.append((i, words(r, 150)))
        i += 1
    rows += [(None, rows[0][1]), (i, None), (i + 1, ""), (i + 2, "one"), (i + 3, "one"), (7, rows[7][1])]
    docs = spark.createDataFrame([(*x, 2, "m") for x in rows], "doc_id bigint, text string, id int, _md5 string")
    got = simhash.one_of_each_group(docs)
    assert got.columns == docs.columns
    texts = sorted({t or "" for _, t in rows})
    node = {t: k for k, t in enumerate(texts)}
    groups = brute_components([(node[t], node[t]) for t in texts], lambda a,
        b: bool(texts[a].split() and texts[b].split()) and jaccard(texts[a], texts[b]) >= 0.8)
    best = {}
    for d, t in rows:
        g = groups[node[t or ""], node[t or ""]]
        if d is not None:
            best[g] = min(d, best.get(g, d))
    assert sorted(x.doc_id for x in got.collect()) == sorted(best.values())


def test_spanning_forest_keeps_the_strongest():
    a, b, w = np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4]), np.array([0.9, 0.8, 0.7, 0.5])
    assert sorted(simhash.spanning_forest(a, b, w, 6).tolist()) == [0, 1, 3]


def block_edit(r, t, kind, share):
    """``t`` with a tail cut, a passage appended, or its tail replaced."""
    w = t.split()
    k = int(len(w) * share)
    return " ".join({"cut": w[: len(w) - k], "appended": w + words(r, k).split(),
        "replaced": w[: len(w) - k // 2] + words(r, k // 2).split()}[kind])


def test_block_edits_against_brute_force(spark):
    r = random.Random(11)
    pairs = []
    for kind in ("cut", "appended", "replaced"):
        for n in (25, 60, 150, 400):
            for share in (0.1, 0.14, 0.17, 0.19):
                for _ in range(8):
                    t = words(r, n)
                    pairs.append((t, block_edit(r, t, kind, share)))
    pairs += [(t, t + " " + "again " * 4000) for t in (words(r, 60)
        for _ in range(4))]  # one shingle more, another mix of words
    docs = spark.createDataFrame([(t,) for p in pairs for t in p], "text string")
    group = {x.id: x.component for x in simhash.similar_texts(docs).collect()}
    name = lambda t: hashlib.md5(t.encode()).hexdigest()
    found = [group.get(name(a), 0) == group.get(name(b), 1) for a, b in pairs]
    assert found == [jaccard(a, b) >= 0.8 for a, b in pairs]
    assert sum(0.8 <= jaccard(a, b) <= 0.9 for a, b in pairs) > 200


@pytest.mark.parametrize("how", [{}, {"most": 8000}])
def test_groups_near_the_threshold_against_brute_force(spark, how):
    r = random.Random(13)
    texts = []
    for n, edits in [(400, 5), (400, 6), (150, 2), (60, 1)] * 4:
        t = words(r, n)
        texts += [near_copy(r, t, edits) for _ in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    node = {hashlib.md5(t.encode()).hexdigest(): t for t in texts}
    names = sorted(node)
    shingles = {k: {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for k,
        w in ((k, t.split()) for k, t in node.items())}
    want = brute_components([(k, k) for k in names], lambda a,
        b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]))
    got = {x.id: x.component for x in simhash.similar_texts(docs, **how).collect()}
    assert {k: got.get(k, k) for k in names} == {k: want[k, k] for k in names}
    assert 16 < len(set(want.values())) < len(names)


def test_whole_table_against_brute_force_similarity(spark):
    """Every pair of texts of 0.8 or more is in one group, and no group holds what no chain of such pairs connects."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {hashlib.md5((r.text or "").encode()).hexdigest(): r.text for r in docs.collect()}
    names, sets = list(texts), [set(simhash.shingle_hashes(t).tolist()) for t in texts.values()]
    held, common = {}, Counter()
    for i, s in enumerate(sets):
        for h in s:
            for j in held.setdefault(h, []):
                common[j, i] += 1
            held[h].append(i)
    linked = {p for p, n in common.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
    got = {r.id: r.component for r in simhash.similar_texts(docs).collect()}
    assert linked and all(got.get(names[i], i) == got.get(names[j], j) for i, j in linked)
    want = brute_components([(names[i], i) for i in range(len(names))], lambda a, b: (a, b) in linked)
    assert got == {n: c for (n, i), c in want.items() if any(i in p for p in linked)}


def test_a_shard_of_near_copies_takes_little_memory():
    code = """
import resource, time
import numpy as np
from harborline.llm import simhash
r = np.random.default_rng(0)
n = simhash.TILE
sketches = np.repeat(r.integers(1, 256, (1, simhash.BINS), np.uint8), n, 0)
odd = r.random((n, simhash.BINS)) < 0.2
sketches[odd] = r.integers(1, 256, int(odd.sum()), np.uint8)
before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
a, b = simhash.likely_classes(np.zeros(n, np.int64), np.full(n, 100), sketches, 0.8, 0.5)
assert len(a) == n - 1, len(a)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024, time.process_time() - began)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300,
        cwd=os.getcwd())
    mb, seconds = map(float, out.stdout.split())
    assert mb < 200 and seconds < 60


def quoting_texts(r, n, passage):
    """Texts of their own words that all quote one passage, every tenth with a near copy."""
    out = []
    for i in range(n):
        own = [f"w{r.randrange(10**6)}" for _ in range(120)]
        out.append(" ".join(own[:60] + passage + own[60:]))
        if i % 10 == 0:
            own[30] = own[90] = "changed"
            out.append(" ".join(own[:60] + passage + own[60:]))
    return out


def test_texts_that_quote_one_passage_are_not_all_compared(spark):
    """Pairs that meet in a shard grow with the texts, not with their square, and near copies are still found."""
    r = random.Random(12)
    passage = [f"p{i}" for i in range(40)]
    met = {}
    for n in (400, 1600):
        texts = quoting_texts(r, n, passage)
        sets = [simhash.shingle_hashes(t) for t in texts]
        rows = [(str(i), len(s), b"", simhash.shard_shingles(s).view(np.int64).tolist(), simhash.more_shingles(s).view(
            np.int64).tolist()) for i, s in enumerate(sets)]
        distinct = spark.createDataFrame(rows, "id string, size bigint, sketch binary, shards array<bigint>, more array<bigint>")
        shards = simhash.shard_members(distinct, 40).groupBy("shard").count().collect()
        met[n] = sum(x["count"] * (x["count"] - 1) // 2 for x in shards)
        assert max(x["count"] for x in shards) <= 40
    assert met[1600] < 6 * met[400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {x.doc_id for x in simhash.one_of_each_group(docs, tile=40).collect()}
    copies = {i for i in range(1, len(texts)) if i % 11 == 1}
    assert kept == set(range(len(texts))) - copies


def test_texts_that_are_mostly_one_passage_stay_together(spark):
    r = random.Random(13)
    passage = [f"p{i}" for i in range(200)]
    texts = [" ".join(passage + [f"w{r.randrange(10**6)}" for _ in range(8)]) for _ in range(120)]
    texts += [" ".join(f"v{r.randrange(10**6)}" for _ in range(200)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {x.doc_id for x in simhash.one_of_each_group(docs, tile=32).collect()}
    assert kept == {0, *range(120, 150)}


def test_near_texts_are_linked_through_bk_trees(spark, monkeypatch):
    """Without any shard of shingles the fingerprints alone link what is within their radius, and the exact check follows."""
    r = random.Random(14)
    texts = [words(r, 400) for _ in range(12)]
    texts += [near_copy(r, t, 1) for t in texts] + ["x y z " * 300 + words(r, 40) for _ in range(2)]
    names = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    fps = [simhash.majority(simhash.shingle_hashes(t)) for t in texts]
    near = brute_components([(n, f) for n, f in zip(names, fps, strict=True)], lambda a, b: bin(a ^ b).count("1") <= 4)
    monkeypatch.setattr(simhash, "shard_members", lambda distinct, tile: distinct.select(F.lit(0).cast("long").alias("shard"),
        "id", "size", "sketch", "class").limit(0))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {x.id: x.component for x in simhash.similar_texts(docs).collect()}
    assert {n: got.get(n, n) for n in names} == {n: near[n, f] for n, f in zip(names, fps, strict=True)}
    assert len(set(got.values())) >= 6


def test_classes_that_are_known_are_not_searched_again():
    r = np.random.default_rng(1)
    sketches = np.repeat(r.integers(1, 256, (1, simhash.BINS), np.uint8), 6, 0)
    group, sizes = np.zeros(6, np.int64), np.full(6, 100)
    assert not len(simhash.likely_classes(group, sizes, sketches, 0.8, 0.5, np.zeros(6, np.int64))[0])
    a, b = simhash.likely_classes(group, sizes, sketches, 0.8, 0.5, np.array([7, 7, 9, 9, 9, 9]))
    assert sorted(a.tolist()) == [2, 3, 4, 5] and set(b.tolist()) == {0}
