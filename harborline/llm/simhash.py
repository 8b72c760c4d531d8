"""SimHash near-dedup: fingerprints linked within a radius through BK-trees.

Two 64-bit fingerprints that differ in at most r bits agree on at least m - r
of m blocks of bits. Every distinct fingerprint goes to one shard for each
choice of m - r blocks, so linked ones meet in some shard. A shard builds a
BK-tree, children keyed by their integer Hamming distance to the parent, and
each member follows only edges within the radius. A tree travels to the task
that owns its shard instead of being broadcast: all trees together are as
large as the corpus, which no broadcast may be. Shards that are too large are
cut into tiles before they are dealt, and every two tiles meet in a task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, settle, whole_row
from .components import connected_components

#: Fingerprints a shard may have before it is cut into tiles.
TILE = 8192
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_UPPER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles of a whole text.

    A-Z lower-cased, ``width`` words a shingle joined by one space, repeats
    included; fewer words are one shingle, none (or null) gives zero. A bit is
    set if it is set in over half of the shingles' XXH64.
    """
    words = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_UPPER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:k].tolist(), ends[min(width, len(words)) - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, k)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: a bit is set if it is set in over half of them."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bits of a very long text are counted in slices
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp): one row for each row of ``docs``; ``fp`` as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    prepare(docs.sparkSession)
    ids = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = ids.schema["id"].dataType.simpleString()
    return ids.mapInArrow(each, f"id {kind}, fp bigint")


def block_masks(radius: int = 4, blocks: int = 6) -> list[int]:
    """The bits that each table keys by: every choice of ``blocks - radius`` blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(one, blocks - radius)]


class BKTrees:
    """BK-trees of many shards at once, built and searched level by level.

    ``root`` names the shard of each of ``fps`` by the position of its first
    member, which is the root of the shard's tree.
    """

    def __init__(self, fps: np.ndarray, root: np.ndarray):
        self.fps, self.root = fps, root
        at = np.flatnonzero(root != np.arange(len(fps)))
        node, keys, kids = root[at], [], []
        while len(at):
            edge = node * 65 + np.bitwise_count(fps[at] ^ fps[node])
            key, first, which = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(key)
            kids.append(at[first])
            down = np.ones(len(at), bool)
            down[first] = False
            node, at = at[first][which][down], at[down]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.keys, self.kids = key[order], (np.concatenate(kids)[order] if kids else key)

    def within(self, asked: np.ndarray, trees: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in asked, node) of each node within the radius in the named tree."""
        who, node, found = np.arange(len(asked)), trees, []
        while len(who):
            d = np.bitwise_count(asked[who] ^ self.fps[node]).astype(np.int64)
            near = d <= radius
            found.append((who[near], node[near]))
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0), "left")
            n = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right") - lo
            who = np.repeat(who, n)
            node = self.kids[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (who, who)


def _least(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of a and b; the least place labels a class."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]


def shard_links(shard: np.ndarray, fps: np.ndarray, radius: int, part: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each shard: (fp, fp of its class)."""
    order = np.lexsort((fps, shard))
    fps, shard = fps[order], shard[order]
    new = np.concatenate(([True], shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, bool)
    root = np.maximum.accumulate(np.where(new, np.arange(len(fps)), 0))
    size = np.bincount(root, minlength=len(fps))[root]
    fps, root = fps[size > 1], root[size > 1]
    if not len(fps):
        return fps, fps
    root = np.searchsorted(root, root, "left")
    trees, label = BKTrees(fps, root), np.arange(len(fps))
    for at in range(0, len(fps), part):
        who, node = trees.within(fps[at : at + part], root[at : at + part], radius)
        label = _least(label, who + at, node)
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def shard_keys(masks: list[int]):
    """One key for each table: the table and the bits of ``fp`` under its mask."""
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m)
    return F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(signed(m))) for t, m in enumerate(masks)])


#: Large shards that may be broadcast: a few MB.
MANY = 1 << 17


def in_shards(members: DataFrame, solve: Callable[[pa.Table], pa.Table], out: str, tile: int) -> DataFrame:
    """``solve`` applied to tables of whole shards; ``members`` has a column ``shard``.

    Shards are counted first, with a combine before the shuffle. One of more
    than ``tile`` members is cut into tiles of half that size before any member
    moves, and every two tiles meet in a shard of their own, in whichever task
    that falls to. So no task ever holds more of one shard than a tile.
    """
    own = [f.name for f in members.schema if f.name != "shard"]
    large = settle(members.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile))
    many = large.count()
    if many:
        tiles = F.ceil(F.col("n") / (tile / 2)).cast("int")
        mine = F.pmod(F.xxhash64(*own), tiles).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), tiles - 1), lambda o: F.xxhash64("shard", F.least(mine, o),
            F.greatest(mine, o)))
        met = members.join(F.broadcast(large) if many <= MANY else large, "shard", "left")
        members = met.select(*own, F.explode(F.when(F.col("n").isNull(), F.array("shard")).otherwise(pairs))
            .alias("shard"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole shards, many small ones at once; a shard's members adjoin."""
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= 4 * tile:
                t = pa.Table.from_batches(held)
                shard = t["shard"].to_numpy()
                cut = int(np.flatnonzero(np.diff(shard, prepend=shard[:1]))[-1]) if (shard != shard[0]).any() else 0
                if cut:
                    yield from done(t.slice(0, cut))
                held, n = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
        if n:
            yield from done(pa.Table.from_batches(held))

    def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
        shard = t["shard"].to_numpy()
        place = np.cumsum(np.diff(shard, prepend=shard[:1]) != 0)
        t = t.filter(pa.array(np.bincount(place)[place] > 1))
        if t.num_rows:
            yield from solve(t).combine_chunks().to_batches()

    return members.repartition("shard").sortWithinPartitions("shard").mapInArrow(work, out)


def link_fingerprints(fps: DataFrame, radius: int = 4, blocks: int = 6, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect what chains of ``radius`` bits or less connect.

    ``fps`` has one column ``fp`` of distinct fingerprints. Links within a
    shard are given as a spanning forest, never as all pairs.
    """

    def solve(t: pa.Table) -> pa.Table:
        a, b = shard_links(t["shard"].to_numpy(), t["fp"].to_numpy().view(np.uint64), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    members = fps.select(F.explode(shard_keys(block_masks(radius, blocks))).alias("shard"), "fp")
    return in_shards(members, solve, "a bigint, b bigint", tile)


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, blocks: int = 6, id_col: str = "doc_id",
    text_col: str = "text") -> DataFrame:
    """(id, fp, component): the least id reachable by links from each document.

    Null or blank texts have fingerprint zero and link like any other. A null
    id stays null and is never a component's name unless all its ids are null.
    Repeated rows are returned as often as they came; an empty table gives an
    empty table.
    """
    rows = settle(with_fingerprints(docs, id_col, text_col, width))
    firsts = settle(rows.groupBy("fp").agg(F.min("id").alias("id")))
    classes = connected_components(link_fingerprints(firsts.select("fp"), radius, blocks))
    named = firsts.join(classes, firsts["fp"] == classes["id"], "left").select(
        firsts["fp"], firsts["id"], F.coalesce("component", firsts["fp"]).alias("class")
    )
    least = named.groupBy("class").agg(F.min("id").alias("component"))
    by_fp = named.join(least, "class").select("fp", "component")
    return rows.join(by_fp, "fp").select("id", "fp", "component")


#: Shingles, with a fixed charge for each text, that a task holds of one cluster.
MOST = 1 << 21
#: Parts of the hash range that give a text its further shards, and how many of these must be rare to do.
PARTS, ENOUGH = 32, 16
#: Bins of a sketch; a bin holds one byte of its least shingle hash, 0 if empty.
BINS = 128


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Distinct hashes of the word shingles of a whole text, A-Z lower-cased."""
    words = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_UPPER))
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + width])) for i in range(n)), np.uint64, n))


def sketch(hashes: np.ndarray) -> bytes:
    """One-permutation minwise sketch: shingles fall into bins, the least of each bin counts."""
    out = np.zeros(BINS, np.uint8)
    at = (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)  # in order, as the hashes are
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[first]] = hashes[first] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def spanning_forest(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Places of the edges of a maximum spanning forest, by Boruvka's rounds.

    Cut at any weight it connects the same nodes as all the edges cut there.
    """
    order = np.argsort(-w, kind="stable")
    x, y, label, chosen = a[order], b[order], np.arange(n), []
    live = np.arange(len(x))
    while len(live):
        best = np.full(n, len(x))
        np.minimum.at(best, label[x[live]], live)
        np.minimum.at(best, label[y[live]], live)
        pick = np.unique(best[best < len(x)])
        chosen.append(pick)
        label = _least(label, x[pick], y[pick])
        live = live[label[x[live]] != label[y[live]]]
    return order[np.unique(np.concatenate(chosen))] if chosen else order


def likely_pairs(group: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, similarity: float, least: float,
    label: np.ndarray, part: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, estimate) in slices: the pairs of one group that may be ``similarity``
    alike by their numbers of shingles, which is exact, and whose sketches look
    alike to ``least`` or more. Rows are in order of group, then of size. Pairs
    that ``label`` connects already are left out; the caller may join its classes.
    """
    place = np.cumsum(np.diff(group, prepend=group[:1]) != 0) << 32
    lo = np.searchsorted(place + sizes, place + np.ceil(similarity * sizes - 1e-6).astype(np.int64), "left")
    n = np.arange(len(group)) - lo
    total = np.concatenate(([0], np.cumsum(n)))
    words = sketches.view(np.uint64).reshape(len(sketches), -1)
    at = 0
    while at < len(group):
        to = max(at + 1, int(np.searchsorted(total, total[at] + part, "right")) - 1)
        k = n[at:to]
        a = np.repeat(np.arange(at, to), k)
        b = np.repeat(lo[at:to] - np.cumsum(k) + k, k) + np.arange(k.sum())
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        p, q = words[a].view(np.uint8), words[b].view(np.uint8)
        same, none = (np.bitwise_count(np.packbits(x, axis=1).view(np.uint64)).sum(1, dtype=np.int64)
            for x in (p == q, (p | q) == 0))
        like = (same - none) / np.maximum(BINS - none, 1)
        ok = like >= least
        yield a[ok], b[ok], like[ok]
        at = to


def likely_classes(group: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, similarity: float,
    least: float, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(place, place of its class) of what likely pairs of one group connect; rows of one group adjoin.

    Rows of one ``known`` class are connected already: they aren't held against
    each other, and only links beyond their class are given.
    """
    place = np.cumsum(np.diff(group, prepend=group[:1]) != 0)
    order = np.lexsort((sizes, place))
    start = np.arange(len(group))
    if known is not None and len(group):
        names, name = np.unique(known[order], return_inverse=True)
        _, first, which = np.unique(place[order] * len(names) + name, return_index=True, return_inverse=True)
        start = first[which]
    label = start.copy()
    for a, b, _ in likely_pairs(group[order], sizes[order], sketches[order], similarity, least, label):
        label[:] = _least(label, a, b)
    moved = label != start
    return order[moved], order[label[moved]]


def similar_classes(group: np.ndarray, sets: list[np.ndarray], sketches: np.ndarray, similarity: float, least: float,
    block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """(place, place of its class) of what likely pairs of exact similarity connect.

    Every likely pair is held against the exact similarity, the likeliest
    first, unless confirmed pairs connect its ends already.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.lexsort((sizes, np.cumsum(np.diff(group, prepend=group[:1]) != 0)))
    sets, label = [sets[i] for i in order], np.arange(len(group))

    def alike(x: int, y: int) -> bool:
        both = np.concatenate((sets[x], sets[y]))
        both.sort()
        common = np.count_nonzero(both[1:] == both[:-1])
        return common >= similarity * (len(both) - common)

    for a, b, like in likely_pairs(group[order], sizes[order], sketches[order], similarity, least, label):
        best = np.argsort(-like, kind="stable")
        a, b = a[best], b[best]
        while len(a):
            up, linked = {}, []
            x, y = a[:block], b[:block]
            for i, j, p, q in zip(x.tolist(), y.tolist(), label[x].tolist(), label[y].tolist(), strict=True):
                while p in up:
                    p = up[p]
                while q in up:
                    q = up[q]
                if p != q and alike(i, j):
                    up[max(p, q)] = min(p, q)
                    linked.append((i, j))
            if linked:
                label[:] = _least(label, *np.array(linked).T)
            a, b = a[block:], b[block:]
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
    moved = label != np.arange(len(group))
    return order[moved], order[label[moved]]


def shard_shingles(hashes: np.ndarray) -> np.ndarray:
    """The least shingle hash of each eighth of the hash range; ``hashes`` are in order."""
    eighth = hashes >> np.uint64(61)
    return hashes[np.flatnonzero(np.diff(eighth.astype(np.int64), prepend=-1))]


def more_shingles(hashes: np.ndarray) -> np.ndarray:
    """The least shingle hash of each of ``PARTS`` parts of the hash range; those of ``shard_shingles`` are among them."""
    part = hashes >> np.uint64(64 - PARTS.bit_length() + 1)
    return hashes[np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))]


def shard_members(distinct: DataFrame, tile: int) -> DataFrame:
    """(shard, id, size, sketch): the texts of each shard; ``distinct`` has ``shards`` and ``more`` of each text.

    Other columns of ``distinct`` go along.

    A shingle that many texts share, of a passage that they all quote, would
    bring them all together. So a text with a shard of more than ``tile`` texts
    goes instead to the shards of all its ``more`` shingles that aren't such,
    if these are ``ENOUGH``: what two similar texts share beyond the passage is
    then at least 0.6 of it, and all of 16 shards miss it with a chance of 4 in
    ten million. A text that is mostly such passages stays in its large shards.
    """
    own = [c for c in distinct.columns if c not in ("shards", "more")]
    members = distinct.select(F.explode("shards").alias("shard"), *own)
    count = lambda df: df.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).select("shard")
    hot = settle(count(members))
    if hot.isEmpty():
        return members
    some = lambda df: F.broadcast(df) if df.count() <= MANY else df
    quoting = settle(members.select("shard", "id").join(some(hot), "shard", "left_semi").select("id").distinct())
    apart = settle(distinct.join(quoting, "id", "left_semi").select(F.explode("more").alias("shard"), *own))
    hotter = settle(count(apart).union(hot).distinct())
    cold = apart.join(some(hotter), "shard", "left_anti")
    able = settle(cold.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= ENOUGH).select("id"))
    return members.join(able, "id", "left_anti").unionByName(cold.join(able, "id", "left_semi"))


def fingerprint_classes(distinct: DataFrame, radius: int = 4, blocks: int = 6, tile: int = TILE) -> DataFrame:
    """``distinct`` with ``class``: what chains of fingerprints ``fp`` within the radius connect, found through BK-trees."""
    links = link_fingerprints(distinct.select("fp").distinct(), radius, blocks, tile)
    classes = connected_components(links).select(F.col("id").alias("fp"), "component")
    return distinct.join(classes, "fp", "left").withColumn("class", F.coalesce("component", "fp")).drop("fp", "component")


def similar_texts(docs: DataFrame, width: int = 5, similarity: float = 0.8, slack: float = 0.3, tile: int = TILE,
    most: int = MOST, text_col: str = "text", radius: int = 4) -> DataFrame:
    """(id, component): MD5 of each distinct text that is similar to another, by groups.

    SimHash fingerprints of the ``width``-word shingles, each counted once, are
    linked within ``radius`` bits through the BK-trees of ``link_fingerprints``;
    every class of these links is held against the exact similarity below. What
    no radius can link is searched between the classes: a SimHash of shingles
    moves by ten bits and more at a Jaccard similarity of 0.8. A text's shards are the
    least shingles of eight parts of the hash range, of which two texts share
    each with a chance of about their similarity (all eight fail at 0.8 with a
    chance of 3 in a million). Texts that quote a common passage meet by their
    other shingles (``shard_members``). In a shard all pairs whose sizes allow the
    similarity are held against each other by sketches of their
    ``width``-word shingles; ``slack`` is over eight standard errors of such
    an estimate. What such likely pairs connect is a cluster, and every text
    goes to its cluster with all its shingles: there each likely pair, of one
    shard or not, is held against the exact similarity unless confirmed pairs
    connect its texts already. Clusters of more than ``most`` shingles are cut
    into tiles before any is moved, and every two tiles meet in a task.
    Texts without a word are similar to nothing but equal texts.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    bodies = docs.select(F.md5(text).alias("id"), text.alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            sets = [shingle_hashes(t, width) for t in texts]
            some = [i for i, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(some, pa.int64())), pa.array([len(sets[i]) for i in some], pa.int64()),
                        pa.array([sketch(sets[i]) for i in some], pa.binary()),
                    pa.array(np.array([majority(sets[i]) for i in some], np.uint64).view(np.int64)),
                    *[pa.array([f(sets[i]).view(np.int64) for i in some], pa.list_(pa.int64())) for f in (shard_shingles,
                        more_shingles)],
                ],
                ["id", "size", "sketch", "fp", "shards", "more"],
            )

    seen = bodies.mapInArrow(features, "id string, size bigint, sketch binary, fp bigint, shards array<bigint>, "
        "more array<bigint>")
    distinct = settle(seen.groupBy("id").agg(*[F.first(c).alias(c) for c in ("size", "sketch", "fp", "shards", "more")]))
    classes = settle(fingerprint_classes(distinct.select("id", "fp"), radius, tile=tile))
    least = classes.groupBy("class").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    alike = classes.join(least, "class").where("id <> b").select(F.col("id").alias("a"), "b")
    members = shard_members(distinct.drop("fp").join(classes, "id"), tile)

    def near(t: pa.Table) -> pa.Table:
        sketches = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
        a, b = likely_classes(t["shard"].to_numpy(), t["size"].to_numpy(), sketches, similarity, similarity - slack,
            t["class"].to_numpy())
        ids = t["id"].combine_chunks()
        return pa.table({"a": ids.take(pa.array(a)), "b": ids.take(pa.array(b))})

    clusters = connected_components(alike.unionByName(in_shards(members, near, "a string, b string", tile))).withColumnRenamed(
        "component", "cluster")
    size = F.col("size") + BINS * 2
    weights = clusters.join(distinct.select("id", "size"), "id").groupBy("cluster").agg(F.ceil(F.sum(size) / most)
        .cast("int").alias("tiles"))
    tiles = F.when(F.col("tiles") > 1, F.col("tiles") * 2).otherwise(1)
    mine = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda o: F.xxhash64("cluster", F.least(F.col("mine"), o), F.greatest(F.col("mine"), o)),
    )
    met = settle(clusters.join(weights.withColumn("tiles", tiles), "cluster").withColumn("mine", mine)
        .select("id", pairs.alias("groups")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [shingle_hashes(t.as_py(), width) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([h.tobytes() for h in made], pa.binary())],
                ["id", "hashes"])

    exact = bodies.join(met.select("id"), "id", "left_semi").mapInArrow(sets, "id string, hashes binary")
    exact = exact.groupBy("id").agg(F.first("hashes").alias("hashes")).join(met, "id")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups adjoin; only whole ones are solved, many small ones at once."""
        groups, ids, held, size = [], [], [], 0
        for batch in batches:
            for group, name, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                strict=True):
                if size > most and group != groups[-1]:
                    yield from done(groups, ids, held)
                    groups, ids, held, size = [], [], [], 0
                groups.append(group)
                ids.append(name)
                held.append(np.frombuffer(h.as_py(), np.uint64))
                size += len(held[-1])
        if ids:
            yield from done(groups, ids, held)

    def done(groups: list[int], ids: list[str], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sketches = np.frombuffer(b"".join(map(sketch, held)), np.uint8).reshape(-1, BINS)
        a, b = similar_classes(np.array(groups, np.int64), held, sketches, similarity, similarity - slack)
        if len(a):
            names = pa.array(ids, pa.string())
            yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b))], ["a", "b"])

    dealt = exact.select(F.explode("groups").alias("group"), "id",
        "hashes").repartition("group").sortWithinPartitions("group")
    return connected_components(dealt.mapInArrow(hold, "a string, b string"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group of equal or
    similar texts the row with the least id stays (of equal ids, the text with
    the least MD5; of rows equal in both, one). ``how`` goes to ``similar_texts``.
    """
    groups = similar_texts(docs, text_col=text_col, **how).select(F.col("id").alias("body"), "component")
    given = F.col(id_col)
    key = [given.isNull().alias("none"), F.coalesce(given.cast("string"), F.lit("")).alias("name"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("body")]
    ids = docs.select(given.alias("id"), *key).join(groups, "body", "left").withColumn("group",
        F.coalesce("component", "body"))
    best = ids.groupBy("group").agg(F.min(F.struct("none", "id", "body", "name")).alias("b")).select("b.none", "b.name",
        "b.body")
    # ids spread copies of one text over the tasks; texts move once
    names = ["none", "name", "body"]
    kept = docs.select(whole_row(docs).alias("doc"), *key).join(best, names)
    return kept.dropDuplicates(names).select("doc.*")
