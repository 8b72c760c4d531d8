"""Approximate nearest neighbours by cross-polytope hashing.

A vector, scaled to unit length, is turned by three rounds of random signs and
a fast Hadamard transform; the nearest signed axis is its hash. A bucket is one
such hash, or two or more of different turns if asked for. Each of several tables turns differently. A
query probes the buckets whose axes it is nearest to; what they hold is
reranked exactly, block against block, and a task keeps only the best of each
query over all blocks that it sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle
from .vectors import BLOCK, BLOCKS, classes, gathered, matrix, meet, pack, stored_as, unpack, valid_vectors


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


def axes(rows: np.ndarray, table: int, seed: int = 11) -> np.ndarray:
    """Products of each unit row with the signed axes of a table's turn, (rows, 2d)."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    y = np.zeros((len(rows), width))
    y[:, : rows.shape[1]] = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, width))
    for s in signs:
        y = hadamard(y * s)
    return np.concatenate([y, -y], 1)


#: Rows of a bucket, on average, beyond which buckets take one turn more.
FULL = 4096
#: Buckets probed in each table of one turn; the same for every number of rows, of which more only raise the recall.
PROBES = 10
#: Pairs (query, row) after which a task keeps the best of each query only.
HELD = 1 << 20
#: Places that blocks of one bucket are put together in, so that no task has all of a hot one.
SPREAD = 4


def plan(n: int, slots: int) -> tuple[int, int]:
    """(turns of a bucket, buckets probed in each table) that suit ``n`` rows, for callers that ask; ``nearest`` doesn't.

    The more rows, the nearer the neighbours and the fewer buckets suffice. The
    figures hold 0.9 of the true neighbours even where vectors are noise in 64
    dimensions; see the README for what was measured.
    """
    turns = 1
    while n > FULL * slots**turns:
        turns += 1
    if turns == 1:
        return 1, max(3, min(10, round(14.4 - 2 * np.log10(max(n, 10)))))
    return turns, 128


def best_buckets(near: list[np.ndarray], many: int) -> np.ndarray:
    """The ``many`` buckets of greatest summed products, best first; one array of products for each turn.

    Only the best of the turns so far need be carried on: the best sums are among theirs.
    """
    total, bucket = np.zeros((len(near[0]), 1)), np.zeros((len(near[0]), 1), np.int64)
    for each in near:
        slots = each.shape[1]
        sums = (total[:, :, None] + each[:, None, :]).reshape(len(each), -1)
        best = np.argsort(-sums, axis=1, kind="stable")[:, :many]
        total = np.take_along_axis(sums, best, 1)
        bucket = np.take_along_axis(bucket, best // slots, 1) * slots + best % slots
    return bucket


def best_of_each(found: list[pd.DataFrame], wanted: int) -> pd.DataFrame:
    """The ``wanted`` best rows of each query, each class once."""
    f = pd.concat(found)
    q, c, s = (f[x].to_numpy() for x in ("query_id", "class", "score"))
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, s = q[new], c[new], s[new]
    top = np.arange(len(q)) - np.searchsorted(q, q, "left") < wanted
    return pd.DataFrame({"query_id": q[top], "class": c[top], "score": s[top]})


def fill_blocks(blocks: DataFrame) -> DataFrame:
    """The same blocks with those of one bucket put together up to the size of a block."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of one key adjoin; what is held may go on in the next batch."""
        key, parts, size, out = None, [], 0, []

        def put() -> None:
            if parts:
                out.append((key, parts[0].kind, *(b"".join(getattr(p, c) for p in parts) for c in ("ids", "ns", "vs"))))

        for b in batches:
            for row in b.itertuples(index=False):
                n = len(row.ids) // 8
                if row.key != key or size + n > BLOCK:
                    put()
                    key, parts, size = row.key, [], 0
                parts.append(row)
                size += n
            if len(out) >= 64:
                yield pd.DataFrame(out, columns=["key", "kind", "ids", "ns", "vs"])
                out.clear()
        put()
        yield pd.DataFrame(out, columns=["key", "kind", "ids", "ns", "vs"])

    salt = F.pmod(F.xxhash64("ids"), F.lit(SPREAD))
    return blocks.repartition("key", salt).sortWithinPartitions("key").mapInPandas(merge, BLOCKS)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, tables: int = 12, probes: int = PROBES,
    turns: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row.

    ``queries`` is a condition on the columns of ``vectors``. Nearness is the
    inner product in double precision, ties to the smaller id; a query's own
    row is no candidate, rows equal to it are. Every row is indexed; equal
    vectors are indexed once and expanded at the end. A query that finds fewer
    than ``k`` probes every bucket of one table, which is an exact search. Rows
    that take no part (see ``valid_vectors``) are neither queries nor
    candidates. Rows that share an id count as one vector each, and none is a
    candidate for a query of that id. ``turns`` and ``probes`` don't depend on
    the number of rows. An empty table gives an empty table.
    """
    store = stored_as(vectors, vec_col)
    good, dim = valid_vectors(vectors, id_col, vec_col)
    asked, _ = valid_vectors(vectors.where(queries), id_col, vec_col)
    asked = asked.where(F.size("v") == dim)
    distinct = settle(classes(good))
    slots = 2 << max(0, dim - 1).bit_length() if dim else 2
    buckets = slots**turns

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in gathered(batches):
            rows, ids, ns = matrix(b["v"]), b["id"].to_numpy(np.int64), b["n"].to_numpy(np.int64)
            for t in range(tables):
                key = np.zeros(len(rows), np.int64)
                for i in range(turns):
                    key = key * slots + axes(rows, t * turns + i).argmax(1)
                yield pack(key + t * buckets, ids, ns, rows, "row", store)

    def probing(many: int, within: int):
        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in gathered(batches, 256 if turns > 1 else 4096):
                rows, ids = matrix(b["v"]), b["id"].to_numpy(np.int64)
                for t in range(within):
                    key = best_buckets([axes(rows, t * turns + i) for i in range(turns)], many) + t * buckets
                    i = np.repeat(np.arange(len(ids)), key.shape[1])
                    yield pack(key.reshape(-1), ids[i], np.zeros(len(i)), rows[i], "query", store)

        return probe

    wanted = k + 1  # a query's own class is among them

    def rerank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The best of each query over all blocks of the task; where too many queries meet, in parts."""
        found, held = [], 0
        for b in batches:
            for row in b.itertuples(index=False):
                qi, _, q = unpack(row.ids, row.ns, row.vs, store)
                ci, _, c = unpack(row.ids2, row.ns2, row.vs2, store)
                near = q @ c.T
                if len(ci) > wanted:  # what rounding may have put out of order stays in
                    least = np.partition(near, -wanted, axis=1)[:, -wanted]
                    scale = np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1).max()
                    i, j = np.nonzero(near >= (least - 1e-12 * scale)[:, None])
                else:
                    i, j = np.nonzero(np.ones_like(near, bool))
                found.append(pd.DataFrame({"query_id": qi[i], "class": ci[j], "score": (q[i] * c[j]).sum(1)}))
                held += len(i)
                if held > HELD:
                    best = best_of_each(found, wanted)
                    found, held = [best], len(best)
                    if held > HELD // 2:
                        yield best
                        found, held = [], 0
        if found:
            yield best_of_each(found, wanted)

    rows = settle(fill_blocks(distinct.mapInPandas(index, BLOCKS)))
    out = "query_id bigint, class bigint, score double"

    def search(some: DataFrame, many: int, within: int) -> DataFrame:
        probes_ = fill_blocks(some.mapInPandas(probing(many, within), BLOCKS))
        found = meet(probes_, rows).mapInPandas(rerank, out)
        found = found.groupBy("query_id", "class").agg(F.max("score").alias("score"))
        best = W.partitionBy("query_id").orderBy(F.desc("score"), "class")
        return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= wanted).drop("r")

    # equal vectors: only the least k + 1 ids can be among the k nearest
    within_class = W.partitionBy("class").orderBy("id")
    members = (
        good.join(distinct.select("v", F.col("id").alias("class")), "v")
        .select("class", "id")
        .withColumn("r", F.row_number().over(within_class))
        .where(F.col("r") <= wanted)
        .drop("r")
    )
    by_rank = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def expand(found: DataFrame) -> DataFrame:
        return (
            found.join(members, "class")
            .where(F.col("id") != F.col("query_id"))
            .select("query_id", F.col("id").alias("vec_id"), "score")
            .withColumn("rank", F.row_number().over(by_rank))
            .where(F.col("rank") <= k)
        )

    first = settle(expand(search(asked, probes, tables)))
    enough = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = settle(asked.join(enough, asked["id"] == enough["query_id"], "left_anti"))
    again = expand(search(short, buckets, 1))
    done = first.join(enough.select("query_id"), "query_id", "left_semi").unionByName(again)
    return done.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
