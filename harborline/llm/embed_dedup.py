"""Embedding near-dedup: spherical k-means cells, blocked cosine products.

Each vector has a home cell, and is also listed in every other cell whose
border is near enough for a linked vector to lie behind it. A vector is
compared with all that its home cell lists, block by block; a block gives the
number of links of each vector and a spanning forest of them, never the pairs.
A pair across a border is found from both sides or from one; the side that
alone finds it counts it for both. Equal vectors are compared once, as a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import fill_blocks
from .common import settle
from .components import connected_components
from .simhash import _least
from .vectors import BLOCKS, classes, gathered, matrix, meet, pack, stored_as, unpack, valid_vectors


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one."""
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit rows; an empty cell is seeded anew from the row least well placed."""
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        s = x @ c.T
        home = s.argmax(1)
        new = np.zeros_like(c)
        np.add.at(new, home, x)
        length = np.linalg.norm(new, axis=1)
        far = iter(np.argsort(s.max(1)))
        for i in np.flatnonzero(length < 1e-9):
            new[i], length[i] = x[next(far)], 1.0
        c = new / length[:, None]
    return c


def behind(u: np.ndarray, cells: np.ndarray, home: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """How much nearer each unit row is to its home than to another cell; the same in whichever batch a row is."""
    return (u * cells[home]).sum(1) - (u * cells[cell]).sum(1)


def gaps(cells: np.ndarray, home: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Distances between pairs of centroids."""
    return np.sqrt(np.maximum(2 - 2 * (cells[home] * cells[cell]).sum(1), 1e-18))


#: Cells at most, and vectors of the sample for each; up to this many are fitted at once, more in two levels.
MOST_CELLS, EACH, FLAT = 65_536, 8, 1024
#: Products of vectors and centroids, and listings of vectors, that a task holds at once.
PRODUCTS, LISTED = 1 << 21, 1 << 15


def listings(u: np.ndarray, cells: np.ndarray, margin: float, most: int = LISTED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, cell) of each cell that a unit row is listed in, in slices of whole rows, of ``most`` unless a row has more.

    A row may be near the borders of many cells, the more the more cells there
    are, so a batch of rows says nothing of how much is listed.
    """
    s = u @ cells.T
    home = s.argmax(1)
    close = s.max(1)[:, None] - s <= margin * np.sqrt(np.maximum(2 - 2 * cells[home] @ cells.T, 0)) + 1e-6
    total = np.concatenate(([0], np.cumsum(close.sum(1))))
    at = 0
    while at < len(u):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        i, cell = np.nonzero(close[at:to])
        i += at
        near = (cell == home[i]) | (behind(u[i], cells, home[i], cell) <= margin * gaps(cells, home[i], cell))
        yield i[near], cell[near]
        at = to


def fit_cells(x: np.ndarray, k: int) -> np.ndarray:
    """About ``k`` unit centroids of unit rows; many are fitted within coarse cells, in proportion to their rows."""
    if k <= FLAT:
        return spherical_kmeans(x, k)
    coarse = spherical_kmeans(x, round(k**0.5))
    home = np.concatenate([(x[i : i + 4096] @ coarse.T).argmax(1) for i in range(0, len(x), 4096)])
    own = [x[home == i] for i in range(len(coarse))]
    return np.concatenate([spherical_kmeans(rows, max(1, round(k * len(rows) / len(x)))) for rows in own if len(rows)])


#: Bits of a block's counts that hold the number of equal rows; the home cell lies above them.
_ROWS = 40


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, cell_rows: int = 2048, sample: int = 20_000,
    margin: float = 0.16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component) for each row of ``vectors``.

    There is a cell for ``cell_rows`` rows, up to ``MOST_CELLS``; centroids are
    fitted on ``sample`` vectors, or ``EACH`` for each cell if that is more
    (524,288 at most). All vectors are assigned. A vector is listed in a cell if it lies no
    further than ``margin`` behind the border to it. Two vectors of cosine c
    are sqrt(2 - 2 c) apart, and so is what their places along the line between
    two centroids differ by at most. With homes on either side of a border,
    one of the two is no further from it than half of that: at ``threshold``
    0.95, 0.1582. So a ``margin`` of 0.16 finds every pair, from one side at
    least; a smaller threshold needs a larger margin. Rows that take no part (see ``valid_vectors``) have no links
    and are their own component. Repeated rows are returned as often as they came;
    an id that several different vectors carry is one node with the links of
    all of them. An empty table gives an empty table.
    """
    if margin < np.sqrt(max(0.0, 2 - 2 * threshold)) / 2:
        raise ValueError("pairs across a border could be missed: margin is under half their distance")
    sc = vectors.sparkSession.sparkContext
    store = stored_as(vectors, vec_col)
    good, dim = valid_vectors(vectors, id_col, vec_col)
    distinct = settle(classes(good))
    n = distinct.count()
    k = max(1, min(MOST_CELLS, n // cell_rows))
    picked = distinct.orderBy(F.xxhash64("id"), "id").limit(max(sample, EACH * k)).select("v").toPandas()["v"]
    cells = fit_cells(unit(matrix(picked)), k) if n else np.zeros((1, max(dim, 1)))
    shared = sc.broadcast(cells)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for b in gathered(batches, max(64, min(8_192, PRODUCTS // len(c)))):  # a row is listed several times
            rows = matrix(b["v"])
            u = unit(rows)
            home = (u @ c.T).argmax(1)
            ids, ns = b["id"].to_numpy(np.int64), b["n"].to_numpy(np.int64) + (home << _ROWS)
            yield pack(home, ids, ns, rows, "home", store)
            for i, cell in listings(u, c, margin):
                yield pack(cell, ids[i], ns[i], rows[i], "listed", store)

    blocks = settle(distinct.mapInPandas(assign, BLOCKS))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for b in batches:
            for row in b.itertuples(index=False):
                ai, an, av = unpack(row.ids, row.ns, row.vs, store)
                bi, bn, bv = unpack(row.ids2, row.ns2, row.vs2, store)
                au, bu = unit(av), unit(bv)
                product = au @ bu.T
                hit = product >= threshold
                edge = np.nonzero(np.abs(product - threshold) < 1e-12)
                hit[edge] = (au[edge[0]] * bu[edge[1]]).sum(1) >= threshold  # the same from either side
                hit &= ai[:, None] != bi
                i, j = np.nonzero(hit)
                if len(i):
                    here, there = an >> _ROWS, bn >> _ROWS
                    unseen = np.zeros(hit.shape, bool)  # from the other side
                    for cell in np.unique(there[hit.any(0)]):
                        other = np.full(len(ai), cell)
                        far = (here != cell) & (behind(au, c, here, other) > margin * gaps(c, here, other))
                        unseen[:, there == cell] = far[:, None]
                    alone = unseen[i, j]
                    own = np.bincount(i, bn[j] & (1 << _ROWS) - 1, len(ai)).astype(np.int64)
                    other = np.bincount(j[alone], an[i[alone]] & (1 << _ROWS) - 1, len(bi)).astype(np.int64)
                    ids, place = np.unique(np.concatenate([ai[i], bi[j]]), return_inverse=True)
                    label = _least(np.arange(len(ids)), place[: len(i)], place[len(i) :])
                    moved = label != np.arange(len(ids))
                    yield pd.DataFrame({"a": ai[own > 0], "b": -1, "n": own[own > 0]})
                    yield pd.DataFrame({"a": bi[other > 0], "b": -1, "n": other[other > 0]})
                    yield pd.DataFrame({"a": ids[moved], "b": ids[label[moved]], "n": 0})

    homes = fill_blocks(blocks.where("kind = 'home'"))  # each listed block travels once for each of these
    found = settle(
        meet(homes, blocks.where("kind = 'listed'"))
            .mapInPandas(compare, "a bigint, b bigint, n bigint")
    )
    links = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "id")
    groups = connected_components(found.where("n = 0"))
    by_class = (
        distinct.join(links, "id", "left")
        .join(groups, "id", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"))
    )
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    none = F.coalesce("n_links", F.lit(0).cast("long"))
    return rows.join(by_class, "v", "left").select("id", none.alias("n_links"),
        F.coalesce("component", "id").alias("component"))
