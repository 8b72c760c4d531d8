"""Whitening of embeddings by the principal components of their covariance, made tile by tile.

Entries become whole numbers, ``floor(scale * c) + shift``, so that sums don't
depend on the order of rows. ``covariance`` cuts the dimensions into column
blocks of ``tile`` columns and the rows into row blocks. Every pair of column
blocks is the key of a tile; the column blocks are shuffled by row block, where
each two of them meet, are multiplied and added to their tile's sum in the
task. What tasks emit is summed by tile and entry before and after a shuffle,
so that the driver gets one square matrix, which ``MAX_DIM`` bounds, and never
a row. Rows are centred, at the whole number next to the mean, before they are
multiplied; the rest of the mean, at most one half, is taken off at the end,
which leaves whole-number products that are exact in double precision.

Left out: null or empty vectors, vectors with a null or non-finite entry or one
so large that no exact whole number comes of it (2^52 or more), and vectors
whose length isn't the most frequent one (of equally frequent ones the
smallest). Zero vectors take part. Repeated rows and null ids are rows like any
other. An empty table gives an empty frame. A component without variance (there
are some if rows are few or equal) can't be scaled: its ``whitened`` is null
and it isn't part of ``identity_error``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .vectors import matrix

#: The driver holds one matrix of this many dimensions at most: 128 MB.
MAX_DIM = 4096
#: Numbers of a row block at most, in a task.
BLOCK_NUMBERS = 1 << 18
#: From here on doubles don't tell whole numbers apart.
_LARGEST = 1 << 52
#: Of the largest eigenvalue; a smaller one is none.
_NO_VARIANCE = 1e-12


def fixed_point(df: DataFrame, id_col: str, vec_col: str, scale: int = 1024, shift: int = 100_000) -> tuple[DataFrame,
    int]:
    """((id, x: array<double> of whole numbers) of the rows that take part, their dimension)."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) >= _LARGEST))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("double") + shift)
    good = df.where(v.isNotNull() & (F.size(v) > 0) & ~bad).select(F.col(id_col).alias("id"), x.alias("x"))
    often = good.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dim = often["d"] if often else 0
    if dim > MAX_DIM:
        raise ValueError(f"vectors of {dim} entries; whitening takes up to {MAX_DIM}")
    return good.where(F.size("x") == dim), dim


def _summed(parts: DataFrame, *key: str) -> dict[tuple, np.ndarray]:
    """Arrays of one length for each key, added entry by entry in Spark."""
    each = parts.select(*key, F.posexplode("part").alias("pos", "value")).groupBy(*key, "pos").agg(
        F.sum("value").alias("value"))
    got = each.toPandas().sort_values("pos")
    return {k: g["value"].to_numpy() for k, g in got.groupby(list(key))}


def totals(vectors: DataFrame, col: str, dim: int) -> tuple[int, np.ndarray]:
    """Number of vectors and the sum of each dimension: one row comes from a task."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(dim + 1)
        for b in batches:
            if len(b):
                total[0] += len(b)
                total[1:] += matrix(b[col]).sum(0)
        if total[0]:
            yield pd.DataFrame({"one": [1], "part": [total]})

    made = vectors.select(col).mapInPandas(add, "one int, part array<double>")
    total = _summed(made, "one").get((1,), np.zeros(dim + 1))
    return int(total[0]), total[1:]


def covariance(vectors: DataFrame, col: str, dim: int, whole: bool = False, tile: int = 32) -> tuple[int, np.ndarray,
    np.ndarray]:
    """(number, sums, covariance) of an array column; ``whole``: entries are whole numbers, centred by one."""
    n, sums = totals(vectors, col, dim)
    if not n:
        return 0, sums, np.zeros((dim, dim))
    mean = sums / n
    centre = np.round(mean) if whole else mean
    starts = range(0, dim, tile)
    rows = max(1, BLOCK_NUMBERS // dim)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for b in batches:
            for first in range(0, len(b), rows):
                y = matrix(b[col].iloc[first : first + rows]) - centre
                yield pd.DataFrame([(at, i, np.ascontiguousarray(y[:, s : s + tile]).tobytes())
                    for i, s in enumerate(starts)], columns=["row_block", "i", "block"])
                at += 1

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for i, j, left, right in zip(b["i"], b["j"], b["block"], b["other"], strict=True):
                l = np.frombuffer(left).reshape(-1, min(tile, dim - i * tile))
                r = np.frombuffer(right).reshape(-1, min(tile, dim - j * tile))
                tiles[i, j] = tiles.get((i, j), 0) + l.T @ r
        for (i, j), t in tiles.items():
            yield pd.DataFrame({"i": [i], "j": [j], "part": [t.ravel()]})

    left = settle(vectors.select(col).mapInPandas(cut, "row_block bigint, i int, block binary"))
    right = left.select("row_block", F.col("i").alias("j"), F.col("block").alias("other"))
    pairs = left.join(right, "row_block").where("i <= j").select("i", "j", "block", "other")
    out = np.zeros((dim, dim))
    for (i, j), values in _summed(pairs.mapInPandas(multiply, "i int, j int, part array<double>"), "i", "j").items():
        a, b = slice(i * tile, (i + 1) * tile), slice(j * tile, (j + 1) * tile)
        out[a, b] = values.reshape(min(tile, dim - i * tile), -1)
        out[b, a] = out[a, b].T
    rest = mean - centre
    return n, sums, out / n - np.outer(rest, rest)


SCHEMA = "id bigint, squares bigint, cross bigint, whitened array<double>"


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, tile: int = 32,
    scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(id, n, deviation, component, whitened, explained, identity_error), a row for each vector and component.

    ``deviation`` is the sum over dimensions of (n x - S)^2, exact, as
    decimal(38,0). ``whitened`` is x - S / n along the component, over the root
    of its eigenvalue; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest entry of the whitened vectors' covariance
    minus the identity, measured on the rows that are returned.
    """
    good, dim = fixed_point(df, id_col, vec_col, scale, shift)
    k = min(components, dim)
    n, sums, cov = covariance(good, "x", dim, True, tile) if dim else (0, np.zeros(0), np.zeros((0, 0)))
    value, axes = np.linalg.eigh(cov)
    value, axes = value[::-1][:k], axes[:, ::-1][:, :k]
    trace = float(np.trace(cov))
    real = value > _NO_VARIANCE * (value[0] if k else 0)
    by = axes / np.sqrt(np.where(real, value, np.inf))
    centre = np.round(sums / max(n, 1))
    rest = (sums - n * centre).astype(np.int64)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                y = matrix(b["x"]) - centre
                w = (y - rest / n) @ by
                whole = y.astype(np.int64)
                yield pd.DataFrame({"id": b["id"], "squares": (whole * whole).sum(1), "cross": whole @ rest,
                    "whitened": list(w)})

    id_type = good.schema["id"].dataType.simpleString()
    made = settle(good.mapInPandas(project, SCHEMA.replace("bigint", id_type, 1)))
    m = int(real.sum())
    error = None
    if n and m:
        _, _, seen = covariance(made.select(F.slice("whitened", 1, m).alias("w")), "w", m, tile=tile)
        error = float(np.abs(seen - np.eye(m)).max())
    big = lambda c: F.col(c).cast("decimal(38,0)")
    const = F.lit(str(sum(int(r) ** 2 for r in rest))).cast("decimal(38,0)")
    count = F.lit(n).cast("decimal(20,0)")
    deviation = (count * count * big("squares") - count * 2 * big("cross") + const).cast("decimal(38,0)")
    share = F.array(*[F.lit(float(e) / trace if trace else None).cast("double") for e in value]) if k else F.array(
        F.lit(None).cast("double"))
    return made.select("id", F.lit(n).cast("long").alias("n"), deviation.alias("deviation"),
        F.posexplode("whitened").alias("at", "value")).select(
        "id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.when(F.col("at") < m, F.col("value")).alias("whitened"),
        F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
