"""What the operators on embeddings share: valid rows, classes of equal vectors, blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of a block; a block of 64 floats each is 128 KB.
BLOCK = 512


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """((id, v) of rows that take part, their dimension).

    Left out: null ids, null or empty vectors, vectors with a null or
    non-finite component, zero vectors, and vectors whose length isn't the most
    frequent one (of equally frequent lengths the smallest).
    """
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = df.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad
        & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).alias("id"), v.alias("v")
    )
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dim = sizes["d"] if sizes else 0
    return good.where(F.size("v") == dim), dim


def classes(vectors: DataFrame) -> DataFrame:
    """(id, n, v): each distinct vector once, by its least id, with its number of rows."""
    return vectors.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).select("id", "n", "v")


def matrix(column) -> np.ndarray:
    """Rows of a column of arrays, in double precision."""
    return np.stack([np.asarray(x, np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def stored_as(df: DataFrame, vec_col: str) -> str:
    """How blocks store components: floats as they came, all else as doubles."""
    return "f4" if df.schema[vec_col].dataType.simpleString() == "array<float>" else "f8"


def pack(keys: np.ndarray, ids: np.ndarray, n: np.ndarray, rows: np.ndarray, kind: str, store: str) -> pd.DataFrame:
    """A row for each key and block of its vectors: ids, counts and vectors as bytes."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    out = []
    if len(keys):
        cuts = np.append(np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)), len(keys))
        for a, b in zip(cuts, cuts[1:], strict=False):
            for c in range(a, b, BLOCK):
                i = order[c : min(b, c + BLOCK)]
                out.append((int(keys[c]), kind, ids[i].astype(np.int64).tobytes(), n[i].astype(np.int64).tobytes(),
                    rows[i].astype(store).tobytes()))
    return pd.DataFrame(out, columns=["key", "kind", "ids", "ns", "vs"])


BLOCKS = "key bigint, kind string, ids binary, ns binary, vs binary"


def unpack(ids: bytes, ns: bytes, vs: bytes, store: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(ns, np.int64), np.frombuffer(vs, store).astype(np.float64).reshape(len(i), -1)


def gathered(batches: Iterator[pd.DataFrame], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """The same rows in larger batches, so that blocks fill up."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= rows:
            yield pd.concat(held)
            held, n = [], 0
    if n:
        yield pd.concat(held)


def meet(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every two blocks of one key, side by side: (ids, ns, vs, ids2, ns2, vs2)."""
    r = right.select("key", F.col("ids").alias("ids2"), F.col("ns").alias("ns2"), F.col("vs").alias("vs2"))
    return left.select("key", "ids", "ns", "vs").join(r, "key").drop("key")
