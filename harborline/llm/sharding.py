"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2 ** RING_BITS`` points. Each shard has ``vnodes`` points of it;
a row starts at the point its id hashes to and goes to the first shard
clockwise that isn't full. A shard takes ``capacity`` rows: its even share, one
apart at most, times 1 + ``slack``. Rows come in the order of a second hash of
their id, so a shard is full at a certain place of that order, and a row's
shard is the first of its clockwise list whose end lies beyond the row's place.
The ends are all that has to be found: counts of rows by arc of the ring and by
interval of the order go to the driver (``2 ** RING_BITS`` x ``BUCKETS`` rows
at most, arcs being no more than virtual nodes), which plays them through;
an interval in which a shard becomes full is counted again in finer intervals,
down to single places. Nothing is sampled or approximated: with the default
slack of 0 the shards' counts differ by one at most.

Rows of one id, a hot id included, start at one point and overflow clockwise
like all others. Equal rows are told apart by the place they were read at. Null
ids hash as an empty one. An empty table gives an empty frame.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle
from .numbering import binned, numbered

RING_BITS = 16
#: Intervals of the order that are counted at once.
BUCKETS = 512
#: Entries of all clockwise lists together, 4 bytes each.
_MOST = 1 << 25


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """(arc of each point of the ring, each arc's list of shards clockwise).

    Virtual node v of shard s lies at the first 16 bits of the MD5 of ``s:v``;
    of several at one point the smaller shard comes first.
    """
    points = sorted((int(hashlib.md5(f"{s}:{v}".encode()).hexdigest()[: RING_BITS // 4], 16), s)
        for s in range(shards) for v in range(vnodes))
    ends = sorted({p for p, _ in points})
    if len(ends) * shards > _MOST:
        raise ValueError(f"{shards} shards of {vnodes} virtual nodes: fewer virtual nodes, please")
    owner = [s for _, s in points]
    first = {p: i for i, (p, _) in reversed(list(enumerate(points)))}
    lists = [list(dict.fromkeys(owner[first[e] :] + owner[: first[e]])) for e in ends]
    arc = np.searchsorted(ends, np.arange(1 << RING_BITS)) % len(ends)
    return arc, np.array(lists, np.int32)


def capacities(rows: int, shards: int, slack: float = 0.0) -> np.ndarray:
    """Rows that each shard may take: an even share, the first shards one more, times 1 + slack."""
    even = np.full(shards, rows // shards, np.int64)
    even[: rows % shards] += 1
    return np.ceil(even * (1 + slack)).astype(np.int64)


def _counts(keys: DataFrame, arcs: int, low: int, width: int, high: int) -> np.ndarray:
    """Rows by arc and interval, of the places from ``low`` to before ``high``."""
    at = F.floor((F.col("rank") - low) / width).cast("int")
    got = keys.where((F.col("rank") >= low) & (F.col("rank") < high)).groupBy("arc", at.alias("at")).agg(
        F.count(F.lit(1)).alias("n")).toArrow()
    out = np.zeros((arcs, -(-(high - low) // width)), np.int64)
    out[got["arc"].to_numpy(), got["at"].to_numpy()] = got["n"].to_numpy()
    return out


def ends(keys: DataFrame, lists: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The place of the order at which each shard becomes full: its last row's, or -1 where it takes none.

    ``keys``: (arc, rank), ranks being all whole numbers from 0 on.
    """
    total = int(keys.agg(F.count(F.lit(1))).first()[0])
    room = room.copy()
    end = np.full(len(room), total, np.int64)
    end[room == 0] = -1
    targets = lambda: lists[np.arange(len(lists)), np.argmax((end == total)[lists], 1)]

    def play(low: int, high: int) -> None:
        width = -(-(high - low) // BUCKETS)
        seen = _counts(keys, len(lists), low, width, high)
        b = 0
        while b < seen.shape[1]:
            load = np.zeros((len(room), seen.shape[1] - b), np.int64)
            np.add.at(load, targets(), seen[:, b:])
            full = (load.cumsum(1) >= room[:, None]) & (end == total)[:, None]
            hit = np.flatnonzero(full.any(0))
            upto = hit[0] if len(hit) else load.shape[1]
            room[:] -= load[:, :upto].sum(1)
            b += upto
            if len(hit):
                if width == 1:
                    s = int(np.flatnonzero(full[:, upto])[0])
                    room[s], end[s] = 0, low + b
                else:
                    play(low + b * width, min(high, low + (b + 1) * width))
                b += 1

    if total:
        play(0, total)
    return end


def place(docs: DataFrame, shards: int, id_col: str = "doc_id", keep: dict[str, Column] | None = None,
    vnodes: int = 128, slack: float = 0.0) -> DataFrame:
    """(id, what ``keep`` names, shard, slot) of every row; slots of a shard are gapless from 0 on."""
    if shards < 1:
        raise ValueError("one shard at least")
    if slack < 0:
        raise ValueError("the shards must have room for all rows")
    spark: SparkSession = docs.sparkSession
    arc, lists = ring(shards, vnodes)
    key = F.md5(F.coalesce(F.col("`" + id_col.replace("`", "``") + "`").cast("string"), F.lit("")).cast("binary"))
    number = lambda start, n: F.conv(F.substring("_key", start, n), 16, 10).cast("long")
    rows = docs.select(F.col("`" + id_col.replace("`", "``") + "`").alias("id"), F.struct(
        *[c.alias(k) for k, c in (keep or {"_": F.lit(None).cast("string")}).items()]).alias("kept"), key.alias("_key"))
    rows = rows.select("id", "kept", number(1, RING_BITS // 4).cast("int").alias("point"),
        number(RING_BITS // 4 + 1, 15).alias("place"))
    points = spark.createDataFrame(pd.DataFrame({"point": np.arange(len(arc)), "arc": arc}), "point int, arc int")
    keyed = rows.join(F.broadcast(points), "point").drop("point")  # the ring: 65,536 rows
    order = ["place", "id", "kept"]
    ranked = numbered(binned(keyed, order), [], order, "rank", "_n").drop("_n", "place")
    keys = settle(ranked.sortWithinPartitions("rank"))  # an interval is then few row groups

    total = keys.agg(F.count(F.lit(1))).first()[0]
    end = ends(keys.select("arc", "rank"), lists, capacities(total, shards, slack))
    around = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(lists)], "arc int, clockwise array<int>")
    last = F.array(*[F.lit(int(e)) for e in end])
    open_ = F.filter("clockwise", lambda s: F.get(last, s) >= F.col("rank"))
    dealt = keys.join(F.broadcast(around), "arc").withColumn("shard", F.get(open_, F.lit(0))).drop("clockwise", "arc")
    out = numbered(settle(dealt), ["shard"], ["rank"], "slot", "_n")
    return out.select("id", *[F.col("kept")[k].alias(k) for k in (keep or {})], "shard", "slot")
