"""Connected components of a link table, by randomised contraction.

Each round every node picks, from itself and its neighbours, the node whose
seeded hash is least, and the graph is rewritten onto the picked nodes. The
number of nodes falls by a constant factor a round in expectation, chains
included, and every step is an aggregate with map-side combine or an
equi-join, so a hub with very many links is never gathered in one task. The
driver sees no link, only whether any is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def connected_components(links: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(id, component) for every node that has a link; component is the least id.

    Links count both ways. Self links, repeats and links with a null end are
    ignored; no link gives no row.
    """
    left = settle(
        links.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b").distinct()
    )
    hops: list[DataFrame] = []
    while not left.isEmpty():
        seed = F.lit(len(hops))
        both = left.union(left.select("b", "a"))
        near = F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("up")))
        own = F.struct(F.xxhash64("id", seed).alias("h"), F.col("id").alias("up"))
        hop = settle(
            both.groupBy(F.col("a").alias("id"))
            .agg(near.alias("near"))
            .select("id", F.least("near", own).getField("up").alias("up"))
        )
        hops.append(hop)
        left = settle(
            left.join(hop.select(F.col("id").alias("a"), F.col("up").alias("a2")), "a")
            .join(hop.select(F.col("id").alias("b"), F.col("up").alias("b2")), "b")
            .where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct()
        )
    if not hops:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    now = hops[0]
    for hop in hops[1:]:
        step = hop.select(F.col("id").alias("up"), F.col("up").alias("further"))
        now = now.join(step, "up", "left").select("id", F.coalesce("further", "up").alias("up"))
    now = settle(now)
    least = now.groupBy("up").agg(F.min("id").alias("component"))
    return now.join(least, "up").select("id", "component")
