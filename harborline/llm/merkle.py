"""A Merkle manifest of a dataset: a digest of every row, folded level by level into one root.

Leaves of a group are numbered in the order of their ids; every ``fanout``
consecutive nodes of a level are the children of one node, whose digest is
that of its children's digests, until a group has one node, its subroot. The
subroots, in the order of their groups, are the leaves of a second tree, whose
top is the root. Each level is a frame of its own, (group, idx, children,
digest), made by one aggregation on (group, idx / fanout) and written down.

Proofs are handed down: a node's proof is its siblings and then its parent's
proof, so a level is joined with the one above it and all levels together cost
about twice the rows of the last; no row climbs the levels by itself.

Null ids come first, rows of one id are ordered by their leaf, equal rows are
leaves each. A null group is a group and comes first. A field that is null
counts as ``-``. An empty table gives an empty frame. Fields are taken by name
and all else is ignored, so that no column can clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .numbering import binned, numbered

#: A proof's level: the digests of the siblings on the left and on the right.
_STEP = "struct<before:string,after:string>"
#: Levels of proofs that one plan joins before it is written down.
_CUT = 4


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its number of UTF-8 bytes, a colon and itself, or ``-`` if null."""
    text = [f.cast("string") for f in fields]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
        for t in text])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _climb(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """Levels of nodes (_g, _n, _idx, _hash, _kids) above the leaves; ``_n`` is the number of nodes of the group."""
    most = leaves.agg(F.max("_n")).first()[0] or 0
    levels, below = [], leaves
    while most > 1:
        most = -(-most // fanout)
        up = below.where("_n > 1").groupBy(
            "_g", F.ceil(F.col("_n") / fanout).alias("_n"), F.floor(F.col("_idx") / fanout).alias("_idx")
        ).agg(F.transform(F.sort_array(F.collect_list(F.struct("_idx", "_hash"))), lambda s: s["_hash"]).alias("_kids"))
        below = settle(up.withColumn("_hash", F.sha2(F.array_join("_kids", ""), 256)))
        levels.append(below)
    return levels


def _proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """Leaves with what ``tops`` (_g, _proof, ...) holds for their group, the proof led down to them."""
    more = [c for c in tops.columns if c not in ("_g", "_proof")]
    step = lambda kids, at: F.struct(F.array_join(F.slice(kids, 1, at), "").alias("before"),
        F.array_join(F.slice(kids, at + 2, fanout), "").alias("after"))
    at = None
    for depth in range(len(levels), 0, -1):
        nodes = levels[depth - 1]
        own = nodes.where("_n = 1").select("_g", "_idx", "_kids").join(tops, "_g")
        if at is not None:
            own = own.unionByName(nodes.select("_g", "_idx", "_kids").join(at, ["_g", "_idx"]))
        if (len(levels) - depth) % _CUT == _CUT - 1:
            own = settle(own)
        if depth > 1:
            at = own.select("_g", (F.col("_idx") * fanout).alias("_first"), "_kids", "_proof", *more,
                F.posexplode("_kids").alias("_at", "_kid")).select(
                "_g", (F.col("_first") + F.col("_at")).alias("_idx"),
                F.concat(F.array(step(F.col("_kids"), F.col("_at"))), F.col("_proof")).alias("_proof"), *more)
    alone = leaves.where("_n = 1").join(tops, "_g")
    if not levels:
        return alone
    up = own.withColumnRenamed("_idx", "_up")
    place = (F.col("_idx") % fanout).cast("int")
    met = leaves.where("_n > 1").withColumn("_up", F.floor(F.col("_idx") / fanout)).join(up, ["_g", "_up"]).withColumn(
        "_proof", F.concat(F.array(step(F.col("_kids"), place)), F.col("_proof")))
    return met.drop("_up", "_kids").unionByName(alone)


def manifest(docs: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "lang", fanout: int = 2,
    also: Mapping[str, Column] | None = None) -> DataFrame:
    """(id, also, leaf, proof, subroot, root) of every row.

    ``proof`` is an array of (before, after), the concatenated digests of a
    row's siblings on both sides, from its own level to the root's. ``also``
    names expressions of the row that are carried along in a struct.
    """
    if fanout < 2:
        raise ValueError("a node has two children at least")
    plain = lambda c: F.col("`" + c.replace("`", "``") + "`")
    group = plain(group_col).cast("string")
    kept = F.struct(*[c.alias(k) for k, c in (also or {}).items()]) if also else F.lit(None).cast("string")
    rows = docs.select(F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("_g"),
        plain(id_col).alias("id"), leaf_digest([plain(f) for f in fields]).alias("_hash"), kept.alias("also"))
    order = ["_g", "id", "_hash"]
    leaves = settle(numbered(binned(rows, order), ["_g"], order[1:]).drop("_bin", "_tie"))
    levels = _climb(leaves, fanout)

    top = leaves.select("_g", "_n", "_hash").where("_n = 1")
    for nodes in levels:
        top = top.unionByName(nodes.select("_g", "_n", "_hash").where("_n = 1"))
    subs = top.select(F.lit("").alias("_g"), F.col("_g").alias("_of"), "_hash")
    subs = settle(numbered(binned(subs, ["_of"]), ["_g"], ["_of"]).drop("_bin", "_tie"))
    upper = _climb(subs, fanout)
    root = (upper[-1] if upper else subs).where("_n = 1").select("_g", F.col("_hash").alias("root"),
        F.array().cast(f"array<{_STEP}>").alias("_proof"))
    tops = settle(_proofs(subs, upper, root, fanout).select(F.col("_of").alias("_g"), F.col("_hash").alias("subroot"),
        "root", "_proof"))
    return _proofs(leaves, levels, tops, fanout).select("id", "also", F.col("_hash").alias("leaf"),
        F.col("_proof").alias("proof"), "subroot", "root")
