"""Join operators: dimensions, lookups, exclusions, date-effective rates, overlaps."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.text import named
from ..session import checkpointed
from . import cells


class NotUnique(ValueError):
    """A dimension has more than one row for a key."""


def many_to_one(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts with the dimension's columns, null where the key is unknown.

    The dimension is checked once for duplicate keys: a duplicate would
    multiply facts. Whether it is broadcast is left to its measured size.
    """
    twice = dim.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise NotUnique(f"{key} = {twice[0][key]!r} occurs {twice[0]['count']} times")
    return facts.join(dim, key, "left")


def unknown_members(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of the facts that the dimension lacks."""
    return facts.select(key).where(F.col(key).isNotNull()).distinct().join(dim, key, "left_anti")


def first_match(facts: DataFrame, right: DataFrame, key: str, order: Sequence[Column],
    take: Mapping[str, object]) -> DataFrame:
    """Exact lookup: of several right rows the first by ``order``; defaults where none.

    ``take`` maps columns to take to their defaults. Picking the first is a
    ``min_by``, which combines before the shuffle, so a hot key is no window.
    """
    cols = list(take)
    first = right.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_hit"))
    out = facts.join(first, key, "left")
    for c, default in take.items():
        out = out.withColumn(c, F.coalesce(F.col(f"_hit.{c}"), F.lit(default)))
    return out.drop("_hit")


def excluding(facts: DataFrame, others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts without a partner whose keys are all the same, null being equal to null."""
    r = others.select(*[named(c).alias(f"_{c}") for c in on]).distinct()
    cond = None
    for c in on:
        same = named(c).eqNullSafe(named(f"_{c}"))
        cond = same if cond is None else cond & same
    return facts.join(r, cond, "left_anti")


def effective(facts: DataFrame, rates: DataFrame, on: Sequence[str], when: str, since: str,
    values: Sequence[str]) -> DataFrame:
    """Facts with the values of the latest rate that is in force on their date.

    Rates become intervals by one window over the (small) rate table, so facts
    are joined once by key and interval and are neither ranked nor sorted.
    """
    span = W.partitionBy(*map(named, on)).orderBy(named(since))
    r = rates.withColumn("_to", F.lead(named(since)).over(span)).select(
        *[named(c).alias(f"_{c}") for c in on], named(since).alias("_from"), "_to", *map(named, values)
    )
    cond = (F.col("_from") <= named(when)) & (F.col("_to").isNull() | (named(when) < F.col("_to")))
    for c in on:
        cond = cond & (named(c) == named(f"_{c}"))
    return facts.join(r, cond, "left").drop("_from", "_to", *[f"_{c}" for c in on])


def ends_with_key(facts: DataFrame, right: DataFrame, text: str, key: str, tail: Column) -> DataFrame:
    """Wildcard lookup ``*key``: an equi-join on the computed tail of the right side's text."""
    return facts.join(right.withColumn("_tail", F.upper(tail)), F.upper(F.col(key)) == F.col("_tail")).drop("_tail")


def contains_key(facts: DataFrame, right: DataFrame, text: str, key: str, gram: int = 3) -> DataFrame:
    """Wildcard lookup ``*key*``: facts with the right rows whose text holds the key, in any case.

    An equi-join on the key's rarest piece of ``gram`` letters among the pieces
    of the right side's texts, then checked whole. Keys of fewer letters meet
    pieces of their own length; a key with a piece that no text has matches
    none. Blank keys match nothing. Equal texts are searched once, and equal
    right rows stay as many as they are. Pieces are several times the texts,
    which Spark's estimates don't know: they are never broadcast.
    """
    want = F.upper(F.col(key))
    pieces = lambda c, n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))),
        lambda i: F.substring(c, i, n))
    keys = facts.select(key).where(F.length(key) > 0).distinct()
    lengths = sorted({gram, *(r[0] for r in keys.select(F.least(F.length(key), F.lit(gram))).distinct()
        .collect())})  # gram rows at most
    low = right.select(F.upper(F.col(text)).alias("_low")).where("_low IS NOT NULL").distinct()
    held = low.select("_low", F.explode(F.array_distinct(F.concat(*[pieces(F.col("_low"), n) for n in lengths])))
        .alias("_piece"))
    often = held.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    own = keys.select(key, F.explode(F.array_distinct(pieces(want, gram))).alias("_piece"))
    counted = own.hint("merge").join(often.hint("merge"), "_piece", "left")
    rarest = counted.groupBy(key).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_piece")).alias("_least")).where(
        "_least._n > 0").select(key, F.col("_least._piece").alias("_piece"))
    met = rarest.hint("merge").join(held.hint("merge"), "_piece").where(F.contains("_low", want)).select(key, "_low")
    found = met.hint("merge").join(right.withColumn("_low", F.upper(F.col(text))).hint("merge"), "_low").drop("_low")
    return facts.hint("merge").join(found.hint("merge"), key)


#: Longs of a set's parity bitmap: 512 bits.
BITMAP_WORDS = 8


def _similar_sets(sets: DataFrame, owner: str, item: str, file: str, least_items: int,
    carry: Sequence[str] = ()) -> DataFrame:
    """(o, f, n, items, of, bits) of each owner: a row is a set, ``bits`` its parity bitmap, ``of`` what it carries."""
    of = F.struct(*map(named, carry)) if carry else F.lit(None).cast("string")
    items = named(item)
    if not isinstance(sets.schema[item].dataType, ArrayType):
        sets = sets.groupBy(named(owner).alias("o"), named(file).alias("f")).agg(F.collect_set(items).alias("items"),
            F.min(of).alias("of"))
    else:
        sets = sets.select(named(owner).alias("o"), named(file).alias("f"), F.array_distinct(F.array_compact(items))
            .alias("items"), of.alias("of"))
    one = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    word = lambda h: F.shiftrightunsigned(h, 6).bitwiseAND(BITMAP_WORDS - 1)
    fold = lambda k: F.aggregate("hashes", F.lit(0).cast("long"), lambda acc, h: F.when(word(h) == k,
        acc.bitwiseXOR(one(h))).otherwise(acc))
    full = sets.withColumn("n", F.size("items")).where(F.col("n") >= least_items)
    return full.withColumn("hashes", F.transform("items", lambda i: F.xxhash64(i))).select("o", "f", "n", "items", "of",
        F.array(*map(fold, range(BITMAP_WORDS))).alias("bits"))


def _ceil(c: Column) -> Column:
    return F.ceil(c - 1e-9).cast("int")


def set_candidates(whole: DataFrame, least: float) -> DataFrame:
    """(lo, ro): pairs of sets that no bound rules out so far, the smaller set on the left.

    Items have one global order, the rarest first. A pair must share one of the
    first items of both, early enough in both for what follows to suffice
    (prefix and position filter); sizes meet by bands of the ratio ``least``,
    which are part of the join's key.
    """
    held = whole.select("o", "f", "n", F.explode("items").alias("item"))
    often = held.groupBy("item").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    alone = F.col("n") - F.count(F.lit(1)).over(W.partitionBy("o"))  # items that no other set has come first
    place = F.row_number().over(W.partitionBy("o").orderBy("often", "item"))
    ranked = held.join(often, "item").withColumn("p", place + alone)
    return prefix_pairs(ranked.where(F.col("p") <= F.col("n") - _ceil(least * F.col("n")) + 1), least)


def prefix_pairs(high: DataFrame, least: float) -> DataFrame:
    """(lo, ro) of sets that share an early item; ``high`` has (o, f, n, item, p) of each of the first items."""
    low = high.where(F.col("p") <= F.col("n") - _ceil(2 * least / (1 + least) * F.col("n")) + 1)
    band = F.floor(F.log(F.col("n").cast("double")) / math.log((1 + 1e-9) / least)) if least < 1 else F.col("n")
    l = low.select("item", F.explode(F.array(band, band + 1)).alias("band"), *[F.col(c).alias(f"l{c}") for c in "ofnp"])
    r = high.select("item", band.alias("band"), *[F.col(c).alias(f"r{c}") for c in "ofnp"])
    smaller = (F.col("ln") < F.col("rn")) | ((F.col("ln") == F.col("rn")) & (F.col("lo") < F.col("ro")))
    early = 1 + F.least(F.col("ln") - F.col("lp"), F.col("rn") - F.col("rp")) >= _need(least)
    possible = smaller & (F.col("lf") != F.col("rf")) & (F.col("ln") >= F.col("rn") * least - 1e-9) & early
    return l.join(r, ["item", "band"]).where(possible).select("lo", "ro").distinct()


def _need(least: float) -> Column:
    """Items that sets of these sizes must share."""
    return _ceil(least / (1 + least) * (F.col("ln") + F.col("rn")))


def close_sets(whole: DataFrame, least: float) -> DataFrame:
    """Candidates with both their sets, where the parity bitmaps differ in no more bits than the sets may in items.

    The bound stands for the filter on suffixes; what passes is counted exactly.
    """
    side = lambda s, *cols: whole.select(*[F.col(c).alias(s + c) for c in ("o", *cols)])
    differ = sum((F.bit_count(F.get("lbits", F.lit(k)).bitwiseXOR(F.get("rbits", F.lit(k))))
        for k in range(BITMAP_WORDS)), F.lit(0))
    pairs = set_candidates(whole, least)  # few bytes but much work: adaptive execution would put them in one task
    pairs = pairs.repartition(int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lo")
    met = pairs.join(side("l", "n", "bits"), "lo").join(side("r", "n", "bits"), "ro")
    near = met.where(F.col("ln") + F.col("rn") - differ >= 2 * _need(least)).drop("lbits", "rbits")
    return near.join(side("l", "items", "of"), "lo").join(side("r", "items", "of"), "ro")


def set_overlap(sets: DataFrame, owner: str, item: str, file: str, least: float = 0.7, min_items: int = 4,
    carry: Sequence[str] = ()) -> DataFrame:
    """Pairs of owners in different files whose item sets have a Jaccard index of ``least`` or more.

    ``sets`` has one row for each (owner, file, item), or one for each owner
    with an array of items; null items don't count, an owner has one file.
    Gives (a, b, na, nb, shared, jaccard, common), a being the smaller owner and
    ``common`` the shared items, and for each column c of ``carry``, which hangs
    on the owner, a_c and b_c. Candidates are bounded before a pair is made
    (``set_candidates``, ``close_sets``) and then counted exactly, on whole sets; a set is one
    row. Many owners of equal sets make all their pairs: let equal sets be one
    first where that can be.
    """
    whole = _similar_sets(sets, owner, item, file, min_items, carry)
    met = close_sets(whole, least).withColumn("common", F.array_intersect("litems", "ritems"))
    first = F.col("lo") < F.col("ro")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    shared = F.size("common").cast("long")
    index = shared / (F.col("ln") + F.col("rn") - shared)
    return met.select(pick("lo", "ro").alias("a"), pick("ro", "lo").alias("b"), pick("ln", "rn").alias("na"),
        pick("rn", "ln").alias("nb"), shared.alias("shared"), index.alias("jaccard"), "common",
        *[pick(f"{x}of.`{c}`", f"{y}of.`{c}`").alias(f"{s}_{c}") for c in carry for s, x, y in (("a", "l", "r"), ("b", "r",
            "l"))]).where(F.col("jaccard") >= least)


#: Items that the sets of a block of pairs may have: 128 MB.
BLOCK = 1 << 24
#: Items, of both sets of each pair, that a block of pairs may have.
WORK = 1 << 26
#: Slots of owners by hash: those without a pair are dropped before their sets are made. A broadcast of so many numbers at most.
SLOTS = 1 << 20


def hashed_overlap(sets: DataFrame, owner: str, hashes: str | Column, least: float = 0.7, min_items: int = 4) -> DataFrame:
    """(a, b, na, nb, shared, jaccard) of owners whose sets of item hashes have a Jaccard index of ``least`` or more.

    ``sets`` has one row for each owner, with an array of distinct longs. It is
    ``set_overlap`` for large sets of which only the counts are wanted.
    """
    return hashed_counts(hashed_candidates(sets, owner, hashes, least, min_items), sets, owner, hashes, least)


def hashed_candidates(sets: DataFrame, owner: str, hashes: str, least: float = 0.7, min_items: int = 4, same: str | None = None,
    sizes: DataFrame | None = None) -> DataFrame:
    """(lo, ro, ln, rn): pairs of owners that no bound rules out, the smaller set on the left; see ``cells``.

    Sets of one value of ``same``, a long, are equal: their smallest owner is
    paired for all of them. ``sizes`` has the column n, the size of each set,
    where that is known.
    """
    o = named(owner).cast("long")
    whole = sets.select(o.alias("o"), (named(same) if same else o).alias("same"), named(hashes).alias("h"))  # unfiltered, or
    # sets are made twice
    lower = cells.bounds(least)
    sizes = whole.select(F.size("h").alias("n")) if sizes is None else sizes
    band = sum((F.col("n") >= int(x)).cast("int") for x in lower[1:]) + F.lit(0)
    planned = cells.plan({t: n for t, n in sizes.where(F.col("n") > 0).groupBy(band.alias("t")).agg(F.sum(F.col("n").cast("long")))
        .collect()}, lower)  # a row a band
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = whole.mapInArrow(cells.deal(least, min_items, planned), cells.DEALT).repartition(tasks, "key")
    return dealt.groupBy("key").applyInArrow(cells.meet(least, planned), cells.MET).repartition(tasks, "lo").distinct()


def hashed_counts(pairs: DataFrame, sets: DataFrame, owner: str, hashes: str | Column, least: float = 0.7) -> DataFrame:
    """(a, b, na, nb, shared, jaccard) of those ``pairs`` (lo, ro, ln, rn) of owners that have an index of ``least`` or more.

    Sets travel to blocks of pairs that share a neighbour, not to each pair.
    ``hashes`` may be an expression: it is computed for owners in a pair, and
    for those few that share a slot with one.
    """
    near = checkpointed(pairs)
    h = hashes if isinstance(hashes, Column) else named(hashes)
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int").alias("slot")
    met = near.select(F.explode(F.array("lo", "ro")).alias("o")).select(slot("o")).distinct()
    some = sets.withColumn("slot", slot(named(owner).cast("long"))).join(F.broadcast(met), "slot", "left_semi")
    whole = some.select(named(owner).cast("long").alias("o"), h.alias("hashes"))
    rep = near.select(F.explode(F.array("lo", "ro")).alias("lo"), F.col("lo").alias("y")).groupBy("lo").agg(F.min("y").alias("g"))
    grouped = near.join(rep, "lo")
    ends = F.array(F.struct(F.col("lo").alias("o"), F.col("ln").alias("n"), (F.col("ln") + F.col("rn")).cast("long").alias("w")),
        F.struct(F.col("ro").alias("o"), F.col("rn").alias("n"), F.lit(0).cast("long").alias("w")))
    held = grouped.select("g", F.explode(ends).alias("e")).groupBy("g", "e.o").agg(F.max("e.n").alias("n"), F.sum("e.w").alias("w"))
    k = F.greatest(F.ceil(F.sqrt(F.sum("w") / WORK)), F.when(F.sum("n") > BLOCK, F.ceil(2 * F.sum("n") / BLOCK)).otherwise(1))
    many = checkpointed(held.groupBy("g").agg(k.cast("int").alias("k"), F.sum("w").alias("w"), F.sum("n").cast("long").alias("n")))
    copies = F.sum(F.col("n") * F.when(F.col("k") > 1, 2 * F.col("k")).otherwise(1))
    n, w = many.agg(copies, F.sum("w")).first()
    blocks = (n or 0) // BLOCK + (w or 0) // WORK + 1
    cut = lambda c: F.pmod(F.xxhash64(c), F.col("k"))
    dealt = grouped.join(many.select("g", "k"), "g").select(F.pmod(F.xxhash64("g", cut("lo"), cut("ro")), F.lit(blocks))
        .alias("block"), "lo", "ro", "ln", "rn")
    wanted = dealt.select(F.col("block").alias("at"), F.explode(F.array("lo", "ro")).alias("o")).distinct()
    held = wanted.join(whole, "o").select("at", "o", "hashes")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        own = {o.as_py(): x.values.to_numpy(zero_copy_only=False) for o, x in zip(right["o"], right["hashes"], strict=True)}
        shared = [len(np.intersect1d(own[a], own[b], assume_unique=True)) for a, b in zip(left["lo"].to_pylist(),
            left["ro"].to_pylist(), strict=True)]
        return left.drop_columns(["block"]).append_column("shared", pa.array(shared, pa.int64()))

    got = dealt.groupBy("block").cogroup(held.groupBy("at")).applyInArrow(count,
        "lo bigint, ro bigint, ln int, rn int, shared bigint")
    first = F.col("lo") < F.col("ro")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return got.select(pick("lo", "ro").alias("a"), pick("ro", "lo").alias("b"), pick("ln", "rn").alias("na"), pick("rn", "ln")
        .alias("nb"), "shared", (F.col("shared") / (F.col("ln") + F.col("rn") - F.col("shared"))).alias("jaccard")).where(
        F.col("jaccard") >= least)


def pairs_in_group(df: DataFrame, group: str, label: str) -> DataFrame:
    """(l, r) structs of every two rows of a group, the smaller label on the left."""
    l, r = (df.select(F.col(group).alias("g"), F.struct(*df.columns).alias(s)) for s in "lr")
    return l.join(r, "g").where(F.col(f"l.{label}") < F.col(f"r.{label}")).select("l", "r")
