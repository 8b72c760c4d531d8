"""Graphs of references: strongly connected components, cycles, facts that references pass on.

Each round of an iteration is one or two joins whose result is checkpointed,
so lineage stays short and a lost executor costs one round. Only what a round
has changed is joined in the next; the driver sees whether there is any.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, fixed_layout

#: Rounds of trimming in one plan.
_TRIMS = 3
#: Rows of a task, up to which it isn't worth more of them.
_ROWS = 100_000
#: Pieces of what is known that a round is held against, before they become one.
_PIECES = 8
#: A node that more than one in so many edges lead to, and at least _MANY, is dealt to so many parts by the edges' other ends.
_PARTS = 64
_MANY = 1 << 20


def _trimmed(e: DataFrame) -> DataFrame:
    """Edges whose ends can lie between two cycles: nodes without an edge in or out go, until all have both."""
    before = e.count()
    while before:
        for _ in range(_TRIMS):
            e = e.join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(
                e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")
        e = checkpointed(e)
        now = e.count()
        if now == before:
            break
        before = now
    return e


def _coloured(e: DataFrame) -> DataFrame:
    """(node, c): the largest node that reaches each node, itself included."""
    nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
    nodes = checkpointed(nodes.withColumn("c", F.col("node")).withColumn("new", F.lit(True)))
    while not nodes.where("new").isEmpty():
        sent = nodes.where("new").join(e, F.col("node") == F.col("src")).groupBy("dst").agg(F.max("c").alias("sent"))
        more = F.coalesce(F.col("sent") > F.col("c"), F.lit(False))
        nodes = checkpointed(nodes.join(sent, F.col("node") == F.col("dst"), "left").select("node",
            F.when(more, F.col("sent")).otherwise(F.col("c")).alias("c"), more.alias("new")))
    return nodes.select("node", "c")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes on a cycle; a component is a set of nodes that reach each other, named by the least.

    ``edges``: src, dst; nulls are no nodes, a node that reads itself is a
    cycle. Nodes that no cycle needs are trimmed; then the largest node that
    reaches each node is spread forward, and from every node that is its own,
    the nodes of its colour that lead back to it are its component. What is
    left of the graph goes through the same again.
    """
    e = checkpointed(edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct())
    found = []
    while True:
        e = _trimmed(e)
        if e.isEmpty():
            break
        colour = _coloured(e)
        inside = checkpointed(e.join(colour.toDF("src", "c"), "src").join(colour.toDF("dst", "d"), "dst").where(
            "c = d").select("src", "dst", "c"))
        front = colour.where("node = c")
        held = [front]
        while not front.isEmpty():
            back = inside.join(front.select(F.col("node").alias("dst")), "dst").select(F.col("src").alias("node"), "c").distinct()
            seen = reduce(DataFrame.union, held)
            front = checkpointed(back.join(seen.select("node"), "node", "left_anti"))
            held.append(front)
        own = checkpointed(reduce(DataFrame.union, held))
        loops = inside.where("src = dst").select(F.col("src").alias("node"))
        several = own.groupBy("c").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("n"))
        met = own.join(several, "c").join(loops.withColumn("loop", F.lit(True)), "node", "left")
        found.append(met.where("n > 1 OR loop").select("node", "component"))
        gone = own.select("node")
        e = checkpointed(e.join(gone, F.col("src") == F.col("node"), "left_anti").join(gone, F.col("dst") == F.col("node"),
            "left_anti"))
    empty = e.select(F.col("src").alias("node"), F.col("src").alias("component"))
    return reduce(DataFrame.union, found, empty)


def cycles(edges: DataFrame, depth: int = 12) -> DataFrame:
    """Cycles of up to ``depth`` nodes as sorted node sets, one row each set.

    Only edges inside a strongly connected component are followed. Paths grow
    from their least node and never go below it, so each cycle is found from
    one start; a step is a join, and the driver sees no path. A component in
    which all read all has as many paths as that gives.
    """
    of = components(edges)
    l, r = of.toDF("src", "component"), of.toDF("dst", "other")
    e = checkpointed(edges.select("src", "dst").distinct().join(l, "src").join(r, "dst").where("component = other").select(
        "src", "dst"))
    paths = e.where("src <= dst").select(F.array("src").alias("path"), F.col("dst").alias("at"))
    found = []
    for step in range(depth):
        found.append(paths.where(F.col("path")[0] == F.col("at")).select(F.array_join(F.array_sort("path"), ",")
            .alias("nodes")))
        open_ = paths.where(F.col("path")[0] < F.col("at")).where(~F.array_contains("path", F.col("at")))
        paths = open_.join(e, F.col("at") == F.col("src")).select(F.concat("path", F.array("at")).alias("path"),
            F.col("dst").alias("at"))
        if step % 4 == 3:
            paths = checkpointed(paths)
            if paths.isEmpty():
                break
    return reduce(DataFrame.union, found).distinct()


def passed_on(references: DataFrame, facts: DataFrame, reader: str, read: str, fact: str) -> DataFrame:
    """(reader, fact): the facts of every reader and of all that it reads, directly or through others.

    ``references``: reader, read; ``facts``: reader, fact. Semi-naive: only the
    facts that a round has added are joined in the next, and the end is a round
    that adds none, so that readers which read each other end too. References
    are dealt by what is read and facts by themselves, once and again where there
    is twice as much: a round shuffles the new facts and what they give, neither
    the graph nor what is known. A round's facts are as many as the graph is
    large, which Spark's estimates, of files that compress well, don't tell: no
    side is broadcast.
    """
    spark = references.sparkSession
    most, tasks = int(spark.conf.get("spark.sql.shuffle.partitions")), 0
    edges = checkpointed(references.select(F.col(reader).alias("up"), F.col(read).alias("node")).where(
        F.col("up") != F.col("node")).distinct())
    new = checkpointed(facts.select(F.col(reader).alias("node"), F.col(fact).alias("fact")).where(
        "node IS NOT NULL AND fact IS NOT NULL").distinct())
    known, rows = [new], [edges.count(), new.count()]
    while rows[-1]:
        grown = min(most, 2 << (sum(rows) // _ROWS).bit_length())
        with fixed_layout(spark, grown):
            whole = reduce(DataFrame.union, known)
            if grown != tasks:
                tasks, (up, by, hot) = grown, _dealt(edges, rows[0])
                known = [checkpointed(whole.repartition("node", "fact").sortWithinPartitions("node", "fact"))]
            elif len(known) > _PIECES:  # they share no row, but distinct() leaves them where they are
                known = [checkpointed(whole.distinct().sortWithinPartitions("node", "fact"))]
            copies = F.when(F.col("node").isin(hot), F.sequence(F.lit(0), F.lit(_PARTS - 1))).otherwise(F.array(F.lit(0)))
            sent = new.withColumn("part", F.explode(copies)) if hot else new
            met = up.hint("merge").join(sent.hint("merge"), by).select(F.col("up").alias("node"), "fact").distinct()
            for piece in known:
                met = met.join(piece.hint("merge"), ["node", "fact"], "left_anti")
            new = checkpointed(met)
            known.append(new)
            rows.append(new.count())
    return reduce(DataFrame.union, known).select(F.col("node").alias(reader), F.col("fact").alias(fact))


def _dealt(edges: DataFrame, n: int) -> tuple[DataFrame, list[str], list]:
    """The ``n`` edges (up, node) dealt and sorted by node, these columns, and the few nodes that are dealt in parts besides."""
    up = checkpointed(edges.repartition("node").sortWithinPartitions("node"))
    many = up.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(_MANY, n // _PARTS))
    hot = [r.node for r in many.select("node").collect()]  # fewer than _PARTS
    if not hot:
        return up, ["node"], hot
    part = F.when(F.col("node").isin(hot), F.pmod(F.xxhash64("up"), F.lit(_PARTS)).cast("int")).otherwise(F.lit(0))
    return checkpointed(up.withColumn("part", part).repartition("node", "part").sortWithinPartitions("node", "part")), [
        "node", "part"], hot


def replayed(columns: DataFrame, steps: DataFrame, query: str = "query") -> DataFrame:
    """(query, column, original): what each query's columns are called after its steps, and what they were.

    ``columns``: query, name. ``steps``: query, pos, kind, old, new; in order of
    pos a ``rename`` gives the column called old the name new, in place of one
    that has that name, and does nothing if none is called old; a ``remove``
    drops old; an ``add`` makes new, without an original. A query's steps are
    one row, folded over a map from current to original names, the latter with
    a mark in front, as an added column has none.
    """
    own = F.struct(F.col("name"), F.concat(F.lit("="), F.col("name")).alias("o"))
    first = columns.groupBy(query).agg(F.map_from_entries(F.collect_set(own)).alias("state"))
    told = steps.groupBy(query).agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "old", "new"))).alias("steps"))
    none = F.array().cast("array<struct<pos:bigint,kind:string,old:string,new:string>>")

    def step(m, s):
        kept = F.map_filter(m, lambda k, v: (k != s["old"]) & (k != s["new"]))
        renamed = F.map_concat(kept, F.create_map(s["new"], F.element_at(m, s["old"])))
        added = F.map_concat(F.map_filter(m, lambda k, v: k != s["new"]), F.create_map(s["new"],
            F.lit("+")))
        return F.when((s["kind"] == "rename") & F.map_contains_key(m, s["old"]), renamed).when(s["kind"] == "remove",
            F.map_filter(m, lambda k, v: k != s["old"])).when(s["kind"] == "add", added).otherwise(m)

    whole = first.join(told, query, "left").withColumn("steps", F.coalesce(F.col("steps").cast(
        "array<struct<pos:bigint,kind:string,old:string,new:string>>"), none))
    each = whole.select(query, F.explode(F.aggregate("steps", F.col("state"), step)).alias("column", "from"))
    return each.select(query, "column", F.when(F.col("from") != "+", F.substr("from", F.lit(2))).alias("original"))
