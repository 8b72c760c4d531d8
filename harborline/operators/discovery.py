"""Judgements on a swept estate, one row a source: key roles, domain, part played, risk, overlaps.

All are expressions or joins against small tables of rules; only the greedy
one-to-one assignment of roles, which is sequential, runs in Python, a sheet's
headers at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numbers, text
from ..functions.text import named
from .estate import assign_roles
from .joins import set_overlap

#: Names under which headers carry a key. Fixed values.
KEY_PATTERNS = {
    "sku": ("sku", "item", "item code", "item name", "itemid", "part number", "part no", "model", "upc"),
    "po_number": ("po #", "po#", "po number", "po no", "purchase order", "document number"),
    "po_line": ("line", "line #", "line no", "seq"),
    "container": ("container", "container #", "cntr", "ctnr", "equipment"),
    "port_of_loading": ("pol", "port of loading", "load port", "origin port"),
    "port_of_discharge": ("pod", "port of discharge", "discharge port", "destination port"),
    "invoice": ("invoice", "invoice #", "inv #", "inv no"),
    "location": ("location", "warehouse", "whse", "site", "bin", "subsidiary"),
    "quantity": ("qty", "quantity", "units", "pcs", "on hand", "onhand", "available"),
    "date": ("date", "eta", "etd", "committed", "ship date", "due date", "receipt date", "as of"),
    "region_channel": ("region", "channel", "market", "americas", "emea", "b2c", "customer group"),
    "supplier": ("vendor", "supplier", "manufacturer", "factory"),
    "work_order": ("wo", "wo #", "work order", "production order"),
    "currency": ("currency", "curr", "fx", "usd", "cost", "price", "amount", "value"),
    "uom": ("uom", "unit of measure", "units of measure", "each", "per"),
}
#: Roles that make a grain, in the order in which it is told. Fixed values.
GRAIN = ("po_number", "po_line", "container", "invoice", "work_order", "sku", "location", "region_channel", "date")
#: A role found below this score has to be confirmed.
CONFIRM = 0.70
NO_GRAIN = "unresolved"


def key_candidates(headers: DataFrame, sheet: str, header: str,
    patterns: Mapping[str, Sequence[str]] = KEY_PATTERNS) -> DataFrame:
    """(sheet, header, role, score, match): the best claim of each role on each header.

    Exact 1, leading 0.75, contained as whole tokens 0.55, and 0.08 for every
    further token of the pattern; a score may exceed 1. A header meets only
    patterns that begin with one of its tokens, or that equal it without separators.
    """
    rules = headers.sparkSession.createDataFrame([(r, p) for r, ps in patterns.items() for p in ps],
        "role string, pattern string")
    p = rules.select("role", text.header_tokens(F.col("pattern")).alias("p")).where(F.size("p") > 0)
    p = p.select("role", F.size("p").alias("n"), F.array_join("p", " ").alias("p"), F.array_join("p", "").alias("flat"))
    p = p.select("*", F.explode(F.array_distinct(F.array(F.substring_index("p", " ", 1), F.col("flat")))).alias("word"))
    h = headers.select(F.col(sheet).alias("sheet"), F.col(header)
        .alias("header")).where(text.strip_all(F.col("header")) != "").distinct()
    tokens = text.header_tokens(F.col("header"))
    h = h.select("*", F.array_join(tokens, " ").alias("h"), text.header_key(F.col("header")).alias("key"))
    h = h.select("*", F.explode(F.array_distinct(F.concat(F.split("h", " "), F.array("key")))).alias("word"))
    held = lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    match = (
        F.when((F.col("key") == F.col("flat")) | (F.col("h") == F.col("p")), "exact")
        .when(F.startswith(held("h"), held("p")), "leading")
        .when(F.contains(held("h"), held("p")), "contained")
    )
    base = F.when(F.col("match") == "exact", 1.0).when(F.col("match") == "leading", 0.75).otherwise(0.55)
    score = F.round(base + F.lit(0.08) * (F.col("n") - 1), 9)
    met = h.join(F.broadcast(p), "word").withColumn("match", match).where(F.col("match")
        .isNotNull()).withColumn("score", score)  # a fixed table of rules
    best = F.max_by(F.struct("score", "match"), F.struct("score", (F.col("match") == "exact").alias("e"),
        (F.col("match") == "leading").alias("l")))
    return met.groupBy("sheet", "header", "role").agg(best.alias("b")).select("sheet", "header", "role", "b.score",
        "b.match")


def key_roles(headers: DataFrame, sheet: str, header: str, patterns: Mapping[str,
    Sequence[str]] = KEY_PATTERNS) -> DataFrame:
    """(sheet, header, role, score, match, needs_confirmation): each role at most once a sheet, each header for one role.

    The best claim of a sheet is granted first, by its score before it is cut
    to 1; ties go to the smaller role, then header.
    """
    c = key_candidates(headers, sheet, header, patterns)
    won = assign_roles(c, "sheet", "header", "role", "score").join(c.select("sheet", "header", "role", "match"),
        ["sheet", "header", "role"])
    return won.select(
        F.col("sheet").alias(sheet), F.col("header").alias(header), "role",
            F.round(F.least("score", F.lit(1.0)), 3).alias("score"), "match",
        (F.col("score") < CONFIRM).alias("needs_confirmation"),
    )


def grain(roles: Column) -> Column:
    """The grain that an array of roles makes, as text."""
    held = F.filter(F.array(*map(F.lit, GRAIN)), lambda r: F.array_contains(roles, r))
    return F.when(F.size(held) > 0, F.array_join(held, " x ")).otherwise(NO_GRAIN)


def domain(path: Column, headers: Column, keywords: Mapping[str, Sequence[str]], by_path: int = 3) -> Column:
    """struct<domain, score, hits>: the domain with the greatest weight, ties to the first; ``unclassified`` without a hit.

    A keyword in the path weighs ``by_path``; only if it isn't there it weighs
    1 in the headers (an array). Names of more than three letters and digits
    are also found with all separators dropped.
    """
    low, heads = F.lower(path), F.lower(F.array_join(headers, " | "))
    told = F.struct(low.alias("low"), heads.alias("heads"), text.header_key(low).alias("low_flat"), text.header_key(heads)
        .alias("heads_flat"))

    def inside(word: str, whole: Column, flat: Column) -> Column:
        bare = "".join(ch for ch in word.lower() if ch.isascii() and ch.isalnum())
        found = F.contains(whole, F.lit(word))
        return F.coalesce(found | F.contains(flat, F.lit(bare)) if len(bare) > 3 else found, F.lit(False))

    def weighed(t: Column) -> Column:
        every = []
        for i, (name, words) in enumerate(keywords.items()):
            hits = [
                F.when(inside(w, t["low"], t["low_flat"]), F.struct(F.lit(by_path).alias("w"), F.lit(f"{w} (path)").alias("hit")))
                    .when(
                    inside(w, t["heads"], t["heads_flat"]), F.struct(F.lit(1).alias("w"), F.lit(w).alias("hit"))
                )
                for w in words
            ]
            own = lambda found: F.struct(F.aggregate(found, F.lit(0), lambda n, h: n + h["w"]).alias("score"),
                F.lit(-i).alias("place"), F.lit(name).alias("domain"), F.transform(found, lambda h: h["hit"])
                    .alias("hits"))  # noqa: B023, E731
            every.append(text.once(F.filter(F.array(*hits), lambda h: h.isNotNull()), own))
        return F.array_max(F.array(*every))

    return text.once(text.once(told, weighed), lambda best: F.struct(F.when(best["score"] > 0, best["domain"])
        .otherwise("unclassified").alias("domain"), best["score"].alias("score"), best["hits"].alias("hits")))


def part_played(
    query_sources: Column, links: Column, connections: Column, formulas: Column, rows: Column, macros: Column,
        is_csv: Column,
    heavy: float = 500, heavy_per_row: float = 1.0,
) -> Column:
    """struct<role, confidence, reasons>: does a file hold data or restate another's?

    true_source, derived_copy, calculated_output, hybrid or unknown.
    """
    pulls = (query_sources > 0) | (links > 0) | (connections > 0)
    density = F.when(rows > 0, formulas / rows).otherwise(0.0)
    computes = (formulas > heavy) & (density >= heavy_per_row)
    role = (
        F.when(is_csv, "true_source").when(pulls & computes, "hybrid").when(pulls, "derived_copy")
            .when(computes, "calculated_output")
        .when(rows > 0, "true_source").otherwise("unknown")
    )
    sure = F.when(is_csv | pulls, "high").when(computes | (rows > 0), "medium").otherwise("low")
    why = [
        F.when(is_csv, "flat export"),
        F.when(~is_csv & pulls, F.format_string("pulls from %d queries, %d links, %d connections", query_sources, links,
            connections)),
        F.when(~is_csv & computes, F.format_string("%d formulas, %.1f a row", formulas, density)),
        F.when(~is_csv & macros, "has macros"),
        F.when(~is_csv & pulls & computes, "imports and recomputes"),
        F.when(~is_csv & ~pulls & ~computes & (rows > 0), F.format_string("%d rows, pulls nothing, few formulas",
            rows)),
        F.when(~is_csv & ~pulls & ~computes & ~(rows > 0), "no rows read"),
    ]
    return F.struct(role.alias("role"), sure.alias("confidence"),
        F.filter(F.array(*why), lambda x: x.isNotNull()).alias("reasons"))


def refresh_mechanism(queries: Column, connections: Column, links: Column, macros: Column, is_csv: Column) -> Column:
    """How a source gets new data, as text."""
    parts = F.concat_ws(
        " + ",
        F.when(queries > 0, F.format_string("queries (%d)", queries)),
            F.when(connections > 0, F.format_string("connections (%d)", connections)),
        F.when(links > 0, F.format_string("formula links (%d)", links)), F.when(macros, "macro"),
    )
    return F.when(is_csv, "export").when(parts == "", "manual").otherwise(parts)


#: Locations that break: name, pattern, weight; the first that matches counts. Fixed values.
FRAGILE = (
    ("user path", r"^[A-Za-z]:\\Users\\", 40),
    ("network share", r"^\\\\", 25),
    ("personal cloud folder", r"(?i)onedrive", 20),
    ("team site", r"(?i)sharepoint\.com", 8),
    ("web address", r"(?i)^https?://", 8),
    ("download or desktop folder", r"(?i)\\Downloads\\|\\Desktop\\", 45),
)


def normal_location(c: Column) -> Column:
    """A location without the wrapper of a file address and with plain spaces."""
    return F.replace(F.regexp_replace(text.strip_all(c), "(?i)^file:(///|//)?", ""), F.lit("%20"), F.lit(" "))


def risk(
    locations: Column, macros: Column, protected: Column, hidden_sheets: Column, capped: Column,
        header_confidence: Column, errors: Column,
    most: int = 3, most_hidden: int = 24, data_model_parts: Column | None = None,
) -> Column:
    """struct<score, band, findings, details>: what breaks a source; higher is worse.

    Each rule of ``FRAGILE`` counts ``most`` locations at most, each location
    for the first rule that it matches. Macros and their protection 10 each,
    hidden sheets 3 each up to ``most_hidden``, a capped row count 15, a weak
    header (over 0, under 0.55) 12, any probe error 20, parts of a data model
    8 together. ``details`` is an array of (finding, n, example), how often each
    finding was met and the first location, as it was given.
    """
    rule = lambda c: text.once(normal_location(c), lambda p: text.first_rule(p, {name: r for name, r, _ in FRAGILE}))
    given = F.coalesce(locations, F.array().cast("array<string>"))
    count = lambda m, name: F.size(F.filter(m, lambda x: x == name)).alias(name)
    counted = lambda m: F.struct(m.alias("met"), *[count(m, name) for name, _, _ in FRAGILE])
    weak = (header_confidence > 0) & (header_confidence < 0.55)
    one, none = F.lit(1), F.lit(None).cast("string")
    model = F.lit(0) if data_model_parts is None else F.coalesce(data_model_parts, F.lit(0))

    def judged(t: Column) -> Column:
        example = lambda name: F.get(given, F.array_position(t["met"], name).cast("int") - 1)
        parts = [(F.lit(w) * F.least(t[name], F.lit(most)), name, t[name], example(name)) for name, _, w in FRAGILE]
        parts += [
            (F.when(macros, 10), "macros", one, none), (F.when(protected, 10), "protected macros", one, none),
            (F.least(hidden_sheets * 3, F.lit(most_hidden)), "hidden sheets", hidden_sheets, none),
            (F.when(capped, 15), "row count capped", one, none), (F.when(weak, 12), "weak header", one, none),
            (F.when(errors > 0, 20), "probe errors", errors, none), (F.when(model > 0, 8), "data model", model, none),
        ]
        score = F.lit(0)
        for points, *_ in parts:
            score = score + F.coalesce(points, F.lit(0)).cast("int")
        detail = lambda points, name, n, e: F.when(points > 0, F.struct(F.lit(name).alias("finding"), n.cast("long").alias(
            "n"), e.alias("example")))
        details = F.filter(F.array(*[detail(*p) for p in parts]), lambda x: x.isNotNull())
        return F.struct(score.alias("score"), details.alias("details"))

    return text.once(text.once(text.once(F.transform(given, rule), counted), judged), lambda r: F.struct(
        r["score"].alias("score"), numbers.risk_band(r["score"]).alias("band"),
        F.transform(r["details"], lambda d: d["finding"]).alias("findings"), r["details"].alias("details")))


def overlaps(sheets: DataFrame, owner: str, item: str, file: str, rows: str, least: float = 0.7,
    min_items: int = 4, shown: str | None = None, domain: str | None = None) -> DataFrame:
    """(a, b, jaccard, shared, shared_columns, row_delta, conflict[, domain]): sheets of different files with much the same headers.

    ``sheets`` has one row for each (owner, file, item) with the owner's
    ``rows`` and ``domain``. The pairs whose row counts differ most come first: one of the two
    is stale or filtered. ``shared_columns`` are the headers as ``shown`` by a,
    else by b, else the items (an item is shown in one way by a sheet); ``domain``
    is that of both, or a's and b's with a bar.
    """
    carry = [c for c in dict.fromkeys((rows, domain)) if c]
    found = set_overlap(sheets, owner, item, file, least, min_items, carry)
    if shown:
        pair = F.struct(named(item), named(shown))
        heads = sheets.where(named(item).isNotNull() & (named(shown) != "")).groupBy(named(owner).alias("o")).agg(
            F.collect_set(pair).alias("pairs")).select("o", F.map_from_entries("pairs").alias("heads"))
        for s in "ab":
            found = found.join(heads.select(F.col("o").alias(s), F.col("heads").alias(f"_heads_{s}")), s, "left")
        head = lambda i: F.coalesce(F.col("_heads_a")[i], F.col("_heads_b")[i], i)
    else:
        head = lambda i: i
    delta = named(f"a_{rows}") - named(f"b_{rows}")
    left, right = (named(f"{s}_{domain}") for s in "ab") if domain else (None, None)
    both = [F.when(left == right, left).otherwise(F.concat_ws("|", left, right)).alias("domain")] if domain else []
    out = found.select("a", "b", "jaccard", "shared",
        F.array_sort(F.array_distinct(F.transform("common", head))).alias("shared_columns"), delta.alias("row_delta"),
        (delta != 0).alias("conflict"), *both)
    return out.orderBy(F.desc(F.abs("row_delta")), F.desc("jaccard"), "a", "b")


def capped(df: DataFrame, by: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group by ``order``, with ``capped``: whether the group has more.

    The groups' sizes are counted with a combine before the shuffle.
    """
    size = df.groupBy(*map(named, by)).agg((F.count(F.lit(1)) > most).alias("capped"))
    place = F.row_number().over(W.partitionBy(*map(named, by)).orderBy(*map(named, order)))
    first = df.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
    cond = None
    for c in by:
        same = named(c).eqNullSafe(named(f"_by_{c}"))
        cond = same if cond is None else cond & same
    return first.join(size.select(*[named(c).alias(f"_by_{c}") for c in by], "capped"), cond,
        "left").drop(*[f"_by_{c}" for c in by])
