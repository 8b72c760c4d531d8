"""Expected assets: which of the files that an estate should have are there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import contains_key

#: Parts of a glob that aren't literal: a closed bracket, or one of the two wildcards.
_BRACKET = r"\[!?[^\]]+\]"
_WILD = _BRACKET + "|[*?]"


def glob_pattern(glob: Column) -> Column:
    """Regular expression of a column of globs with *, ?, [abc] and [!abc]; a bracket that isn't closed is itself."""
    plain = lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, r"([.^$+(){}|\\\[\]])", r"\\$1"), r"\*", ".*"),
        r"\?", ".")
    inside = lambda g: F.regexp_replace(F.regexp_replace(g, r"(?<=.)([\[\\^])", r"\\$1"), r"^\[!", "[^")
    runs = F.transform(F.split(glob, _BRACKET), plain)
    sets = F.transform(F.regexp_extract_all(glob, F.lit(_BRACKET), F.lit(0)), inside)
    both = F.zip_with(runs, sets, lambda r, s: F.concat(r, F.coalesce(s, F.lit(""))))
    return F.concat(F.lit("(?s)^"), F.array_join(both, ""), F.lit("$"))


def literal_run(glob: Column) -> Column:
    """The longest run of a glob that is literal; the first of several; empty if there is none."""
    runs = F.split(glob, _WILD)
    return F.coalesce(F.get(F.array_sort(runs, lambda a, b: F.length(b) - F.length(a)), F.lit(0)), F.lit(""))


def matched(globs: DataFrame, names: DataFrame, glob: str, name: str) -> DataFrame:
    """Every name with every glob that it matches in any case: (columns of ``globs``, columns of ``names``).

    A glob's longest literal run is looked up among the names by its rarest
    three letters, and what that finds is held against the whole glob; a glob
    without a literal letter meets every name, which it mostly matches. Only
    such globs, which are few, are broadcast.
    """
    asked = globs.select(F.lower(F.col(glob)).alias("_glob")).distinct().where("_glob IS NOT NULL").withColumn("_literal",
        literal_run(F.col("_glob")))
    texts = names.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct()
    near = contains_key(asked.where("_literal <> ''"), texts, "_name", "_literal")
    open_ = texts.crossJoin(F.broadcast(asked.where("_literal = ''")))
    both = near.select("_glob", "_name").union(open_.select("_glob", "_name"))
    met = both.where(F.rlike(F.lower("_name"), glob_pattern(F.col("_glob"))))
    out = globs.withColumn("_glob", F.lower(F.col(glob))).hint("merge").join(met.hint("merge"), "_glob")
    return out.hint("merge").join(names.withColumn("_name", F.col(name)).hint("merge"), "_name").drop("_glob", "_name")


def confirm(seeds: DataFrame, names: DataFrame, seed: str = "seed", patterns: str = "patterns",
    name: str = "name") -> DataFrame:
    """(seed, status, files, first): each expected asset as ``present``, ``absent`` or ``ambiguous``.

    ``seeds``: seed, an array of globs, any of which will do; an asset is
    present if one name matches, ambiguous if several do; ``first`` is the
    smallest name. Seeds without a pattern are absent. Seeds of the same globs
    are looked up once, so no seed is multiplied by its files.
    """
    told = names.select(F.col(name).alias("_file")).distinct()
    own = F.when(F.col("_seed").isNotNull(), F.lower("_pattern"))
    asked = seeds.select(F.col(seed).alias("_seed"), F.explode_outer(patterns).alias("_pattern")).groupBy("_seed").agg(
        F.array_sort(F.collect_set(own)).alias("_patterns"))
    kinds = asked.select("_patterns").distinct().select("_patterns", F.explode("_patterns").alias("_pattern"))
    hits = matched(kinds, told, "_pattern", "_file").select("_patterns", "_file").distinct().groupBy("_patterns").agg(
        F.count(F.lit(1)).alias("files"), F.min("_file").alias("first"))
    status = F.when(F.col("files") == 1, "present").when(F.col("files") > 1, "ambiguous").otherwise("absent")
    return asked.hint("merge").join(hits.hint("merge"), "_patterns", "left").select(F.col("_seed").alias(seed),
        status.alias("status"), F.coalesce("files", F.lit(0)).alias("files"), "first")
