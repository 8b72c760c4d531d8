"""Comparison of query definitions that read the same upstream; lineage of files.

A profile is one row: label, upstream, options map, measures (array of
struct<name, signature>), keys (array of struct<name, normalizers, expression>),
grain, filters and outputs (arrays; outputs are all columns it gives). Findings come from one self-join by upstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import file_stem
from .estate import upstream_identity
from .joins import pairs_in_group

PROFILE = (
    "label string, workbook string, upstream string, options map<string,string>, measures array<struct<name:string,signature:string>>, "
    "keys array<struct<name:string,normalizers:array<string>,expression:string>>, grain array<string>, filters array<string>, outputs array<string>"
)
_SPACE = r"\s+"


def _finding(df: DataFrame, kind: str, severity, subject, left, right) -> DataFrame:
    s = severity if not isinstance(severity, str) else F.lit(severity)
    return df.select(
        F.col("l.label").alias("left_label"), F.col("r.label").alias("right_label"), F.lit(kind).alias("kind"),
            s.alias("severity"),
        subject.alias("subject"), left.alias("left_value"), right.alias("right_value"),
    )


def findings(profiles: DataFrame) -> DataFrame:
    """Every way in which two queries of one upstream disagree."""
    pair = pairs_in_group(profiles, "upstream", "label")
    none = F.lit("")
    opts = pair.select("l", "r", F.explode(F.array(*map(F.lit, ("QuoteStyle", "Columns", "Delimiter", "Encoding"))))
        .alias("o"))
    lo, ro = F.col("l.options")[F.col("o")], F.col("r.options")[F.col("o")]
    unquoted = F.coalesce(lo == "QuoteStyle.None", F.lit(False)) | F.coalesce(ro == "QuoteStyle.None", F.lit(False))
    parse = _finding(opts.where(~lo.eqNullSafe(ro)), "parse_option", F.when(unquoted, "blocking").otherwise("warning"),
        F.col("o"), F.coalesce(lo, none), F.coalesce(ro, none))

    each = pair.select("l", "r", F.explode("l.measures").alias("m")).select("l", "r", "m",
        F.explode("r.measures").alias("n"))
    other = each.where((F.col("m.name") == F.col("n.name")) & (F.col("m.signature") != F.col("n.signature")))
    measure = _finding(other, "measure_definition", "blocking", F.col("m.name"), F.col("m.signature"),
        F.col("n.signature"))
    names = lambda s, x: F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(F.col(f"{s}.measures"),
        lambda v: v["signature"] == x), lambda v: v["name"]))), ",")
    sig = pair.select("l", "r", F.explode(F.array_intersect(F.transform("l.measures", lambda v: v["signature"]),
        F.transform("r.measures", lambda v: v["signature"]))).alias("s"))
    ln, rn = names("l", F.col("s")), names("r", F.col("s"))
    naming = _finding(sig.where(ln != rn), "measure_name", "info", F.col("s"), ln, rn)

    keys = pair.select("l", "r", F.explode("l.keys").alias("k")).select("l", "r", "k",
        F.explode("r.keys").alias("j")).where(F.col("k.name") == F.col("j.name"))
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    plain = lambda c: F.trim(F.regexp_replace(c, _SPACE, " "))
    made = lambda k: F.coalesce(plain(F.col(f"{k}.expression")), F.lit(""))
    apart = text(F.col("k.normalizers")) != text(F.col("j.normalizers"))
    norm = _finding(keys.where(apart | (made("k") != made("j"))), "key_normalization",
        F.when(apart, "blocking").otherwise("warning"), F.col("k.name"), made("k"), made("j"))
    known = lambda s: F.transform(F.col(f"{s}.keys"), lambda v: v["name"])
    lost_r = pair.select("l", "r", F.explode(F.array_except(F.array_except(known("l"), known("r")), F.col("r.outputs")))
        .alias("k"))
    lost_l = pair.select("l", "r", F.explode(F.array_except(F.array_except(known("r"), known("l")), F.col("l.outputs")))
        .alias("k"))
    missing = _finding(lost_r, "key_missing", "warning", F.col("k"), F.lit("derived"),
        none).union(_finding(lost_l, "key_missing", "warning", F.col("k"), none, F.lit("derived")))

    lg, rg = text(F.col("l.grain")), text(F.col("r.grain"))
    grain = _finding(pair.where(lg != rg), "grain", "warning", none, lg, rg)
    rows = lambda s: text(F.transform(F.col(f"{s}.filters"), plain))
    filters = _finding(pair.where(rows("l") != rows("r")), "filter", "warning", none, rows("l"), rows("r"))
    out = parse
    for f in (measure, naming, norm, missing, grain, filters):
        out = out.union(f)
    return out


def representatives(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profiles, (label, representative)): equal profiles of an upstream as one, by the least label, and who is whose.

    Equal are profiles whose options, measures, keys, grain, filters and
    outputs are. Findings between representatives are those of all pairs of
    their members, which many copies of one query would otherwise multiply.
    """
    said = F.struct(F.array_sort(F.map_entries("options")).alias("options"), "measures", "keys", "grain", "filters", "outputs")
    by = profiles.withColumn("_said", F.sha2(F.to_json(said), 256))
    cols = [c for c in profiles.columns if c not in ("label", "upstream")]
    least = by.groupBy("upstream", "_said").agg(F.min("label").alias("representative"),
        F.min_by(F.struct(*cols), "label").alias("_row"))
    ones = least.select(F.col("representative").alias("label"), "upstream", *[F.col(f"_row.{c}").alias(c) for c in cols])
    same = F.col("l.upstream").eqNullSafe(F.col("r.upstream")) & (F.col("l._said") == F.col("r._said"))
    members = by.alias("l").join(least.alias("r"), same).select("l.label", "r.representative")
    return ones.select(*profiles.columns), members


def forked_upstreams(profiles: DataFrame) -> DataFrame:
    """Upstreams that more than one workbook reads."""
    return profiles.groupBy("upstream").agg(F.countDistinct("workbook").alias("workbooks"),
        F.count(F.lit(1)).alias("queries")).where("workbooks > 1")


def version_skew(edges: DataFrame) -> DataFrame:
    """(consumer, stem, files, variants) where a consumer reads several files that are versions of one asset.

    ``edges``: src, as a location is written, and dst. Only locations that are
    files by ``upstream_identity`` count, by their name alone, as it is written;
    a name of nothing but marks and version words is no asset. A location is
    judged once, however many read it: in columns, as Spark would move a filter
    down to every edge. What is no asset has no stem and no file. Edges go
    early only where their location has no folder, is a web address or plainly
    a name of version words, which many may read.
    """
    place = text.strip_all(F.col("src"))
    name = F.substring_index(F.regexp_replace(F.translate(place, "\\", "/"), "/+$", ""), "/", -1)
    is_file = F.startswith(upstream_identity(F.col("src")), F.lit("file:"))
    word = f"(?i:{'|'.join(text.VERSION_WORDS)})"
    early = rf"(?s)^(?!https?://)(?!.*[/\\]{word}(?:[ _-]+{word})*\.[A-Za-z0-9]+\z).*[/\\]"
    met = edges.select(F.col("dst").alias("consumer"), "src").where(F.col("src").rlike(early))
    seen = met.select("src").distinct().withColumn("name", name)  # each step a projection of its own: nothing is computed twice
    judged = seen.withColumn("stem", F.when(is_file, file_stem(F.col("name")))).select("src", F.nullif("stem", F.lit("")).alias("stem"),
        F.when(F.col("stem") != "", F.col("name")).alias("file"))
    named = met.join(judged, "src").select("consumer", "stem", "file").distinct()
    found = named.groupBy("consumer", "stem").agg(F.count("file").alias("files"), F.collect_list("file").alias("variants"))
    return found.where("files > 1").withColumn("variants", F.sort_array("variants"))


def resolve(edges: DataFrame, files: DataFrame) -> DataFrame:
    """Edges with the swept file that their name means: by lower name, else by letters and digits; the first registered wins."""
    key = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    by_name = files.groupBy(F.lower("name").alias("n")).agg(F.min_by("file_id", "pos").alias("f1"))
    by_key = files.groupBy(key(F.col("name")).alias("k")).agg(F.min_by("file_id", "pos").alias("f2"))
    return edges.join(by_name, F.lower("src") == F.col("n"), "left").join(by_key, key(F.col("src")) == F.col("k"),
        "left").select(*edges.columns, F.coalesce("f1", "f2").alias("file_id"))
