"""Secret scans over an incremental, content-addressed ledger.

Only native expressions. Every historical version of a document is addressed
by the SHA-256 of its text. A ledger row is one (blob, rule, version) pair
that has been scanned, with its spans; a run scans only pairs that are not in
the ledger, each blob once however many paths hold it, and joins the findings
back to all paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle

#: The version of each rule; raising one makes the next run scan every blob for that rule only.
VERSIONS = {"assign": 1, "access": 1, "hex": 1}
WORDS = ("password", "passwd", "secret", "token")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


#: Letters of the names in either case, ASCII only.
NAMES = "|".join([*map(_either, WORDS), f"{_either('api')}_?{_either('key')}"])
ASSIGN = rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of 18 or 16 is the same as a whole run that proves long enough.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RULES = tuple(VERSIONS)
LEDGER = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("rule", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType())]))),
    ]
)
_EMPTY = "array<struct<start:bigint,end:bigint>>"


def blob_of(text):
    """The address of a version: SHA-256 of its UTF-8 bytes; null is empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_of(text, pattern: str, long_enough=None):
    """[start, end) in code points of each leftmost match that is ``long_enough``.

    What lies between matches and the matches themselves alternate, so running
    lengths of the two give the positions.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ok = long_enough or (lambda hit: F.lit(True))
    parts = F.transform(hits, lambda h: F.struct(F.length(h).cast("long").alias("n"), ok(h).alias("ok")))
    steps = F.zip_with(parts, F.slice(gaps, 1, F.size(hits)), lambda p,
        g: F.struct(p["n"].alias("n"), p["ok"].alias("ok"), g.cast("long").alias("gap")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_EMPTY).alias("out"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        span = F.array(F.struct(begin.alias("start"), (begin + x["n"]).alias("end")))
        return F.struct(
            (begin + x["n"]).alias("at"),
            F.when(x["ok"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(steps, start, step, lambda acc: acc["out"])


def _rule_spans(text):
    value = F.regexp_extract
    return {
        "assign": (F.rlike(text, F.lit(ASSIGN)), spans_of(text, ASSIGN, lambda h: F.length(value(h, ASSIGN, 2)) >= 12)),
        "access": (F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS)),
        "hex": (F.rlike(text, F.lit(HEX)), spans_of(text, HEX)),
    }


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def _current(versions: dict[str, int]):
    """The version that a ledger row's rule now has."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in versions.items() for x in kv]), F.col("rule"))


def scan_unseen(docs: DataFrame, ledger: DataFrame, versions: dict[str, int] = VERSIONS,
    text_col: str = "text") -> DataFrame:
    """New ledger rows: every blob of ``docs`` and rule of the current version not yet in ``ledger``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    seen = ledger.where(F.col("version") == _current(versions)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    blobs = docs.select(blob_of(text).alias("blob"), text.alias("body"))
    todo = F.array_except(F.array(*map(F.lit, RULES)), F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    # copies fall together where they are read; the ledger then meets blobs on the same partitioning
    new = (
        blobs.groupBy("blob")
        .agg(F.first("body").alias("body"))
        .join(seen, "blob", "left")
        .withColumn("todo", todo)
        .where(F.size("todo") > 0)
    )
    body = F.col("body")
    found = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.when(F.array_contains("todo", rule) & may, spans).otherwise(F.array().cast(_EMPTY)).alias("spans"),
            )
            for rule, (may, spans) in _rule_spans(body).items()
        ]
    )
    scanned = new.select("blob", "todo", F.explode(found).alias("f")).where(F.array_contains("todo", F.col("f.rule")))
    scanned = scanned.select("blob", F.col("f.rule").alias("rule"), F.col("f.spans").alias("spans"))
    return scanned.select("blob", "rule", _current(versions).alias("version"), "spans")


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, versions: dict[str, int] = VERSIONS,
    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings by row, new ledger rows).

    Findings: the id, ``assign``, ``access`` and ``hex``, arrays of [start, end)
    in code points, one row for each row of ``docs``. Null text is empty; a row
    without findings has empty arrays; repeated rows and several versions of
    one id are a row each; an empty table gives none. An id column with the name
    of a rule comes back as ``id``. Append the second frame to the ledger to
    make the next run incremental.
    """
    old = ledger if ledger is not None else empty_ledger(docs.sparkSession)
    new = settle(scan_unseen(docs, old, versions, text_col))
    known = old.where(F.col("version") == _current(versions)).select(*new.columns).union(new)
    of = lambda rule: F.coalesce(F.first(F.when(F.col("rule") == rule, F.col("spans")), ignorenulls=True),
        F.array().cast(_EMPTY)).alias(rule)
    # written, so that the join below is one of two plain exchanges, whose large partitions Spark splits
    by_blob = settle(known.where(F.size("spans") > 0).groupBy("blob").agg(*map(of, RULES)))
    paths = docs.select(F.col(id_col).alias("_id"), blob_of(F.col(text_col)).alias("blob"))
    none = F.array().cast(_EMPTY)
    return (
        paths.join(by_blob, "blob", "left").select(F.col("_id").alias("id" if id_col in RULES else id_col), *[F.coalesce(F.col(r), none).alias(r) for r in RULES]),
        new,
    )


def span_text(rules=RULES):
    """kind:start:end of all spans by start, then kind as listed, comma-joined."""

    def tag(kind: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))

    tagged = [F.transform(F.col(r), tag(k)) for k, r in enumerate(rules)]
    names = F.array(*map(F.lit, rules))
    return F.array_join(
        F.transform(
            F.array_sort(F.concat(*tagged)),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
