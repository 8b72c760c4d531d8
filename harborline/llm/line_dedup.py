"""Line dedup: lines that very many documents share are dropped everywhere.

Only native expressions. Lines are hashed where they are read; what is
shuffled for counting is 128-bit hashes, not text. The most frequent common
lines, of which there can't be more than ``HOT``, meet their copies without a
shuffle; all others are joined by hash. Text moves once, when each document
meets the flags of its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, settle, whole_row, wide_hash

#: A line with over one in this many of all lines is flagged by broadcast; there are fewer of those than this.
HOT = 1 << 14


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def flag_frequent(lines: DataFrame, common: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """(``lines`` with ``hot``, true on copies of frequent common lines; the other common lines).

    ``common`` (h1, h2, rows, hit). A frequent line has over one in ``HOT`` of
    all ``total`` lines, so there are fewer than ``HOT``. A flagged line needs
    no partner any more: it is spread by its place instead of its hash.
    """
    frequent = F.col("rows") * HOT > total
    hot = common.where(frequent).select("h1", "h2", F.lit(True).alias("hot"))
    own = F.when(F.col("hot"), F.xxhash64("id", "pos")).otherwise(F.col("h1"))
    return lines.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("h1",
        own), common.where(~frequent).drop("rows")


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc, kept_text, n_lines, n_dropped): each row of ``docs`` with its rest.

    ``doc`` is the whole input row as a struct. A line's key is the line
    without blanks at its ends, A-Z lower-cased. A key of ``min_chars`` code
    points or more found in ``min_docs`` distinct documents or more loses all
    its lines. Null or empty text is one empty line; a document that loses
    every line keeps "". Rows with one id count as one document; rows with a
    null id count together as one. Repeated rows are returned as often as they
    came. An empty table gives an empty table.
    """
    doc = docs.select(whole_row(docs).alias("doc"))
    text, key_id = F.col(f"doc.{text_col}"), F.col(f"doc.{id_col}")
    trimmed = F.transform(_lines(text), lambda x: F.btrim(x, F.lit(BLANKS)))
    keys = F.transform(trimmed, ascii_lower)
    h1, h2 = F.xxhash64, wide_hash
    hashed = F.transform(
        keys,
        lambda k: F.struct(
            h1(k).alias("h1"), h2(k)[1].alias("h2"), (F.length(k) >= min_chars).alias("may")
        ),
    )
    lines = settle(
        doc.select(key_id.alias("id"), F.xxhash64(text).alias("body"), F.posexplode(hashed))
        .select("id", "body", "pos", "col.h1", "col.h2", "col.may")
    )
    total = lines.count()
    common = settle(
        lines.where("may")
        .groupBy("h1", "h2")
        .agg(F.countDistinct(F.struct("id")).alias("n"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "rows", F.lit(True).alias("hit"))
    )
    spread, rest = flag_frequent(lines, common, total)
    flags = (
        spread.join(rest, ["h1", "h2"], "left")
        .withColumn("hit", F.coalesce("hot", "hit"))
        .select("id", "body", "pos", F.coalesce(F.col("hit") & F.col("may"), F.lit(False)).alias("hit"))
        .groupBy("id", "body")
        .agg(F.array_sort(F.collect_set(F.struct("pos", "hit"))).alias("at"))
        .select("id", "body", F.transform("at", lambda x: x["hit"]).alias("gone"))
    )
    met = doc.withColumn("body", F.xxhash64(text)).alias("l").join(
        flags.alias("r"),
        key_id.eqNullSafe(F.col("r.id")) & (F.col("l.body") == F.col("r.body")),
    )
    gone = F.col("r.gone")
    kept = F.filter(_lines(text), lambda _, i: ~F.get(gone, i))
    return met.select(
        F.col("l.doc").alias("doc"),
        F.array_join(kept, "\n").alias("kept_text"),
        F.size(gone).cast("long").alias("n_lines"),
        F.size(F.filter(gone, lambda x: x)).cast("long").alias("n_dropped"),
    )
