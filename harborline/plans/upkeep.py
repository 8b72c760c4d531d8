"""Upkeep of an estate: expected assets, sketches by month, edits by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assets, overlay, sketches
from . import workbook  # noqa: F401  (launch_status)
from .base import ORACLE, QUERIES, query, table

_GLOBS = ("'*' || replace(p_name, ' ', '?') || '*' || right(p_brand, 2) || '.xls?'", "'*.example.[cno][oer]*/' || lower(left("
    "p_name, 2)) || '/*'", "p_name || ' ' || p_brand || '.xlsx'", "'*[!0-9]' || p_partkey || '.csv'")


@query(f"""WITH n AS (SELECT p_name || ' ' || p_brand || '.xlsx' AS name FROM part UNION SELECT url FROM pages),
s AS (SELECT p_partkey AS seed, [lower({_GLOBS[0]}), lower({_GLOBS[1]}), lower({_GLOBS[2]}), lower({_GLOBS[3]})][1 + p_partkey % 4]
  AS g FROM part WHERE p_partkey % 5 = 0),
r AS (SELECT seed, '(?s)^' || replace(replace(replace(replace(replace(g, '.', '\\.'), '[!', '[^'), '#', '\\#'), '*', '.*'),
  '?', '.') || '$' AS pattern FROM s),
m AS (SELECT seed, count(DISTINCT name) AS files, min(name) AS first FROM r JOIN n ON regexp_matches(lower(name), pattern)
  GROUP BY seed)
SELECT seed, CASE WHEN files = 1 THEN 'present' WHEN files > 1 THEN 'ambiguous' ELSE 'absent' END AS status,
  coalesce(files, 0) AS files, first FROM s LEFT JOIN m USING (seed)""")
def expected_assets(spark, sf_dir):
    """Files that parts stand for and pages, against what every fifth part expects."""
    p = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", F.concat("p_brand", F.lit(".xlsx")))
    globs = F.array(*[F.expr(g) for g in _GLOBS])
    seeds = p.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("seed"),
        F.array(F.get(globs, (F.col("p_partkey") % 4).cast("int"))).alias("patterns"))
    names = p.select(name.alias("name")).union(table(spark, sf_dir, "pages").select("url"))
    return assets.confirm(seeds, names)


@query("""WITH m AS (SELECT l_returnflag AS flag, year(l_shipdate) * 12 + month(l_shipdate) - 1 AS month, l_partkey,
  l_quantity FROM lineitem)
SELECT e.flag, e.month, count(*) AS rows, true AS median_near, true AS p90_near, true AS items_near
FROM (SELECT DISTINCT flag, month FROM m) e JOIN m ON m.flag = e.flag AND m.month BETWEEN e.month - 11 AND e.month
GROUP BY 1, 2""")
def trailing_sketches(spark, sf_dir):
    """Twelve months of shipments from the months' sketches, held against all their rows: within 3 % of rank, 6 % of items."""
    l = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "flag")
    stored = sketches.monthly(l, ["flag"], "l_shipdate", F.col("l_quantity"), F.col("l_partkey"))
    got = sketches.trailing(stored, ["flag"], 12).select("flag", "month", "rows", *[sketches.quantile(F.col("values"), q)
        .alias(f"q{int(q * 100)}") for q in (0.5, 0.9)], sketches.distinct(F.col("items")).alias("items"))
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1
    each = l.groupBy("flag", month.alias("month"), "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    each = each.withColumn("month", F.explode(F.sequence("month", F.col("month") + 11)))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    near = lambda c, q: (total(F.col("l_quantity") < F.col(c)) / F.sum("n") <= q + 0.03) & (
        total(F.col("l_quantity") <= F.col(c)) / F.sum("n") >= q - 0.03)
    met = each.join(got, ["flag", "month"]).groupBy("flag", "month", "rows", "items").agg((F.sum("n") == F.col("rows"))
        .alias("same"), near("q50", 0.5).alias("median_near"), near("q90", 0.9).alias("p90_near")).where("same")
    steps = sketches.trailing_distinct(l, ["flag"], "l_shipdate", F.col("l_partkey"), 12).select(F.col("flag").alias("_flag"),
        F.col("month").alias("_month"), "step")
    exact = F.coalesce(F.sum("step"), F.lit(0))
    return met.join(steps, (F.col("flag") == F.col("_flag")) & (F.col("_month") <= F.col("month")), "left").groupBy("flag",
        "month", "rows", "median_near", "p90_near", "items").agg((F.abs(F.col("items") - exact) <= 0.06 * exact + 1).alias(
        "items_near")).drop("items")


_EDITS_SQL = """ed AS (SELECT l_partkey + (CASE WHEN l_suppkey % 13 = 0 THEN 10000000 ELSE 0 END) AS key,
  ['status', 'completion', 'price'][1 + l_orderkey % 3] AS col, nullif(trim(CASE l_linenumber
    WHEN 1 THEN ' ' WHEN 2 THEN 'soon' ELSE round(l_discount, 2)::VARCHAR END), '') AS value,
  year(l_shipdate) AS time, 'a' || l_suppkey % 3 AS author FROM lineitem),
ok AS (SELECT * FROM ed WHERE col = 'status' OR col = 'completion' AND (value IS NULL OR try_cast(value AS DOUBLE) IS NOT NULL)),
la AS (SELECT *, row_number() OVER (PARTITION BY key, col ORDER BY time DESC, author DESC, value DESC NULLS LAST) AS k,
  rank() OVER (PARTITION BY key, col ORDER BY time DESC) AS t FROM ok), w AS (SELECT * FROM la WHERE k = 1)"""


def _edited(spark, sf_dir):
    """Line items as edits of launch status by hand: of known and unknown keys and columns, some no numbers."""
    l = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linenumber") == 1, " ").when(F.col("l_linenumber") == 2, "soon").otherwise(
        F.round("l_discount", 2).cast("string"))
    edits = l.select((F.col("l_partkey") + F.when(F.col("l_suppkey") % 13 == 0, 10_000_000).otherwise(0)).alias("key"),
        F.get(F.array(*map(F.lit, ("status", "completion", "price"))), (F.col("l_orderkey") % 3).cast("int")).alias("column"),
        text.alias("value"), F.year("l_shipdate").alias("time"), F.concat(F.lit("a"), F.col("l_suppkey") % 3).alias("author"))
    return overlay.overlay(QUERIES["launch_status"](spark, sf_dir), edits, "sku", ["status", "completion"])


@query(f"""WITH {_EDITS_SQL}, base AS ({ORACLE["launch_status"]})
SELECT sku, name, CASE WHEN s.key IS NULL THEN base.status ELSE s.value END AS status, CASE WHEN c.key IS NULL
  THEN base.completion ELSE c.value::DOUBLE END AS completion, po_qty, s.author AS status_by, c.time AS completion_at,
  CASE WHEN s.key IS NOT NULL THEN base.status END AS status_was
FROM base LEFT JOIN (SELECT * FROM w WHERE col = 'status') s ON s.key = sku
LEFT JOIN (SELECT * FROM w WHERE col = 'completion') c ON c.key = sku""")
def launch_status_edited(spark, sf_dir):
    """Launch status under the edits made to it by hand."""
    out, _ = _edited(spark, sf_dir)
    by = lambda c, f: F.col("origin")[c][f]
    return out.select("sku", "name", "status", "completion", "po_qty", by("status", "author").alias("status_by"),
        by("completion", "time").alias("completion_at"), by("status", "was").alias("status_was"))


@query(f"""WITH {_EDITS_SQL}, x AS (
  SELECT key, col, value, time, author, CASE col WHEN 'completion' THEN 'not a double' ELSE 'unknown column' END AS reason
  FROM ed WHERE NOT (col = 'status' OR col = 'completion' AND (value IS NULL OR try_cast(value AS DOUBLE) IS NOT NULL))
  UNION ALL SELECT key, col, value, time, author, 'unknown key' FROM ok WHERE key NOT IN (SELECT p_partkey FROM part)
  UNION ALL SELECT key, col, value, time, author, 'conflict' FROM la JOIN (SELECT key, col FROM la WHERE t = 1 GROUP BY 1, 2
    HAVING count(DISTINCT coalesce(value, chr(1))) > 1) USING (key, col) WHERE t = 1)
SELECT key, col AS "column", value, time, author, reason, count(*) AS edits FROM x GROUP BY ALL""")
def edit_exceptions(spark, sf_dir):
    """Edits that could not be applied, or that contradict each other."""
    _, lost = _edited(spark, sf_dir)
    return lost.groupBy("key", "column", "value", "time", "author", "reason").agg(F.count(F.lit(1)).alias("edits"))
