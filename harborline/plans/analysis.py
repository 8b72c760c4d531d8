"""Reconciliation of query definitions, lineage and formula patterns over the driver's tables.

The tables hold no query definitions, so profiles, edges and cells are made
from whole tables by rules that the SQL states too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates, estate, graph, reconcile
from .base import query, table

#: A part as a query definition: four of them read one upstream.
_PROFILE_SQL = """
p AS (
  SELECT 'q' || p_partkey AS label, 'w' || (p_partkey % 7) AS workbook, 'x' || (p_partkey // 4) AS upstream,
    CASE p_size % 3 WHEN 0 THEN 'QuoteStyle.None' WHEN 1 THEN 'QuoteStyle.Csv' END AS quote,
    (p_size % 2)::VARCHAR AS cols,
    CASE p_size % 2 WHEN 0 THEN 'Qty' ELSE 'Stock' END AS measure, 'sum([' || split_part(p_name, ' ',
    1) || '])' AS signature,
    CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'SKU' END AS key, CASE p_size % 4 WHEN 0 THEN 'trim'
    WHEN 1 THEN 'trim,upper' ELSE '' END AS norms,
    CASE p_size % 7 WHEN 0 THEN 'Text.Trim( [Item] )' ELSE 'Text.Trim([Item])' END AS expression,
    CASE p_size % 6 WHEN 0 THEN 'SKU' ELSE 'Loc,SKU' END AS grain,
    CASE p_size % 3 WHEN 0 THEN '[Q] <> null' WHEN 1 THEN '[Q]  <>  null' ELSE '[Loc] = 1' END AS filter_,
    p_size % 10 = 5 AS outputs_sku
  FROM part
), pair AS (SELECT l, r FROM p l JOIN p r ON l.upstream = r.upstream AND l.label < r.label)"""

_FINDINGS_SQL = (
    _PROFILE_SQL
    + r""", found AS (
  SELECT l.label AS left_label, r.label AS right_label, 'parse_option' AS kind,
    CASE WHEN coalesce(l.quote = 'QuoteStyle.None', false) OR coalesce(r.quote = 'QuoteStyle.None',
    false) THEN 'blocking' ELSE 'warning' END AS severity,
    'QuoteStyle' AS subject, coalesce(l.quote, '') AS left_value, coalesce(r.quote, '') AS right_value
  FROM pair WHERE l.quote IS DISTINCT FROM r.quote
  UNION ALL SELECT l.label, r.label, 'parse_option', 'warning', 'Columns', l.cols, r.cols FROM pair
  WHERE l.cols <> r.cols
  UNION ALL SELECT l.label, r.label, 'measure_definition', 'blocking', l.measure, l.signature, r.signature FROM pair
  WHERE l.measure = r.measure AND l.signature <> r.signature
  UNION ALL SELECT l.label, r.label, 'measure_name', 'info', l.signature, l.measure, r.measure FROM pair
  WHERE l.measure <> r.measure AND l.signature = r.signature
  UNION ALL SELECT l.label, r.label, 'key_normalization', CASE WHEN l.norms <> r.norms THEN 'blocking'
  ELSE 'warning' END, l.key, l.expression, r.expression
    FROM pair WHERE l.key = r.key AND (l.norms <> r.norms OR l.expression <> r.expression)
  UNION ALL SELECT l.label, r.label, 'key_missing', 'warning', l.key, 'derived', '' FROM pair WHERE l.key IS NOT NULL
  AND r.key IS NULL AND NOT r.outputs_sku
  UNION ALL SELECT l.label, r.label, 'key_missing', 'warning', r.key, '', 'derived' FROM pair WHERE r.key IS NOT NULL
  AND l.key IS NULL AND NOT l.outputs_sku
  UNION ALL SELECT l.label, r.label, 'grain', 'warning', '', l.grain, r.grain FROM pair WHERE l.grain <> r.grain
  UNION ALL SELECT l.label, r.label, 'filter', 'warning', '', regexp_replace(l.filter_, '\s+', ' ', 'g'),
  regexp_replace(r.filter_, '\s+', ' ', 'g')
    FROM pair WHERE regexp_replace(l.filter_, '\s+', ' ', 'g') <> regexp_replace(r.filter_, '\s+', ' ', 'g')
)"""
)


def profiles(spark, sf_dir):
    """The parts as query definitions, in the columns of ``reconcile.PROFILE``."""
    size = F.col("p_size")
    pick = lambda n, *cases: F.get(F.array(*map(F.lit, cases)), F.least(size % n, F.lit(len(cases) - 1)))
    quote = F.when(size % 3 == 0, "QuoteStyle.None").when(size % 3 == 1, "QuoteStyle.Csv")
    options = F.map_filter(F.create_map(F.lit("QuoteStyle"), quote, F.lit("Columns"), (size % 2).cast("string")),
        lambda _, v: v.isNotNull())
    measure = F.struct(pick(2, "Qty", "Stock").alias("name"),
        F.concat(F.lit("sum(["), F.substring_index("p_name", " ", 1), F.lit("])")).alias("signature"))
    norms = F.filter(F.split(pick(4, "trim", "trim,upper", ""), ","), lambda n: n != "")
    key = F.struct(F.lit("SKU").alias("name"), norms.alias("normalizers"),
        pick(7, "Text.Trim( [Item] )", "Text.Trim([Item])").alias("expression"))
    none = F.array().cast("array<string>")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("q"), "p_partkey").alias("label"), F.concat(F.lit("w"), F.col("p_partkey") % 7)
            .alias("workbook"),
        F.concat(F.lit("x"), F.floor(F.col("p_partkey") / 4)).alias("upstream"), options.alias("options"),
            F.array(measure).alias("measures"),
        F.filter(F.array(F.when(size % 5 != 0, key)), lambda k: k.isNotNull()).alias("keys"),
            F.split(pick(6, "SKU", "Loc,SKU"), ",").alias("grain"),
        F.array(pick(3, "[Q] <> null", "[Q]  <>  null", "[Loc] = 1")).alias("filters"),
            F.when(size % 10 == 5, F.array(F.lit("SKU"))).otherwise(none).alias("outputs"),
    )


@query(f"WITH {_FINDINGS_SQL} SELECT * FROM found")
def reconcile_findings(spark, sf_dir):
    return reconcile.findings(profiles(spark, sf_dir))


@query(f"WITH {_PROFILE_SQL} SELECT upstream, count(DISTINCT workbook) AS workbooks, count(*) AS queries FROM p GROUP BY 1 HAVING count(DISTINCT workbook) > 1")
def fork_upstreams(spark, sf_dir):
    return reconcile.forked_upstreams(profiles(spark, sf_dir))


@query(f"WITH {_FINDINGS_SQL} SELECT severity, count(*) AS n FROM found GROUP BY 1 ORDER BY CASE severity WHEN 'blocking' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END")
def finding_severity(spark, sf_dir):
    f = reconcile.findings(profiles(spark, sf_dir)).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return estate.finding_order(f, "severity", "n")


_EDGES_SQL = """e(src, dst) AS (
  SELECT a.n_name, b.n_name FROM nation a JOIN nation b ON b.n_nationkey = (3 * a.n_nationkey + 1) % 25
  UNION SELECT a.n_name, b.n_name FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1
  AND a.n_nationkey % 5 = 0)"""


@query(f"""WITH RECURSIVE {_EDGES_SQL}, p(path, here) AS (
  SELECT [src], dst FROM e
  UNION ALL SELECT list_append(path, here), dst FROM p JOIN e ON here = src WHERE here <> path[1]
  AND NOT list_contains(path, here) AND len(path) < 12)
SELECT DISTINCT array_to_string(list_sort(path), ',') AS nodes FROM p WHERE path[1] = here""")
def lineage_cycles(spark, sf_dir):
    """Nations that read each other by a rule on their keys."""
    n = table(spark, sf_dir, "nation")
    a, b = n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("src")), n.select(F.col("n_nationkey")
        .alias("j"), F.col("n_name").alias("dst"))
    first = a.join(b, F.col("j") == (3 * F.col("k") + 1) % 25)
    more = a.where("k % 5 = 0").join(b, F.col("j") == F.col("k") + 1)
    return graph.cycles(first.union(more).select("src", "dst"))


_REFS_SQL = """r(reader, read) AS (
  SELECT p_partkey, p_partkey // 2 FROM part UNION ALL SELECT p_partkey, p_partkey * 7 % (SELECT count(*) FROM part) FROM part
  WHERE p_size % 10 = 0)"""


def _references(spark, sf_dir):
    """Parts as queries that read the one at half their number, and some another one, in circles too."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("reader"), "p_size", "p_brand")
    n = p.count()
    half = p.select("reader", F.floor(F.col("reader") / 2).alias("read"))
    return p, half.union(p.where("p_size % 10 = 0").select("reader", F.col("reader") * 7 % n))


@query(f"""WITH RECURSIVE {_REFS_SQL}, f(reader, source) AS (
  SELECT p_partkey, p_brand FROM part WHERE p_size < 4
  UNION SELECT r.reader, f.source FROM f JOIN r ON r.read = f.reader)
SELECT reader, source FROM f""")
def inherited_sources(spark, sf_dir):
    """Every external source of a query, its own and those of all that it reads."""
    p, refs = _references(spark, sf_dir)
    facts = p.where("p_size < 4").select("reader", F.col("p_brand").alias("source"))
    return graph.passed_on(refs, facts, "reader", "read", "source")


@query("""WITH RECURSIVE e(src, dst) AS (
  SELECT p_partkey, CASE p_partkey % 7 WHEN 2 THEN p_partkey - 2 WHEN 6 THEN p_partkey - (p_partkey // 7) % 3
    ELSE p_partkey + 1 END FROM part WHERE p_partkey % 7 <> 3 OR p_partkey % 14 = 3),
t(a, b) AS (SELECT src, dst FROM e UNION SELECT t.a, e.dst FROM t JOIN e ON t.b = e.src)
SELECT x.a AS node, min(x.b) AS component FROM t x JOIN t y ON x.a = y.b AND x.b = y.a GROUP BY 1""")
def lineage_components(spark, sf_dir):
    """Parts that replace each other: circles of three, pairs and single ones in chains that join blocks of seven."""
    k = F.col("p_partkey")
    to = F.when(k % 7 == 2, k - 2).when(k % 7 == 6, k - F.floor(k / 7) % 3).otherwise(k + 1)
    edges = table(spark, sf_dir, "part").where((k % 7 != 3) | (k % 14 == 3)).select(k.alias("src"), to.alias("dst"))
    return graph.components(edges)


_STEPS_SQL = """s AS (SELECT p_partkey AS query, unnest(range(1, 2 + p_size % 9)) AS pos FROM part),
t AS (SELECT query, pos, ['rename', 'rename', 'remove', 'rename', 'add'][1 + (query + pos) % 5] AS kind,
  'c' || (query * pos % 6) AS old, 'c' || ((query + 3 * pos) % 7) AS new FROM s)"""


@query(f"""WITH RECURSIVE {_STEPS_SQL}, m AS (
  SELECT p_partkey AS query, 0::BIGINT AS pos, list_transform(range(5), lambda i: {{'n': 'c' || i, 'o': 'c' || i}}) AS st FROM part
  UNION ALL
  SELECT m.query, m.pos + 1, CASE
    WHEN kind = 'rename' AND NOT list_contains(list_transform(st, lambda x: x.n), old) THEN st
    WHEN kind = 'rename' THEN list_transform(list_filter(st, lambda x: x.n <> new OR x.n = old),
      lambda x: {{'n': CASE WHEN x.n = old THEN new ELSE x.n END, 'o': x.o}})
    WHEN kind = 'remove' THEN list_filter(st, lambda x: x.n <> old)
    ELSE list_append(list_filter(st, lambda x: x.n <> new), {{'n': new, 'o': NULL::VARCHAR}}) END
  FROM m JOIN t ON t.query = m.query AND t.pos = m.pos + 1),
l AS (SELECT query, unnest(arg_max(st, pos)) AS x FROM m GROUP BY query)
SELECT query, x.n AS "column", x.o AS original FROM l""")
def replayed_renames(spark, sf_dir):
    """Parts as queries whose steps rename, remove and add columns; names are used again."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("query"), "p_size")
    columns = p.select("query", F.explode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.concat(F.lit("c"), i)))
        .alias("name"))
    pos, q = F.col("pos"), F.col("query")
    kind = F.get(F.array(*map(F.lit, ("rename", "rename", "remove", "rename", "add"))), ((q + pos) % 5).cast("int"))
    steps = p.select("query", F.explode(F.sequence(F.lit(1).cast("long"), 1 + F.col("p_size") % 9)).alias("pos")).select(
        "query", "pos", kind.alias("kind"), F.concat(F.lit("c"), q * pos % 6).alias("old"),
        F.concat(F.lit("c"), (q + 3 * pos) % 7).alias("new"))
    return graph.replayed(columns, steps)


_VERSIONS = ("", " v2", " - Updated - final - copy", "_2024", " Rev 7", " new")
#: Where the same file may lie: two folders, a share, the web; and a name of nothing but version words.
_PLACES = ("dir/{}", "/srv/old/{}", "\\\\host\\share\\{}", "https://host/files/{}?v=1", "dir/final copy.xlsx", "{}")
_FILES_SQL = f"""f AS (
  SELECT 'plan ' || l_suppkey || '.xlsx' AS dst, replace({[*_PLACES]}[1 + (l_partkey + l_linenumber) % 6], '{{}}',
  p_name || {[*_VERSIONS]}[1 + (l_orderkey + l_linenumber) % 6] || '.xlsx') AS src
  FROM lineitem JOIN part ON l_partkey = p_partkey)""".replace("\\\\", "\\")


def file_edges(spark, sf_dir):
    """Line items as files that a supplier's plan reads, in six versions and from six kinds of place."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    version = F.get(F.array(*map(F.lit, _VERSIONS)), ((F.col("l_orderkey") + F.col("l_linenumber")) % 6).cast("int"))
    where = F.get(F.array(*map(F.lit, _PLACES)), ((F.col("l_partkey") + F.col("l_linenumber")) % 6).cast("int"))
    return l.join(p, l["l_partkey"] == p["p_partkey"]).select(
        F.concat(F.lit("plan "), "l_suppkey", F.lit(".xlsx")).alias("dst"),
        F.replace(where, F.lit("{}"), F.concat("p_name", version, F.lit(".xlsx"))).alias("src")
    )


_WORDS = "|".join(text.VERSION_WORDS)


@query(rf"""WITH {_FILES_SQL}, g AS (SELECT DISTINCT dst, string_split(replace(src, '\', '/'), '/')[-1] AS file FROM f
  WHERE src NOT LIKE 'http%' AND (contains(src, '/') OR contains(src, '\'))),
n AS (SELECT dst, file, trim(regexp_replace(regexp_replace(lower(file), '\.[^.]+$', ''), '[^a-z0-9]+', ' ',
  'g')) AS w FROM g),
s AS (SELECT dst AS consumer, replace(regexp_replace(regexp_replace(w, '(^| )({_WORDS})( ({_WORDS}))*$', ''),
  '( [0-9]+)+$', ''), ' ', '') AS stem, file FROM n)
SELECT consumer, stem, count(*) AS files, array_to_string(list_sort(list(file)), '|') AS variants FROM s WHERE stem <> ''
GROUP BY 1, 2 HAVING count(*) > 1""")
def version_skew(spark, sf_dir):
    found = reconcile.version_skew(file_edges(spark, sf_dir))
    return found.select("consumer", "stem", "files", F.array_join("variants", "|").alias("variants"))


@query(r"""WITH files AS (SELECT p_partkey AS pos, 'f' || p_partkey AS file_id, CASE p_size % 3
  WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '_') ELSE p_name END || ' ' || p_brand || '.xlsx' AS name
  FROM part),
e AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN p_name || ' ' || p_brand || '.XLSX'
  WHEN 1 THEN p_name || '-' || p_brand || '.xlsx' ELSE p_name || '.xlsx' END AS src FROM lineitem
  JOIN part ON l_partkey = p_partkey),
a AS (SELECT lower(name) AS k, min_by(file_id, pos) AS f1 FROM files GROUP BY 1),
  b AS (SELECT regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS k, min_by(file_id, pos) AS f2 FROM files GROUP BY 1)
SELECT l_orderkey, l_linenumber, src, coalesce(f1, f2) AS file_id FROM e LEFT JOIN a ON lower(src) = a.k LEFT
  JOIN b ON regexp_replace(lower(src), '[^a-z0-9]', '', 'g') = b.k""")
def resolve_references(spark, sf_dir):
    """Names that line items give a file, against the files that parts stand for."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    full = F.concat_ws(" ", "p_name", "p_brand")
    given = F.when(F.col("p_size") % 3 == 0, F.upper("p_name")).when(F.col("p_size") % 3 == 1,
        F.replace("p_name", F.lit(" "), F.lit("_"))).otherwise(F.col("p_name"))
    files = p.select(F.col("p_partkey").alias("pos"), F.concat(F.lit("f"), "p_partkey").alias("file_id"),
        F.concat(given, F.lit(" "), "p_brand", F.lit(".xlsx")).alias("name"))
    kind = F.col("l_linenumber") % 3
    src = F.when(kind == 0, F.concat(full, F.lit(".XLSX"))).when(kind == 1,
        F.concat("p_name", F.lit("-"), "p_brand", F.lit(".xlsx"))).otherwise(F.concat("p_name", F.lit(".xlsx")))
    edges = l.join(p, l["l_partkey"] == p["p_partkey"]).select("l_orderkey", "l_linenumber", src.alias("src"))
    return reconcile.resolve(edges, files)


#: A line item as a formula cell of its supplier's sheet.
_CELLS_SQL = """c AS (
  SELECT 'book ' || (l_suppkey % 10) AS path, 'S' || l_suppkey AS sheet, 'C' || (l_linenumber % 3) AS col,
  l_orderkey AS row,
    CASE WHEN l_linenumber % 3 = 2 THEN '=1.5' WHEN l_orderkey % 50 = 0 THEN '=IFERROR(INDEX(''Lead Times''!C:C,MATCH(A' || l_orderkey || ',''Lead Times''!$A:$A,0)),N(#REF!A1))'
      WHEN l_orderkey % 50 = 7 AND l_linenumber % 3 = 1 THEN '=B' || l_orderkey || '*T.INV_2T (0.5)'
      ELSE '=SUMIFS(Stock!$D$2:$D$900,Stock!$A$2:$A$900,$A' || l_orderkey || ')' END AS formula FROM lineitem)"""


def formula_cells(spark, sf_dir):
    """Line items as formula cells: three columns a supplier's sheet, one of them constant."""
    key, kind = F.col("l_orderkey"), F.col("l_linenumber") % 3
    text_of = (
        F.when(kind == 2, "=1.5")
        .when(key % 50 == 0, F.concat(F.lit("=IFERROR(INDEX('Lead Times'!C:C,MATCH(A"), key,
            F.lit(",'Lead Times'!$A:$A,0)),N(#REF!A1))")))
        .when((key % 50 == 7) & (kind == 1), F.concat(F.lit("=B"), key, F.lit("*T.INV_2T (0.5)")))
        .otherwise(F.concat(F.lit("=SUMIFS(Stock!$D$2:$D$900,Stock!$A$2:$A$900,$A"), key, F.lit(")")))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("book "), F.col("l_suppkey") % 10).alias("path"),
            F.concat(F.lit("S"), "l_suppkey").alias("sheet"),
        F.concat(F.lit("C"), kind).alias("col"), key.alias("row"), text_of.alias("formula"),
    )


def _map_sql(least_formulas: int, least_cells: int) -> str:
    return rf"""WITH {_CELLS_SQL}, g AS (
  SELECT path, sheet, col, regexp_replace(formula, '(\$?[A-Z]{{1,3}})\$?(\d+)', '\1{{r}}', 'g') AS pattern, row,
  count(*) OVER (PARTITION BY path, sheet) AS many FROM c
), n AS (SELECT path, sheet, col, pattern, count(*) AS n, min(row) AS first_row FROM g WHERE many >= {least_formulas}
  GROUP BY ALL),
t AS (SELECT *, sum(n) OVER w AS cells, count(*) OVER w AS patterns, row_number() OVER (PARTITION BY path, sheet, col
  ORDER BY n DESC, first_row, pattern) AS place FROM n WINDOW w AS (PARTITION BY path, sheet, col))
SELECT path, sheet, col, pattern, cells, patterns, n / cells AS share, cells >= {least_cells} AND n / cells < 0.98
  AND pattern <> '=1.5' AS suspicious FROM t WHERE place = 1"""


@query(_map_sql(100, 20))
def formula_map(spark, sf_dir):
    return estate.formula_map(formula_cells(spark, sf_dir))


@query(_map_sql(0, 5))
def formula_patterns(spark, sf_dir):
    """Dominant pattern of each column; suspicious if large, inconsistent and not constant."""
    cells = formula_cells(spark, sf_dir).withColumn("pattern", text.formula_pattern(F.col("formula")))
    top = aggregates.dominant(cells, ["path", "sheet", "col"], "pattern", "row")
    odd = (F.col("cells") >= 5) & (F.col("share") < 0.98) & ~text.is_literal(F.col("pattern"))
    return top.withColumn("suspicious", odd)


_ALL = "array_to_string(list_sort(list_distinct({})), ',')"


@query(rf"""WITH {_CELLS_SQL} SELECT formula, count(*) AS cells,
  {_ALL.format(r"regexp_extract_all(formula, '\b([A-Z][A-Z0-9._]+)\s*\(', 1)")} AS functions,
{_ALL.format(r"list_transform(regexp_extract_all(replace(formula, '#REF!', ''), '(''[^'']+''|[A-Za-z_][A-Za-z0-9_.]*)!', 1), lambda x: trim(x, ''''))")} AS sheets,
{_ALL.format(r"regexp_extract_all(formula, '\$?[A-Z]{1,3}:\$?[A-Z]{1,3}\b')")} AS columns,
  {_ALL.format(r"regexp_extract_all(formula, '#(?:REF!|NAME\?|VALUE!|DIV/0!|NULL!|NUM!)')")} AS errors
FROM c GROUP BY formula""")
def formula_parts(spark, sf_dir):
    """What each distinct formula calls and refers to."""
    f = F.col("formula")
    parts = {"functions": text.formula_functions(f), "sheets": text.formula_sheets(f),
        "columns": text.formula_columns(f), "errors": text.formula_errors(f)}
    distinct = formula_cells(spark, sf_dir).groupBy("formula").agg(F.count(F.lit(1)).alias("cells"))
    return distinct.select("formula", "cells", *[F.array_join(c, ",").alias(n) for n, c in parts.items()])
