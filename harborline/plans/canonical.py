"""Scalars, entities, joins and gates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..functions.dates import days_late, year_month
from ..operators import entities, gates, joins, reshape
from ..operators.aggregates import exact_total
from .base import query, table

#: Locations: nations stand for them. Two of the 25 are left out to be unknown.
_DIM_SQL = """dim AS (SELECT n_name AS location_id, r_name AS regional_id,
  CASE n_nationkey % 4 WHEN 0 THEN 'consigned' WHEN 1 THEN 'company' WHEN 2 THEN 'vendor'
  ELSE 'other' END AS supply_side
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 23)"""


def locations(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    side = F.when(F.col("n_nationkey") % 4 == 0, "consigned").when(F.col("n_nationkey") % 4 == 1,
        "company").when(F.col("n_nationkey") % 4 == 2, "vendor").otherwise("other")
    return n.where("n_nationkey < 23").join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_name").alias("location_id"), F.col("r_name").alias("regional_id"), side.alias("supply_side")
    )


def inventory_export(spark, sf_dir):
    """Line items as stock rows: item "brand : name ", location by the supplier's nation."""
    l, p, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation"))
    qty = F.when(F.col("l_linenumber") == 4, None).otherwise(F.col("l_quantity").cast("long"))
    return (
        l.join(p, l["l_partkey"] == p["p_partkey"]).join(s, l["l_suppkey"] == s["s_suppkey"])
            .join(n, s["s_nationkey"] == n["n_nationkey"])
        .select(
            F.concat("p_brand", F.lit(" : "), F.lower("p_name"), F.lit(" ")).alias("item"),
                F.col("n_name").alias("location_id"),
            qty.alias("on_hand"), (qty - F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long"))
                .otherwise(0)).alias("available"),
            F.col("p_retailprice").alias("average_cost"), F.col("p_size").alias("lead_time"),
                F.when(F.col("l_linenumber") % 2 == 1, F.col("p_type")).alias("description"),
            (F.col("l_orderkey") * 10_000_000 + F.col("l_partkey")).alias("row_id"),
        )
    )


_EXPORT_SQL = """export AS (SELECT p_brand || ' : ' || lower(p_name) || ' ' AS item, n_name AS location_id,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity::BIGINT END AS on_hand,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity::BIGINT END - CASE
  WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END AS available,
  p_retailprice AS average_cost, p_size AS lead_time,
  CASE WHEN l_linenumber % 2 = 1 THEN p_type END AS description, l_orderkey * 10000000 + l_partkey AS row_id
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""
_SKU_SQL = "nullif(upper(regexp_replace(trim(split_part(item, ':', -1)), '\\s+', ' ', 'g')), '')"
_ONHAND_SQL = f"""onhand AS (SELECT {_SKU_SQL} AS sku, location_id, sum(on_hand)::BIGINT AS on_hand,
  sum(available)::BIGINT AS available,
  max(average_cost) AS average_cost, avg(lead_time) AS lead_time,
  arg_min(description, row_id) FILTER (description IS NOT NULL) AS description,
  count(*) AS source_rows
  FROM export GROUP BY 1, 2)"""


@query(f"""WITH {_DIM_SQL}, {_EXPORT_SQL}, {_ONHAND_SQL}
SELECT sku, location_id, on_hand, available, average_cost, round(lead_time, 6) AS lead_time, description, source_rows,
  regional_id, supply_side,
  CASE supply_side WHEN 'consigned' THEN 'consigned' WHEN 'company' THEN 'company_paid'
  WHEN 'vendor' THEN 'vendor_owned' END AS ownership
FROM onhand LEFT JOIN dim USING (location_id)""")
def inventory_onhand(spark, sf_dir):
    built = entities.inventory_onhand(inventory_export(spark, sf_dir), locations(spark, sf_dir)).frame
    return built.withColumn("lead_time", F.round("lead_time", 6))


@query("""SELECT p_partkey, nullif(upper(regexp_replace(trim(split_part(p_brand || ' : ' || p_name || ' ', ':', -1)),
  '\\s+', ' ', 'g')), '') AS sku FROM part""")
def canonical_sku(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.canonical_sku(F.concat("p_brand", F.lit(" : "),
        "p_name", F.lit(" "))).alias("sku"))


@query("""SELECT p_partkey, substr(x, strpos(x, ':') + 1) AS first_tail, split_part(x, ' : ', -1) AS last_tail
FROM (SELECT p_partkey, p_brand || ' : ' || p_type || ' : ' || p_name AS x FROM part)""")
def after_first_delimiter(spark, sf_dir):
    x = F.concat_ws(" : ", "p_brand", "p_type", "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.after_first(x, ":").alias("first_tail"),
        text.after_last(x, " : ").alias("last_tail"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity + 1000 END AS parsed,
  CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_returnflag = 'A' THEN NULL
  ELSE l_quantity + 1000 END::BIGINT AS whole FROM lineitem""")
def numeric_coerce(spark, sf_dir):
    q = F.col("l_quantity").cast("long").cast("string")
    raw = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), q, F.lit(")"))).when(F.col("l_returnflag") == "A",
        F.concat(q, F.lit("d"))).otherwise(
        F.concat(F.lit(" 1,"), F.lpad(q, 3, "0"), F.lit("\t"))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.parse_number(raw).alias("parsed"), numbers.parse_whole(raw).alias("whole"))


@query("""SELECT 'l_quantity' AS column_name, count(*) FILTER (l_returnflag = 'A') AS lost FROM lineitem""")
def coercion_report(spark, sf_dir):
    raw = F.when(F.col("l_returnflag") == "A", F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    lost = raw.isNotNull() & numbers.parse_number(raw).isNull()
    return table(spark, sf_dir, "lineitem").agg(F.count_if(lost).alias("lost")).select(F.lit("l_quantity")
        .alias("column_name"), "lost")


@query(f"""WITH {_DIM_SQL} SELECT s_suppkey, n_name AS location_id, regional_id, supply_side
FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN dim ON n_name = location_id""")
def location_dimension_join(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    facts = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("s_suppkey", F.col("n_name").alias("location_id"))
    return joins.many_to_one(facts, locations(spark, sf_dir), "location_id")


@query(f"""WITH {_DIM_SQL} SELECT DISTINCT n_name AS location_id FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name NOT IN (SELECT location_id FROM dim)""")
def unknown_locations(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    facts = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("location_id"))
    return joins.unknown_members(facts, locations(spark, sf_dir), "location_id")


def po_export(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    got = F.when(F.col("l_returnflag") == "A", F.col("l_quantity") + 2).when(F.col("l_returnflag") == "R",
        F.col("l_quantity") - 1)
    left = F.when(F.col("l_linenumber") == 3, F.col("l_quantity")).otherwise(numbers.floor_zero(F.col(
        "l_quantity") - F.coalesce(got, F.lit(0))))
    closed = F.when(F.col("l_linestatus") == "F", " Yes ").when(F.col("l_returnflag") == "R", "No")
    return l.select(
        F.col("l_orderkey").alias("po_number"), F.col("l_linenumber").alias("po_line"),
            F.concat(F.lit("P : "), F.col("l_partkey").cast("string")).alias("item"),
        F.col("l_quantity").cast("long").alias("ordered"), got.cast("long").alias("received"),
            left.cast("long").alias("remaining"), closed.alias("closed"),
    )


_PO_SQL = """po0 AS (SELECT l_orderkey AS po_number, l_linenumber AS po_line, l_partkey::VARCHAR AS sku,
  l_quantity::BIGINT AS ordered,
  coalesce(CASE l_returnflag WHEN 'A' THEN l_quantity + 2 WHEN 'R' THEN l_quantity - 1 END, 0)::BIGINT AS received,
  l_linenumber, l_linestatus = 'F' AS is_closed FROM lineitem),
po AS (SELECT po_number, po_line, sku, ordered, received, CASE WHEN ordered - received < 0 THEN 0
  ELSE ordered - received END AS qty_remaining,
  CASE WHEN l_linenumber = 3 THEN ordered WHEN ordered - received < 0 THEN 0
  ELSE ordered - received END AS stated_remaining, is_closed FROM po0)"""
_CONFLICT_SQL = """conflict AS (SELECT 'open_po:remaining:' || po_number || '|' || po_line AS exception_id,
  'remaining_mismatch' AS gate, 'warning' AS severity,
  qty_remaining::VARCHAR AS left_value, stated_remaining::VARCHAR AS right_value,
  (qty_remaining - stated_remaining)::DOUBLE AS delta
  FROM po WHERE qty_remaining <> stated_remaining)"""


@query(f"WITH {_PO_SQL} SELECT * FROM po")
def open_po(spark, sf_dir):
    return entities.open_po(po_export(spark, sf_dir)).frame


@query(f"WITH {_PO_SQL}, {_CONFLICT_SQL} SELECT * FROM conflict")
def po_conflicts(spark, sf_dir):
    return entities.open_po(po_export(spark, sf_dir)).conflicts


@query(f"""WITH {_PO_SQL}, {_CONFLICT_SQL}, dup AS (SELECT count(*) AS n FROM po GROUP BY po_number, po_line)
SELECT exception_id, gate, severity, NULL::BIGINT AS failed, NULL::BIGINT AS checked, left_value, right_value, delta
  FROM conflict
UNION ALL SELECT 'open_po:open_po:unique_grain', 'unique_grain', 'blocking', sum(n) FILTER (n > 1)::BIGINT,
  sum(n)::BIGINT, NULL, NULL, NULL FROM dup HAVING sum(n) FILTER (n > 1) > 0""")
def exceptions_union(spark, sf_dir):
    return entities.open_po(po_export(spark, sf_dir)).exceptions().drop("passed", "message")


def wide_allocation(spark, sf_dir):
    """One row a part with a quantity column for each return flag, one of them often null."""
    l = table(spark, sf_dir, "lineitem")
    qty = lambda f: F.sum(F.when((F.col("l_returnflag") == f) & (F.col("l_linenumber") <= 2),
        F.col("l_quantity").cast("long"))).alias(f)
    return l.groupBy("l_partkey").agg(*map(qty, "ANR"))


_WIDE_SQL = """wide AS (SELECT l_partkey, sum(l_quantity::BIGINT) FILTER (l_returnflag = 'A'
  AND l_linenumber <= 2)::BIGINT AS A, sum(l_quantity::BIGINT) FILTER (l_returnflag = 'N'
  AND l_linenumber <= 2)::BIGINT AS N,
  sum(l_quantity::BIGINT) FILTER (l_returnflag = 'R' AND l_linenumber <= 2)::BIGINT AS R FROM lineitem GROUP BY 1)"""
_LONG_SQL = "long AS (SELECT l_partkey, 'A' AS c, A AS q FROM wide UNION ALL SELECT l_partkey, 'N', N FROM wide UNION ALL SELECT l_partkey, 'R', R FROM wide)"


@query(f"""WITH {_WIDE_SQL}, {_LONG_SQL} SELECT 'PART ' || l_partkey AS sku, CASE c WHEN 'A' THEN 'americas'
  WHEN 'R' THEN 'retail' END AS region_channel,
  coalesce(q, 0) AS qty_allocated, 'launch_control' AS basis FROM long WHERE c <> 'N'""")
def allocation_unpivot(spark, sf_dir):
    wide = wide_allocation(spark, sf_dir).withColumn("name", F.concat(F.lit("parent : part "),
        F.col("l_partkey").cast("string")))
    return entities.allocation(wide, {"A": "americas", "R": "retail"}).frame


@query(f"WITH {_WIDE_SQL}, {_LONG_SQL} SELECT l_partkey, c AS channel, q AS qty FROM long WHERE q IS NOT NULL")
def unpivot_drop_nulls(spark, sf_dir):
    return reshape.unpivot_others(wide_allocation(spark, sf_dir), ["l_partkey"], "channel", "qty")


_VERDICT = ["gate", "severity", "failed", "checked", "passed"]


@query("""WITH d AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT 'unique_grain' AS gate, 'blocking' AS severity, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS failed,
  sum(n)::BIGINT AS checked, coalesce(sum(n) FILTER (n > 1), 0) = 0 AS passed FROM d""")
def gate_unique_grain(spark, sf_dir):
    return gates.unique_grain(table(spark, sf_dir, "lineitem"), "lines", "line",
        ["l_orderkey", "l_linenumber"]).select(*_VERDICT)


@query("""SELECT 'no_null_keys:key' AS gate, 'blocking' AS severity, count(*) FILTER (l_returnflag = 'A') AS failed,
  count(*) AS checked, count(*) FILTER (l_returnflag = 'A') = 0 AS passed FROM lineitem
UNION ALL SELECT 'no_null_keys:absent', 'blocking', count(*), count(*), count(*) = 0 FROM lineitem""")
def gate_null_keys(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("key"))
    return gates.evaluate(df, "lines", "line", gates.no_null_keys(df, ["key", "absent"])).select(*_VERDICT)


@query(f"""WITH {_DIM_SQL} SELECT 'known_members:location_id' AS gate, 'blocking' AS severity,
  count(*) FILTER (regional_id IS NULL) AS failed, count(*) AS checked,
  count(*) FILTER (regional_id IS NULL) <= 0.02 * count(*) AS passed FROM supplier
  JOIN nation ON s_nationkey = n_nationkey LEFT JOIN dim ON n_name = location_id""")
def gate_known_locations(spark, sf_dir):
    df = location_dimension_join(spark, sf_dir)
    return gates.evaluate(df, "suppliers", "supplier", [gates.known_members(df, "location_id",
        "regional_id")]).select(*_VERDICT)


@query("""SELECT 'non_negative:c_acctbal' AS gate, 'warning' AS severity, count(*) FILTER (c_acctbal < 0) AS failed,
  count(c_acctbal) AS checked, count(*) FILTER (c_acctbal < 0) = 0 AS passed FROM customer""")
def gate_non_negative(spark, sf_dir):
    return gates.evaluate(table(spark, sf_dir, "customer"), "customers", "customer",
        gates.non_negative(["c_acctbal"])).select(*_VERDICT)


@query("""SELECT 'min_rows' AS gate, 'blocking' AS severity, 0::BIGINT AS failed, count(*) AS checked, true AS passed
  FROM region
UNION ALL SELECT 'min_rows', 'blocking', 1, 0, false""")
def gate_min_rows(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    full, empty = (gates.evaluate(f, "regions", "region", [gates.min_rows()]) for f in (r, r.where("r_regionkey < 0")))
    return full.union(empty).select(*_VERDICT)


@query("""WITH w AS (SELECT p_partkey AS sku, p_partkey + 1 AS mapped FROM part WHERE p_size = 1),
  k AS (SELECT p_partkey AS sku FROM part WHERE p_size > 2),
n AS (SELECT l_partkey AS sku, count(*) AS n_rows FROM lineitem GROUP BY 1)
SELECT n.sku, n_rows FROM n LEFT JOIN w USING (sku) WHERE coalesce(mapped, n.sku) NOT IN (SELECT sku FROM k)""")
def gate_orphan_sku(spark, sf_dir):
    """Small parts are no items; those of size 1 have the next part's name in the crosswalk."""
    part = table(spark, sf_dir, "part")
    known = part.where("p_size > 2").select(F.col("p_partkey").alias("sku"))
    crosswalk = part.where("p_size = 1").select(F.col("p_partkey").alias("sku"),
        (F.col("p_partkey") + 1).alias("mapped"))
    return gates.orphans(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sku")), known, "sku",
        crosswalk)


@query("""SELECT event_type AS source, max(ts)::DATE AS data_as_of, date_diff('day', max(ts)::DATE,
  DATE '2024-02-15')::INTEGER AS age_days,
  date_diff('day', max(ts)::DATE, DATE '2024-02-15') > 7 AS stale FROM events GROUP BY 1""")
def gate_stale_snapshot(spark, sf_dir, as_of: str = "2024-02-15", most_days: int = 7):
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "source")
    return gates.stale(e, "source", "ts", F.lit(as_of), most_days)


@query("""SELECT l_partkey AS sku, count(DISTINCT u) AS units, count(*) FILTER (u IS NULL) AS undeclared
  FROM (SELECT l_partkey, CASE WHEN l_linenumber = 7 THEN 'CS' WHEN l_orderkey % 97 <> 0 THEN 'EA' END AS u
  FROM lineitem)
GROUP BY 1 HAVING count(DISTINCT u) > 1 OR count(*) FILTER (u IS NULL) > 0""")
def gate_uom_mismatch(spark, sf_dir):
    uom = F.when(F.col("l_linenumber") == 7, " cs").when(F.col("l_orderkey") % 97 != 0,
        F.when(F.col("l_linenumber") == 1, "ea").otherwise("EA "))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sku"), "l_quantity", uom.alias("uom"))
    return gates.unit_mismatches(lines, "sku", "uom", ["l_quantity"])


@query("""SELECT l_partkey AS sku, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0)::BIGINT AS allocated,
  coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0)::BIGINT
  + coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0)::BIGINT AS supply FROM lineitem GROUP BY 1
HAVING coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) > coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'),
  0) + coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0)""")
def gate_allocation_over_supply(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("long").alias("q"), "l_returnflag", "l_linestatus")
    return gates.over_allocated(l.where("l_returnflag = 'R'"),
        [(l.where("l_returnflag = 'A'"), "q"), (l.where("l_linestatus = 'O'"), "q")], "sku", "q")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'A'
  AND l_linestatus <> 'O'""")
def gate_in_transit_complete(spark, sf_dir):
    """Lines as shipments: a container where the flag is A, an arrival where the status is O."""
    l = table(spark, sf_dir, "lineitem")
    container = F.when(F.col("l_returnflag") == "A", "C1").when(F.col("l_returnflag") == "N", " ")
    lines = l.withColumn("container", container).withColumn("eta",
        F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")))
    return gates.incomplete_transit(lines).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority LIKE '3%' THEN NULL ELSE 'USD' END AS currency
  FROM orders WHERE o_orderpriority LIKE '3%' AND o_totalprice IS NOT NULL""")
def gate_currency_undeclared(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("currency",
        F.when(~F.col("o_orderpriority").startswith("3"), F.lit("USD")))
    return gates.undeclared_money(o, ["o_totalprice"], "currency").select("o_orderkey", "o_totalprice", "currency")


@query(f"""WITH {_PO_SQL}, {_CONFLICT_SQL} SELECT gate, count(*) AS open_conflicts FROM conflict
  WHERE gate NOT IN ('settled_rule') GROUP BY 1""")
def gate_unresolved_conflict(spark, sf_dir):
    rules = spark.createDataFrame([("settled_rule",)], "gate string")  # a precedence names its winner
    return gates.unresolved(po_conflicts(spark, sf_dir), rules).groupBy("gate").agg(F.count(F.lit(1))
        .alias("open_conflicts"))


@query("""WITH a AS (SELECT l_partkey AS sku, sum(l_quantity) FILTER (l_returnflag = 'R') AS x,
  coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS y FROM lineitem GROUP BY 1)
SELECT 'allocation_over_supply' AS gate, 'blocking' AS severity, count(*) FILTER (x > y) AS failed, count(x) AS checked,
  count(*) FILTER (x > y) = 0 AS passed FROM a""")
def gate_cross_entity(spark, sf_dir):
    """The gates over several entities, as extract runs them."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("long").alias("q"), "l_returnflag")
    given = entities.EntityBuild(l.where("l_returnflag = 'R'").select("sku", F.col("q").alias("qty_allocated")),
        ["sku"])
    held = entities.EntityBuild(l.where("l_returnflag = 'A'").select("sku", F.col("q").alias("on_hand")), ["sku"])
    return entities.cross_checks({"allocation": given, "inventory": held}).select(*_VERDICT)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN greatest(date_diff('day', o_orderdate::DATE,
  DATE '1998-01-01'), 0)::INTEGER END AS days_late,
  (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS yyyymm FROM orders""")
def days_late_open(spark, sf_dir):
    remaining = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return table(spark, sf_dir, "orders").select("o_orderkey",
        days_late(F.col("o_orderdate"), remaining, "1998-01-01").alias("days_late"),
            year_month(F.col("o_orderdate")).alias("yyyymm"))


@query("""SELECT c_mktsegment, r_name, count(*) AS customers, sum(c_acctbal::DECIMAL(18,4))::DOUBLE AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ROLLUP (c_mktsegment, r_name)""")
def rollup_convenience(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    both = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return both.rollup("c_mktsegment", "r_name").agg(F.count(F.lit(1)).alias("customers"),
        exact_total(F.col("c_acctbal")).alias("balance"))
