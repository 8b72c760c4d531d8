"""The named queries and sheets of ``operators.workbook`` over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import joins, workbook
from .base import query, table

_GROUPS = {"FRANCE": "EMEA", "NATION_3": "Americas", "NATION_5": "AP", "NATION_7": "B2C"}
_LEADS = {"A": "Americas", "R": "Retail"}
_SUBS = {"NATION_1": "East", "NATION_2": "West", "NATION_4": "East"}
MONTHS = [f"Forecast QTY {m:02d}-{y}" for y in (1995, 1996, 1997) for m in range(1, 13)]


def forecast_export(spark, sf_dir):
    """36 month columns by item, category, territory, sub location and lead group, from line items of three years."""
    l, p, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation"))
    rows = l.where("l_shipdate >= '1995-01-01' and l_shipdate < '1998-01-01'").join(p,
        l["l_partkey"] == p["p_partkey"]).join(s, l["l_suppkey"] == s["s_suppkey"])
    rows = rows.join(n, rows["s_nationkey"] == n["n_nationkey"])
    month, q = F.date_format("l_shipdate", "MM-yyyy"), F.col("l_quantity").cast("long")
    sums = [F.sum(F.when(month == c[-7:], F.when(F.col("l_linenumber") == 2, -q).otherwise(q))).alias(c)
        for c in MONTHS]
    ids = [F.concat("p_brand", F.lit(" : "), "p_name").alias("item"), F.col("p_type").alias("category"),
        F.col("n_name").alias("territory"), F.col("n_name").alias("sub_location")]
    return rows.groupBy(*ids, F.col("l_returnflag").alias("lead_group")).agg(*sums)


_IDS = ["item", "category", "territory", "sub_location", "lead_group"]
_FORECAST_SQL = """f AS (
  SELECT p_brand || ' : ' || p_name AS item, p_type AS category, n_name AS territory, n_name AS sub_location,
  l_returnflag AS lead_group, date_trunc('month', l_shipdate)::DATE AS month,
    sum(CASE WHEN l_linenumber = 2 THEN -l_quantity ELSE l_quantity END)::BIGINT AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  WHERE l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '1998-01-01' GROUP BY ALL)"""


def _case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


@query(f"""WITH {_FORECAST_SQL} SELECT item, coalesce({_case("territory", _GROUPS)},
  {_case("lead_group", _LEADS)}) AS allocation_group, month, category, sum(qty)::BIGINT AS forecast_qty
FROM f GROUP BY ALL HAVING sum(qty) <> 0""")
def forecast_by_group(spark, sf_dir):
    return workbook.grouped_forecast(workbook.month_rows(forecast_export(spark, sf_dir), _IDS, MONTHS), _GROUPS, _LEADS)


@query(f"""WITH {_FORECAST_SQL} SELECT upper(trim(split_part(item, ':', -1))) AS sku, sub_location, category,
  lead_group, territory, coalesce({_case("lead_group", _LEADS)}, {_case("sub_location", _SUBS)}) AS region,
  year(month)::INTEGER AS year, (year(month) * 100 + month(month))::INTEGER AS yyyymm, sum(qty)::BIGINT AS forecast_qty
  FROM f GROUP BY sku, sub_location, category, lead_group, territory, region, f.month HAVING sum(qty) <> 0""")
def forecast_full(spark, sf_dir):
    return workbook.full_forecast(workbook.month_rows(forecast_export(spark, sf_dir), _IDS, MONTHS), _LEADS, _SUBS)


@query(f"""SELECT ' ' || p_name AS sku, n_name AS location, sum(l_quantity)::BIGINT AS available,
  {_case("n_name", _SUBS)} AS region
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY p_brand, p_name, n_name""")
def regional_inventory(spark, sf_dir):
    l, p, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation"))
    rows = l.join(p, l["l_partkey"] == p["p_partkey"]).join(s, l["l_suppkey"] == s["s_suppkey"]).join(n,
        F.col("s_nationkey") == n["n_nationkey"])
    stock = rows.select(F.concat("p_brand", F.lit(" : "), "p_name").alias("name"), F.col("n_name").alias("location"),
        F.col("l_quantity").cast("long").alias("available"))
    return workbook.regional_inventory(stock, _SUBS)


@query("""SELECT event_id AS line, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS po, event_type AS sku,
  ts::DATE AS date, CASE WHEN event_id % 7 = 0 THEN -(user_id + 1000)::BIGINT ELSE (user_id + 1000)::BIGINT END AS qty,
  props AS status FROM events""")
def production_rows(spark, sf_dir):
    """Events as a production sheet of text cells, cast by type; what isn't a number is null."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    amount = F.format_number(F.col("user_id") + 1000, 0)
    sheet = e.select(
        k.cast("string").alias("line"), F.when(k % 5 == 0, "n/a").otherwise(F.concat(F.lit(" "), "user_id"))
            .alias("po"), F.concat("event_type", F.lit(" ")).alias("sku"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(k % 7 == 0, F.concat(F.lit("("), amount, F.lit(")")))
            .otherwise(amount).alias("qty"), F.col("props").alias("status"),
    )
    return workbook.casts(sheet, {"line": "whole", "po": "whole", "sku": "string", "date": "date", "qty": "whole"})


@query("""SELECT n_name AS location, (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS yyyymm,
  p_brand || ': ' || p_name AS name, year(o_orderdate)::INTEGER AS year, sum(l_quantity)::BIGINT AS qty, p_name AS sku
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE year(o_orderdate) IN (1996, 1997) AND n_name NOT IN ('NATION_1', 'NATION_2', 'NATION_3') GROUP BY n_name, yyyymm,
  year, p_brand, p_name""")
def validated_sales_full(spark, sf_dir):
    l, p, o, c, n = (table(spark, sf_dir, t) for t in ("lineitem", "part", "orders", "customer", "nation"))
    rows = l.join(p, l["l_partkey"] == p["p_partkey"]).join(o, l["l_orderkey"] == o["o_orderkey"]).join(c,
        o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"])
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    rows = rows.select(
        F.col("n_name").alias("location"), (year * 100 + month).alias("yyyymm"),
            F.concat("p_brand", F.lit(": "), "p_name").alias("name"), year.alias("year"),
                F.col("l_quantity").cast("long").alias("qty")
    )
    return workbook.validated_sales(rows, [1996, 1997], ["NATION_1", "NATION_2", "NATION_3"])


@query("""SELECT c_name AS company, o_orderpriority AS sales_rep, l_partkey AS item, round(avg(l_extendedprice),
  6) AS mean_rate, sum((l_extendedprice * l_discount)::DECIMAL(38,4))::DOUBLE AS discounted,
  sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END::DECIMAL(38,4))::DOUBLE AS committed, sum(CASE
  WHEN l_linestatus = 'F' THEN l_extendedprice END::DECIMAL(38,4))::DOUBLE AS ready,
  sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END::DECIMAL(38,4))::DOUBLE AS back_order FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def open_orders_by_rep(spark, sf_dir):
    l, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    rows = l.join(o, l["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("c_name").alias("company"), F.col("o_orderpriority").alias("sales_rep"), F.col("l_partkey").alias("item"),
            price.alias("rate"), (price * F.col("l_discount")).alias("discounted"),
        F.when(F.col("l_returnflag") == "N", q).alias("committed"),
            F.when(F.col("l_linestatus") == "F", price).alias("ready"),
                F.when(F.col("l_linestatus") == "O", q).alias("back_order"),
    )
    return workbook.open_orders_by_rep(rows)


@query(f"""SELECT o_orderdate::DATE AS day, l_shipdate::DATE AS ship_date, o_orderkey AS document,
  o_orderpriority AS sales_rep, n_name AS territory, c_name AS company, o_orderstatus AS status, c_mktsegment AS terms,
  s_name AS location, p_type AS category,
  p_name AS item, coalesce({_case("n_name", _GROUPS)}, 'Other') AS region, {_case("n_name", _SUBS)} AS tradeline,
  sum(l_quantity)::BIGINT AS back_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  WHERE l_linestatus = 'O' GROUP BY ALL""")
def customer_open_orders_full(spark, sf_dir):
    """Back orders at their full grain of twelve columns; the region is told before grouping, the trade line after."""
    l, o, c, n, s, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "supplier",
        "part"))
    rows = l.where("l_linestatus = 'O'").join(o, l["l_orderkey"] == o["o_orderkey"]).join(c,
        o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"])
    rows = rows.join(s, l["l_suppkey"] == s["s_suppkey"]).join(p, l["l_partkey"] == p["p_partkey"])
    keys = {
        "document": "o_orderkey", "sales_rep": "o_orderpriority", "territory": "n_name", "company": "c_name",
            "status": "o_orderstatus", "terms": "c_mktsegment", "location": "s_name", "category": "p_type",
                "item": "p_name",
    }
    region = workbook.tradeline(F.col("n_name"), _GROUPS, "Other")
    by = rows.groupBy(F.col("o_orderdate").cast("date").alias("day"),
        F.col("l_shipdate").cast("date").alias("ship_date"), *[F.col(v).alias(k) for k, v in keys.items()],
            region.alias("region"))
    return by.agg(F.sum(F.col("l_quantity").cast("long")).alias("back_order")).withColumn("tradeline",
        workbook.tradeline(F.col("territory"), _SUBS))


@query("""SELECT DISTINCT p_brand || ' : ' || p_type || ' ' || p_name AS parent, p_type || ' : ' || p_name AS member,
  p_type || ' ' || p_name AS parent_sku, p_name AS member_sku,
  (starts_with(p_type || ' ' || p_name, 'SMALL ') AND contains(upper(p_type || ' ' || p_name),
  'RING'))::INTEGER AS is_kind FROM part""")
def bill_master(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat("p_brand", F.lit(" : "), "p_type", F.lit(" "), "p_name")
        .alias("parent"), F.concat("p_type", F.lit(" : "), "p_name").alias("member"))
    return workbook.bill_master(p.distinct(), "SMALL ", "ring")


def _stock(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("long").alias("on_hand"))


def _bought(spark, sf_dir):
    l, s = table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'"), table(spark, sf_dir, "supplier")
    document = F.concat(F.when(F.col("l_linenumber") == 1, "TO").otherwise("PO"), "l_orderkey")
    return l.join(s, l["l_suppkey"] == s["s_suppkey"]).select(
        F.col("l_partkey").alias("sku"), document.alias("document"), F.col("s_name").alias("vendor"),
            F.col("l_quantity").cast("long").alias("remaining"), F.col("l_shipdate").cast("date").alias("expected")
    )


def _held(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    return l.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("long").alias("back_order"), F.col("l_extendedprice").alias("rate"))


_HOLD_SQL = """s AS (SELECT l_partkey AS sku, sum(l_quantity)::BIGINT AS on_hand FROM lineitem WHERE l_returnflag = 'A'
  GROUP BY 1),
b AS (SELECT l_partkey AS sku, sum(l_quantity)::BIGINT AS on_order FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_returnflag = 'N' AND l_linenumber <> 1 AND NOT contains(lower(s_name), '7') GROUP BY 1),
h AS (SELECT l_orderkey, l_linenumber, l_partkey AS sku, l_quantity::BIGINT AS back_order, l_extendedprice AS rate
  FROM lineitem WHERE l_linestatus = 'O')"""


@query(f"WITH {_HOLD_SQL} SELECT h.*, coalesce(on_hand, 0) AS on_hand, back_order * rate AS value FROM h LEFT JOIN s USING (sku)")
def hold_list(spark, sf_dir):
    return workbook.hold_list(_held(spark, sf_dir), _stock(spark, sf_dir))


@query(f"WITH {_HOLD_SQL} SELECT h.*, coalesce(on_hand, 0) AS on_hand, back_order * rate AS value, coalesce(on_order, 0) AS on_order FROM h LEFT JOIN s USING (sku) LEFT JOIN b USING (sku)")
def closure_list(spark, sf_dir):
    return workbook.closure_list(_held(spark, sf_dir), _stock(spark, sf_dir), _bought(spark, sf_dir), vendors=["7"])


@query("""WITH b AS (SELECT l_partkey AS sku, sum(l_quantity)::BIGINT AS po_qty FROM lineitem WHERE l_returnflag = 'N'
  GROUP BY 1),
r AS (SELECT p_partkey AS sku, p_name AS name, p_brand AS status, CASE
  WHEN p_size % 4 > 0 THEN p_size / 50.0::DOUBLE END AS completion FROM part)
SELECT r.*, CASE WHEN completion IS NULL THEN 'no completion data' WHEN completion < 0.85 THEN 'below target'
  ELSE 'on track' END AS flag, po_qty IS NOT NULL AS po_exists, coalesce(po_qty, 0) AS po_qty FROM r LEFT
  JOIN b USING (sku)""")
def launch_status(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    ready = p.select(F.col("p_partkey").alias("sku"), F.col("p_name").alias("name"), F.col("p_brand").alias("status"),
        F.when(F.col("p_size") % 4 > 0, F.col("p_size") / F.lit(50.0)).alias("completion"))
    return workbook.launch_status(ready, _bought(spark, sf_dir).select("sku", "remaining"))


@query("""WITH p AS (SELECT p_partkey AS sku, CASE WHEN p_size % 7 > 0 THEN p_size * 10 END AS needed,
  CASE WHEN p_partkey % 5 > 0 THEN DATE '1996-01-01' + p_size * 20 END AS due, p_brand LIKE 'Brand#1%' AS own FROM part),
l AS (SELECT l_partkey AS sku, l_quantity::BIGINT AS q, l_shipdate::DATE AS day, l_returnflag AS f, l_linestatus AS s,
  l_linenumber AS n FROM lineitem),
x AS (SELECT sku, needed, due, own, date_diff('day', DATE '1996-06-01', due) AS days_to_due,
  coalesce(sum(q) FILTER (f = 'A' AND n = 1), 0)::BIGINT AS on_hand,
  CASE WHEN own THEN coalesce(sum(q) FILTER (f = 'R' AND n <= 2), 0)::BIGINT END AS vendor_held,
  CASE WHEN own THEN coalesce(sum(q) FILTER (f = 'N' AND (due IS NULL OR day <= due)), 0)::BIGINT END AS made,
  coalesce(sum(q) FILTER (s = 'F' AND n = 3 AND (due IS NULL OR day + 10 <= due)), 0)::BIGINT AS arriving,
  CASE WHEN own THEN max(day) FILTER (f = 'N') END AS last_made
  FROM p LEFT JOIN l USING (sku) GROUP BY sku, needed, due, own),
y AS (SELECT *, on_hand + coalesce(vendor_held, 0) + coalesce(made, 0) + arriving AS available FROM x)
SELECT * EXCLUDE (own), CASE WHEN needed > 0 THEN round(available / needed::DOUBLE, 9) END AS completion,
  CASE WHEN NOT own THEN 'N/A' WHEN due IS NULL THEN 'TBD Date' WHEN coalesce(needed, 0) = 0 THEN 'N/A'
  WHEN available / needed::DOUBLE < 0.85 THEN 'Behind' WHEN last_made IS NULL OR last_made <= due - 45
  THEN 'Ahead of Schedule' ELSE 'On Track' END AS state FROM y""")
def launch_readiness(spark, sf_dir):
    """Stock, what the plant makes and what is under way against what each launch needs by its day."""
    p, l = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    size = F.col("p_size")
    plan = p.select(F.col("p_partkey").alias("sku"), F.when(size % 7 > 0, size * 10).alias("needed"),
        F.when(F.col("p_partkey") % 5 > 0, F.date_add(F.lit("1996-01-01").cast("date"), size * 20)).alias("due"),
        F.startswith("p_brand", F.lit("Brand#1")).alias("own"))
    lines = l.select(F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("long").alias("qty"),
        F.col("l_shipdate").cast("date").alias("day"), "l_returnflag", "l_linestatus", "l_linenumber")
    out = workbook.readiness(plan, lines.where("l_returnflag = 'A' AND l_linenumber = 1"),
        lines.where("l_returnflag = 'R' AND l_linenumber <= 2"), lines.where("l_returnflag = 'N'"),
        lines.where("l_linestatus = 'F' AND l_linenumber = 3"), "1996-06-01")
    return out.withColumn("completion", F.round("completion", 9))


_CONTAINER_SQL = """k AS (SELECT p_partkey::VARCHAR AS sku FROM part),
l AS (SELECT *, l_partkey::VARCHAR AS sku, CASE l_suppkey % 3 WHEN 0 THEN 'Americas' WHEN 1 THEN 'EMEA'
  ELSE 'AP' END AS region, year(l_shipdate) * 100 + month(l_shipdate) AS ym,
  CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE 0 END AS rate FROM lineitem),
o AS (SELECT sku, coalesce(sum(l_quantity) FILTER (region = 'Americas'), 0)::BIGINT AS bo_region,
  sum(l_quantity)::BIGINT AS bo_all, coalesce(min(rate) FILTER (region = 'Americas' AND rate > 0),
  0) AS rate_min_region,
  coalesce(max(rate) FILTER (region = 'Americas' AND rate > 0), 0) AS rate_max_region,
  count(*) FILTER (region = 'Americas' AND rate > 0) AS lines_region, coalesce(min(rate) FILTER (rate > 0),
  0) AS rate_min_all,
  coalesce(max(rate) FILTER (rate > 0), 0) AS rate_max_all, count(*) FILTER (rate > 0) AS lines_all FROM l
  WHERE l_linestatus = 'O' GROUP BY 1),
v AS (SELECT sku, sum(l_quantity) FILTER (l_returnflag = 'A')::BIGINT AS held,
  sum(l_quantity) FILTER (l_returnflag = 'N')::BIGINT AS on_po,
  sum(l_quantity) FILTER (l_returnflag = 'R')::BIGINT AS forecast_12m, count(*) AS inv_months,
  nullif(sum(floor(l_extendedprice)) FILTER (l_returnflag = 'A'),
  0)::BIGINT / nullif(sum(l_quantity) FILTER (l_returnflag = 'A'), 0)::BIGINT AS implied_cost FROM l GROUP BY 1),
s AS (SELECT sku, coalesce(sum(l_quantity) FILTER (region = 'Americas'), 0)::BIGINT AS on_hand_region FROM l
  WHERE l_returnflag = 'A' GROUP BY 1),
f AS (SELECT sku, coalesce(sum(l_quantity) FILTER (region = 'Americas' AND ym = 199608), 0)::BIGINT AS forecast_199608,
  coalesce(sum(l_quantity) FILTER (region = 'Americas' AND ym = 199609), 0)::BIGINT AS forecast_199609,
  coalesce(sum(l_quantity) FILTER (region = 'Americas' AND ym = 199610), 0)::BIGINT AS forecast_199610 FROM l
  GROUP BY 1),
h AS (SELECT sku, coalesce(sum(l_quantity) FILTER (l_linenumber = 6), 0)::BIGINT AS transit_first,
  coalesce(sum(l_quantity) FILTER (l_linenumber = 7), 0)::BIGINT AS transit_second FROM l GROUP BY 1),
p AS (SELECT sku, coalesce(sum(l_quantity) FILTER (l_shipdate::DATE BETWEEN DATE '1996-08-01' AND DATE '1996-10-31'),
  0)::BIGINT AS po_due FROM l WHERE l_returnflag = 'N' GROUP BY 1),
c AS (SELECT p_partkey::VARCHAR AS sku, min(p_retailprice) AS unit_cost FROM part WHERE p_size % 3 = 0 GROUP BY 1),
  e AS (SELECT p_partkey::VARCHAR AS sku, min(p_retailprice) AS position_cost FROM part WHERE p_size % 5 = 0
  GROUP BY 1),
a AS (SELECT p_partkey::VARCHAR AS sku, min(p_retailprice * 2) AS list_price FROM part WHERE p_size % 7 = 0 GROUP BY 1),
j AS (SELECT sku, coalesce(bo_region, 0) AS bo_region, coalesce(bo_all, 0) AS bo_all, coalesce(rate_min_region,
  0) AS rate_min_region, coalesce(rate_max_region, 0) AS rate_max_region, coalesce(lines_region, 0) AS lines_region,
  coalesce(rate_min_all, 0) AS rate_min_all, coalesce(rate_max_all, 0) AS rate_max_all, coalesce(lines_all,
  0) AS lines_all, coalesce(held, 0) AS held, coalesce(on_po, 0) AS on_po, coalesce(forecast_12m, 0) AS forecast_12m,
  coalesce(inv_months, 0) AS inv_months, implied_cost, coalesce(on_hand_region, 0) AS on_hand_region,
  coalesce(forecast_199608, 0) AS forecast_199608, coalesce(forecast_199609, 0) AS forecast_199609,
  coalesce(forecast_199610, 0) AS forecast_199610,
  coalesce(transit_first, 0) AS transit_first, coalesce(transit_second, 0) AS transit_second, coalesce(po_due,
  0) AS po_due, unit_cost, position_cost, list_price
  FROM k LEFT JOIN o USING (sku) LEFT JOIN v USING (sku) LEFT JOIN s USING (sku) LEFT JOIN f USING (sku) LEFT
  JOIN h USING (sku) LEFT JOIN p USING (sku) LEFT JOIN c USING (sku) LEFT JOIN e USING (sku) LEFT JOIN a USING (sku))"""


@query(f"""WITH {_CONTAINER_SQL}, n AS (SELECT *, unit_cost IS NULL AND position_cost IS NULL
  AND implied_cost IS NULL AS no_cost FROM j)
SELECT * EXCLUDE (no_cost), forecast_199608 + forecast_199609 + forecast_199610 AS forecast_total, CASE
  WHEN transit_first > 0 THEN 'first container' WHEN transit_second > 0 THEN 'second container' END AS container_group,
CASE WHEN transit_first + transit_second > 0 THEN DATE '1996-09-27' END AS eta,
  transit_first + transit_second AS transit,
CASE WHEN no_cost AND list_price IS NULL AND lines_all = 0 THEN 'no price or cost data'
  WHEN lines_all = 0 THEN 'no realized price' WHEN no_cost THEN 'no cost data' ELSE 'ok' END AS price_flag FROM n""")
def container_validation(spark, sf_dir):
    """Every part's case for a container."""
    p, l = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    region = F.when(F.col("l_suppkey") % 3 == 0, "Americas").when(F.col("l_suppkey") % 3 == 1, "EMEA").otherwise("AP")
    q, flag = F.col("l_quantity").cast("long"), F.col("l_returnflag")
    rate = F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).otherwise(0.0)
    l = l.select("*", F.col("l_partkey").cast("string").alias("sku"), region.alias("region"), rate.alias("rate"),
        q.alias("q"))
    price = lambda n: p.where(F.col("p_size") % n == 0).select(F.col("p_partkey").cast("string").alias("sku"),
        F.col("p_retailprice").alias("average_cost"))
    held = F.when(flag == "A", q)
    return workbook.container_validation(
        skus=p.select(F.col("p_partkey").cast("string").alias("sku")),
        orders=l.where("l_linestatus = 'O'").select("sku", "region", F.col("q").alias("back_order"), "rate"),
        review=l.select(
            "sku", held.alias("held"), F.when(flag == "N", q).alias("on_po"),
                F.when(flag == "R", q).alias("forecast_12m"), F.lit(1).alias("inv_months"),
            F.when(flag == "A", F.floor("l_extendedprice")).alias("inv_cost"), held.alias("total_inv"),
        ),
        stock=l.where("l_returnflag = 'A'").select("sku", "region", F.col("q").alias("on_hand")),
        forecast=l.select("sku", "region", (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("yyyymm"),
            F.col("q").alias("qty")),
        shipments=l.select("sku", F.col("l_linenumber").cast("string").alias("lane"), F.col("q").alias("qty")),
        on_order=l.where("l_returnflag = 'N'").select("sku", F.col("l_shipdate").cast("date").alias("expected"),
            F.col("q").alias("remaining")),
        prices=price(3), positions=price(5),
        allocations=p.where("p_size % 7 = 0").select(F.concat("p_brand", F.lit(" : "), "p_partkey").alias("name"),
            (F.col("p_retailprice") * 2).alias("base_price")),
        region="Americas", months=[199608, 199609, 199610], lanes={"6": "first container", "7": "second container"},
            eta=dt.date(1996, 9, 27), due=(dt.date(1996, 8, 1), dt.date(1996, 10, 31)),
    )


_BACK_SQL = """e AS (SELECT l_orderkey, l_linenumber, l_partkey AS sku, c_name AS customer, CASE
  WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate::DATE END AS ship_date, l_quantity::BIGINT AS qty,
  l_extendedprice AS rate, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def _back_orders(spark, sf_dir):
    l, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    date = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return l.join(o, l["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"]).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("sku"), F.col("c_name").alias("customer"),
            date.alias("ship_date"),
        F.col("l_quantity").cast("long").alias("qty"), F.col("l_extendedprice").alias("rate"), "l_returnflag",
            "l_linestatus",
    )


@query(f"""WITH {_BACK_SQL}, k AS (SELECT * FROM e WHERE l_linestatus = 'O' AND lower(customer) NOT LIKE '%0007%'
  AND lower(customer) NOT LIKE '%0013%' AND (ship_date IS NULL OR ship_date >= DATE '1995-01-01'))
SELECT l_orderkey, l_linenumber, sku, customer, ship_date, qty, qty * rate AS value FROM k
WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.l_linenumber = 7 AND x.sku = k.sku AND x.customer = k.customer
  AND x.ship_date IS NOT DISTINCT FROM k.ship_date)
AND NOT EXISTS (SELECT 1 FROM e x WHERE x.l_returnflag = 'R' AND x.l_linenumber = 1 AND x.sku = k.sku
  AND x.ship_date IS NOT DISTINCT FROM k.ship_date)
AND NOT EXISTS (SELECT 1 FROM e x WHERE x.l_returnflag = 'A' AND x.l_linenumber = 2 AND x.l_orderkey = k.l_orderkey)""")
def clean_back_orders(spark, sf_dir):
    """Names, a date floor and three lists leave back orders out."""
    e = _back_orders(spark, sf_dir)
    lists = [
        (e.where("l_linenumber = 7"), ["sku", "customer", "ship_date"]),
            (e.where("l_returnflag = 'R' and l_linenumber = 1"), ["sku", "ship_date"]),
        (e.where("l_returnflag = 'A' and l_linenumber = 2"), ["l_orderkey"]),
    ]
    kept = workbook.clean_back_orders(e.where("l_linestatus = 'O'"), ["0007", "0013"], dt.date(1995, 1, 1), lists)
    return kept.select("l_orderkey", "l_linenumber", "sku", "customer", "ship_date", "qty", "value")


@query("""WITH m AS (SELECT l_partkey AS sku, l_returnflag AS channel, sum(l_quantity)::BIGINT AS qty FROM lineitem
  WHERE l_linestatus = 'O' OR l_shipdate >= DATE '1996-01-01' GROUP BY 1, 2)
SELECT sku, channel, qty, round(qty / nullif(sum(qty) OVER (PARTITION BY sku), 0)::DOUBLE, 9) AS share FROM m""")
def allocation_mix(spark, sf_dir):
    """Back orders and forecasts together, each channel's share of a sku."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sku"), F.col("l_returnflag").alias("channel"),
        F.col("l_quantity").cast("long").alias("qty"), "l_linestatus", "l_shipdate")
    parts = [l.where("l_linestatus = 'O'"), l.where("l_linestatus <> 'O' and l_shipdate >= '1996-01-01'")]
    return workbook.allocation_mix(parts).withColumn("share", F.round("share", 9))


_POSITION_SQL = """l AS (SELECT l_partkey AS sku, CASE WHEN s_nationkey % 4 = 3 THEN 'C0'
  ELSE 'C' || s_nationkey % 4 END AS channel, l_quantity::BIGINT AS q, l_extendedprice AS price, l_returnflag AS f,
  l_linestatus AS st,
  l_shipdate::DATE AS d, date_trunc('month', l_shipdate)::DATE AS m FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey),
h AS (SELECT sku, channel, sum(q)::BIGINT AS on_hand FROM l WHERE f = 'A' GROUP BY 1, 2), b AS (SELECT sku, channel,
  coalesce(sum(q) FILTER (d >= DATE '1994-01-01'), 0)::BIGINT AS live_bo FROM l WHERE f = 'R' AND st = 'O' GROUP BY 1,
  2),
fm AS (SELECT sku, channel, m, sum(q) AS q FROM l WHERE f = 'N' GROUP BY 1, 2, 3),
f AS (SELECT sku, channel, coalesce(sum(q) FILTER (m >= DATE '1996-06-01' AND m < DATE '1996-09-01'),
  0)::BIGINT AS forecast3, coalesce(sum(q) FILTER (m >= DATE '1996-06-01' AND m < DATE '1997-06-01'),
  0)::BIGINT AS forecast12,
  count(*) FILTER (m >= DATE '1996-06-01' AND m < DATE '1997-06-01' AND q > 0) AS months FROM fm GROUP BY 1, 2),
s AS (SELECT sku, channel, coalesce(sum(q) FILTER (m < DATE '1996-06-01' AND m >= DATE '1996-03-01'), 0)::BIGINT AS sold
  FROM l WHERE f = 'R' GROUP BY 1, 2),
p AS (SELECT sku, sum(q)::BIGINT AS inbound, sum(price::DECIMAL(38,4))::DOUBLE AS inbound_value,
  min(d) FILTER (d > DATE '1996-06-15') AS next_due FROM l WHERE st = 'O' AND f = 'N' GROUP BY 1),
j AS (SELECT sku, channel, coalesce(on_hand, 0) AS on_hand, coalesce(live_bo, 0) AS live_bo, coalesce(inbound,
  0) AS inbound, coalesce(inbound_value, 0) AS inbound_value, next_due, coalesce(forecast3, 0) AS forecast3,
  coalesce(forecast12, 0) AS forecast12,
  coalesce(months, 0) AS months, coalesce(sold, 0) / 3.0::DOUBLE AS run_rate FROM h FULL JOIN b USING (sku, channel)
  FULL JOIN f USING (sku, channel) FULL JOIN s USING (sku, channel) LEFT JOIN p USING (sku)),
k AS (SELECT *, CASE WHEN forecast12 > 0 THEN on_hand / (forecast12 / 12.0::DOUBLE)
  WHEN run_rate > 0 THEN on_hand / run_rate WHEN on_hand > 0 THEN 999.0::DOUBLE ELSE 0.0::DOUBLE END AS supply
  FROM j)"""


@query(f"""WITH {_POSITION_SQL} SELECT sku || '|' || channel AS key, sku, channel, on_hand, live_bo,
  on_hand - live_bo AS net, inbound, inbound_value, next_due, forecast3, forecast12, greatest(12 - months,
  0) AS zero_months,
run_rate, 1.5::DOUBLE AS lead_months, supply AS months_of_supply, supply - 1.5 AS coverage FROM k""")
def positions(spark, sf_dir):
    """Line items as stock, back orders, purchases, forecast and demand; channel C3 counts for C0."""
    l, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    day = F.col("l_shipdate").cast("date")
    rows = l.join(s, l["l_suppkey"] == s["s_suppkey"]).select(
        F.col("l_partkey").alias("sku"), F.concat(F.lit("C"), F.col("s_nationkey") % 4).alias("channel"),
            F.col("l_quantity").cast("long").alias("qty"), F.col("l_extendedprice").alias("value"),
        "l_returnflag", "l_linestatus", day.alias("ship_date"), F.trunc(day, "month").alias("month"),
    )
    of = lambda flag: rows.where(F.col("l_returnflag") == flag)
    return workbook.positions(
        of("A").withColumnRenamed("qty", "on_hand"), of("R").where("l_linestatus = 'O'"),
            of("N").where("l_linestatus = 'O'").withColumnRenamed("ship_date", "expected"), of("N"), of("R"),
        {"C3": "C0"}, dt.date(1996, 6, 15), lead_days=45, since=dt.date(1994, 1, 1),
    )


@query(f"""WITH {_POSITION_SQL} SELECT sku, channel, on_hand / nullif(CASE
  WHEN forecast12 > 0 THEN forecast12 / 12.0::DOUBLE ELSE run_rate END, 0) AS months FROM j""")
def months_of_cover(spark, sf_dir):
    """Cover as the specification has it: null without demand."""
    p = positions(spark, sf_dir)
    return p.select("sku", "channel", numbers.months_of_cover(F.col("on_hand"), F.col("forecast12"), 12,
        F.col("run_rate") * 3).alias("months"))


@query("""WITH k AS (SELECT r_name, r_name || ' E' AS key FROM region), t AS (SELECT p_partkey,
  p_name || ' ' || lower(r_name) || ' ' || p_type AS c FROM part, region)
SELECT p_partkey, r_name, c FROM t JOIN k ON contains(upper(c), upper(key))""")
def infix_lookup(spark, sf_dir):
    """Texts that hold a key anywhere."""
    r = table(spark, sf_dir, "region").select("r_name", F.concat("r_name", F.lit(" E")).alias("key"))
    names = F.explode(F.transform(F.array(*[F.lit(n) for n in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")]),
        lambda n: F.concat("p_name", F.lit(" "), F.lower(n), F.lit(" "), "p_type")))
    texts = table(spark, sf_dir, "part").select("p_partkey", names.alias("c"))
    return joins.contains_key(r, texts, "c", "key").select("p_partkey", "r_name", "c")


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity::BIGINT - coalesce(CASE l_returnflag
  WHEN 'A' THEN l_quantity + 2 WHEN 'R' THEN l_quantity - 1 END, 0)::BIGINT AS left_, l_quantity::BIGINT AS ordered,
  l_linenumber = 3 AS odd FROM lineitem),
c AS (SELECT 'open_po:remaining:' || l_orderkey || '|' || l_linenumber AS exception_id, greatest(left_, 0) - CASE
  WHEN odd THEN ordered ELSE greatest(left_, 0) END AS delta FROM p)
SELECT exception_id, delta::DOUBLE AS delta FROM c WHERE delta <> 0 ORDER BY abs(delta) DESC, exception_id LIMIT 10""")
def top_exceptions(spark, sf_dir):
    """The ten conflicts that differ most: the limit is the feature."""
    from .canonical import po_conflicts

    return po_conflicts(spark, sf_dir).orderBy(F.desc(F.abs("delta")), "exception_id").limit(10).select("exception_id",
        "delta")
