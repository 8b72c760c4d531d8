"""The named business queries and sheets, over the driver's tables.

Each is a typed read, a grouping, derived columns and filters; what was a
nest of lookups and conditional sums is one grouped aggregation, joined once.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..functions.dates import year_month
from ..operators import aggregates as A
from ..operators import joins, reshape, windows, workbook
from .base import query, table
from .planning import cover

#: One territory dimension with a column for each grouping, instead of a map in each query.
TERRITORIES = [("AFRICA", "EMEA", "EMEA"), ("AMERICA", "Americas", "Americas"), ("ASIA", "Asia", "AP"),
    ("EUROPE", "EMEA", "B2C"), ("MIDDLE EAST", "EMEA", "EMEA")]
_TERR_SQL = "terr(r_name, region, alternate) AS (VALUES " + ", ".join(str(t) for t in TERRITORIES) + ")"


def territories(spark):
    return spark.createDataFrame(TERRITORIES, "r_name string, region string, alternate string")


def _places(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).join(territories(spark), "r_name",
        "left").select("n_nationkey", "n_name", "region", "alternate")


_PLACE_SQL = f"{_TERR_SQL}, place AS (SELECT n_nationkey, n_name, region, alternate FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN terr USING (r_name))"


@query(f"""WITH {_PLACE_SQL} SELECT p_name AS sku, n_name AS location, region, sum(l_quantity)::BIGINT AS on_hand
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN place ON s_nationkey = n_nationkey WHERE l_quantity IS NOT NULL GROUP BY ALL""")
def current_inventory(spark, sf_dir):
    l, p, s = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    stock = l.where("l_quantity is not null").groupBy("l_partkey",
        "l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    return (
        stock.join(p, stock["l_partkey"] == p["p_partkey"]).join(s, stock["l_suppkey"] == s["s_suppkey"])
            .join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("p_name").alias("sku"), F.col("n_name").alias("location"), "region")
            .agg(F.sum("q").alias("on_hand"))
    )


@query(f"""WITH {_PLACE_SQL} SELECT l_partkey AS item, l_shipdate::DATE AS ship_date, region,
  sum(l_quantity)::BIGINT AS back_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
JOIN place ON c_nationkey = n_nationkey WHERE l_linestatus = 'O' GROUP BY ALL""")
def customer_open_orders(spark, sf_dir):
    l, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    return (
        l.where("l_linestatus = 'O'").join(o, l["l_orderkey"] == o["o_orderkey"])
            .join(c, o["o_custkey"] == c["c_custkey"]).join(_places(spark, sf_dir),
                F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("l_partkey").alias("item"), F.col("l_shipdate").cast("date").alias("ship_date"), "region")
            .agg(F.sum(F.col("l_quantity").cast("long")).alias("back_order"))
    )


@query("""SELECT l_orderkey AS document, l_linenumber AS line_id, l_partkey AS item, l_shipdate AS expected
  FROM lineitem WHERE l_returnflag = 'N' ORDER BY l_shipdate NULLS FIRST""")
def items_on_po(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'")
    return l.orderBy(F.asc_nulls_first("l_shipdate")).select(F.col("l_orderkey").alias("document"),
        F.col("l_linenumber").alias("line_id"), F.col("l_partkey").alias("item"), F.col("l_shipdate").alias("expected"))


@query("""WITH x AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' : ' || p_name || ' ' ELSE p_name END AS name,
  p_brand AS parent, p_type AS category, l_extendedprice / l_quantity AS cost FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT trim(CASE WHEN contains(name, ':') THEN substr(name, strpos(name, ':') + 1) ELSE name END) AS sku, parent, category,
  max(cost) AS average_cost FROM x GROUP BY name, parent, category""")
def purchase_price(spark, sf_dir):
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_brand", F.lit(" : "), "p_name", F.lit(" "))).otherwise(
        F.col("p_name"))
    cost = l.groupBy("l_partkey").agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("average_cost"))
    items = cost.join(p, cost["l_partkey"] == p["p_partkey"]).select(name.alias("name"), F.col("p_brand").alias("parent"),
        F.col("p_type").alias("category"), "average_cost")
    return workbook.purchase_price(items)


MONTHS = [f"Forecast QTY {m:02d}-{y}" for y in (1996, 1997) for m in range(1, 13)]


def wide_forecast(spark, sf_dir):
    """One column a month, as the export has it."""
    l = table(spark, sf_dir, "lineitem")
    month = F.date_format("l_shipdate", "MM-yyyy")
    qty = [F.sum(F.when(month == c[-7:], F.col("l_quantity").cast("long"))).alias(c) for c in MONTHS]
    return l.where("l_shipdate >= '1996-01-01' and l_shipdate < '1998-01-01'").groupBy("l_partkey",
        "l_returnflag").agg(*qty)


@query("""SELECT l_partkey AS sku, l_returnflag AS lead_group,
  (year(l_shipdate) * 100 + month(l_shipdate))::INTEGER AS yyyymm, sum(l_quantity)::BIGINT AS forecast_qty FROM lineitem
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1998-01-01' GROUP BY ALL HAVING sum(l_quantity) <> 0""")
def forecast_qty(spark, sf_dir):
    """Unpivot of month columns, date from the header's tail, zero and null dropped."""
    rows = reshape.unpivot_others(wide_forecast(spark, sf_dir), ["l_partkey", "l_returnflag"], "attribute", "qty")
    day = F.to_date(F.right("attribute", F.lit(7)), "MM-yyyy")
    return rows.where("qty <> 0").groupBy(F.col("l_partkey").alias("sku"), F.col("l_returnflag").alias("lead_group"),
        year_month(day).alias("yyyymm")).agg(F.sum("qty").alias("forecast_qty"))


@query(f"""WITH {_PLACE_SQL} SELECT o_orderdate::DATE AS day, l_partkey AS item, alternate AS territory,
  sum(l_quantity)::BIGINT AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
JOIN place ON c_nationkey = n_nationkey WHERE alternate IS NOT NULL GROUP BY ALL""")
def sales(spark, sf_dir):
    l, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    return (
        l.join(o, l["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"])
            .join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).where("alternate is not null")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("l_partkey").alias("item"),
            F.col("alternate").alias("territory")).agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    )


@query("""SELECT c_name, round(avg(o_totalprice), 6) AS mean_rate, sum(o_totalprice::DECIMAL(18,4))::DOUBLE AS balance,
  count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O' GROUP BY ALL""")
def open_order(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'"), table(spark, sf_dir, "customer")
    by = o.groupBy("o_custkey").agg(F.round(F.avg("o_totalprice"), 6).alias("mean_rate"),
        A.exact_total(F.col("o_totalprice")).alias("balance"), F.count(F.lit(1)).alias("orders"))
    return by.join(c, by["o_custkey"] == c["c_custkey"]).select("c_name", "mean_rate", "balance", "orders")


_ENGINE_SQL = """k AS (SELECT l_partkey AS sku, l_returnflag AS channel,
  coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0)::BIGINT AS on_hand,
  coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0)::BIGINT AS inbound,
  coalesce(sum((l_quantity * l_extendedprice)::DECIMAL(18,4)) FILTER (l_linestatus = 'O'), 0)::DOUBLE AS inbound_value,
  min(l_shipdate) FILTER (l_linestatus = 'O') AS next_due FROM lineitem GROUP BY 1, 2)"""


@query(f"""WITH {_ENGINE_SQL}, t AS (SELECT *, sum(on_hand) OVER (PARTITION BY sku) AS whole FROM k)
SELECT sku || '|' || channel AS key, sku, channel, on_hand, inbound, inbound_value, next_due,
  round(on_hand / nullif(whole, 0)::DOUBLE, 9) AS mix, row_number() OVER (PARTITION BY channel
  ORDER BY inbound_value DESC, sku) AS rank FROM t""")
def position_engine(spark, sf_dir):
    """Position by sku and channel: one aggregation, then windows by sku and by channel."""
    from pyspark.sql import Window as W

    open_ = F.col("l_linestatus") == "O"
    q = F.col("l_quantity").cast("long")
    k = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sku"),
        F.col("l_returnflag").alias("channel")).agg(
        A.sum_if(~open_, q).alias("on_hand"), A.sum_if(open_, q).alias("inbound"),
        F.coalesce(A.exact_total(F.when(open_, F.col("l_quantity") * F.col("l_extendedprice"))), F.lit(0.0))
            .alias("inbound_value"), F.min(F.when(open_, F.col("l_shipdate"))).alias("next_due"),
    )
    mix = F.round(numbers.ratio(F.col("on_hand"), F.sum("on_hand").over(W.partitionBy("sku"))), 9)
    out = k.select(F.concat(F.col("sku").cast("string"), F.lit("|"), "channel").alias("key"), "*", mix.alias("mix"))
    return windows.ranked(out, ["channel"], "inbound_value", "sku")


@query(f"""WITH {_ENGINE_SQL} SELECT channel, sum(on_hand)::BIGINT AS on_hand, sum(inbound)::BIGINT AS inbound FROM k
  GROUP BY ROLLUP (channel)""")
def allocation_plan_totals(spark, sf_dir):
    k = position_engine(spark, sf_dir).select("channel", "on_hand", "inbound")
    return k.rollup("channel").agg(F.sum("on_hand").alias("on_hand"), F.sum("inbound").alias("inbound"))


@query("""WITH own AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN 'owner ' || p_brand END AS owner FROM part),
  q AS (SELECT l_partkey, sum(l_quantity)::BIGINT AS qty, sum(l_quantity) FILTER (l_returnflag = 'R')::BIGINT AS held
  FROM lineitem GROUP BY 1)
SELECT l_partkey AS sku, coalesce(owner, 'UNASSIGNED') AS owner, least(greatest(round(1 - coalesce(held,
  0) * 1.5 / nullif(qty, 0), 9), 0), 1)::DOUBLE AS ratio,
 least(greatest(round(1 - coalesce(held, 0) * 1.5 / nullif(qty, 0), 9), 0), 1)::DOUBLE > 0.5 AS included FROM q LEFT
  JOIN own ON l_partkey = p_partkey""")
def inventory_review(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").alias("sku"),
        F.concat(F.lit("owner "), "p_brand").alias("owner"))
    q = F.col("l_quantity").cast("long")
    stock = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sku")).agg(F.sum(q).alias("qty"),
        A.sum_if(F.col("l_returnflag") == "R", q).alias("held"))
    out = joins.first_match(stock, p, "sku", [F.col("owner")], {"owner": "UNASSIGNED"})
    ratio = numbers.clamp(F.round(1 - numbers.ratio(F.col("held") * 1.5, F.col("qty")), 9), 0.0, 1.0)
    return out.select("sku", "owner", ratio.alias("ratio"), (ratio > 0.5).alias("included"))


@query("""SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '1998-08-02')::INTEGER AS age, CASE
  WHEN o_orderstatus = 'F' THEN 'closed' WHEN date_diff('day', o_orderdate::DATE,
  DATE '1998-08-02') > 1500 THEN 'close now'
 WHEN date_diff('day', o_orderdate::DATE, DATE '1998-08-02') > 700 AND o_orderpriority LIKE '5%' THEN 'ask sales'
  WHEN contains(lower(o_orderpriority), 'urgent') THEN 'expedite' ELSE 'keep' END AS step FROM orders""")
def sales_hygiene(spark, sf_dir, as_of: str = "1998-08-02"):
    age = F.datediff(F.lit(as_of).cast("date"), "o_orderdate")
    step = F.when(F.col("o_orderstatus") == "F", "closed").when(age > 1500,
        "close now").when((age > 700) & F.col("o_orderpriority").startswith("5"),
            "ask sales").when(F.contains(F.lower("o_orderpriority"), F.lit("urgent")), "expedite").otherwise("keep")
    return table(spark, sf_dir, "orders").select("o_orderkey", age.alias("age"), step.alias("step"))


@query("""WITH c AS (SELECT l_partkey AS sku, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'),
  0)::BIGINT AS on_hand, coalesce(sum(l_quantity) FILTER (l_shipdate >= DATE '1997-01-01'
  AND l_shipdate < DATE '1998-01-01'), 0)::BIGINT AS need FROM lineitem GROUP BY 1)
SELECT sku, CASE WHEN need > 0 THEN round(least(on_hand / need::DOUBLE, 1.0), 9) END AS completion, CASE
  WHEN need = 0 THEN 'no demand' WHEN on_hand >= need THEN 'ready' WHEN on_hand * 2 >= need THEN 'at risk'
  ELSE 'short' END AS readiness FROM c""")
def product_readiness(spark, sf_dir):
    c = cover(spark, sf_dir)
    done = F.round(F.when(F.col("forward12") > 0, F.least(F.col("on_hand") / F.col("forward12"), F.lit(1.0))), 9)
    state = F.when(F.col("forward12") == 0, "no demand").when(F.col("on_hand") >= F.col("forward12"),
        "ready").when(F.col("on_hand") * 2 >= F.col("forward12"), "at risk").otherwise("short")
    return c.select("sku", done.alias("completion"), state.alias("readiness"))


@query("""WITH x AS (SELECT p_brand || ' : ' || p_type || ' : ' || p_name AS name, n_name AS location,
  l_quantity::BIGINT AS q FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 2 = 0)
SELECT substr(name, strpos(name, ':') + 1) AS name_tail, location, sum(q)::BIGINT AS available FROM x GROUP BY ALL""")
def location_inventory(spark, sf_dir):
    """Stock at flagged locations; what follows the first delimiter, not trimmed."""
    l, p, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation"))
    stock = l.groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    every = stock.join(p, stock["l_partkey"] == p["p_partkey"]).join(s,
        stock["l_suppkey"] == s["s_suppkey"]).join(n.where("n_nationkey % 2 = 0"),
            F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.concat_ws(" : ", "p_brand", "p_type", "p_name")
    return every.groupBy(text.after_first(name, ":").alias("name_tail"),
        F.col("n_name").alias("location")).agg(F.sum("q").alias("available"))


@query("""SELECT l_partkey AS item, l_shipdate::DATE AS expected, substr('SPO' || l_orderkey,
  strpos('SPO' || l_orderkey, 'O') + 1) AS document, l_linenumber AS line_id, sum(l_quantity)::BIGINT AS remaining
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL""")
def po_documents(spark, sf_dir):
    """Open lines by item, date and document; the document number follows its first letter O."""
    l = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    number = text.after_first(F.concat(F.lit("SPO"), F.col("l_orderkey").cast("string")), "O")
    return l.groupBy(F.col("l_partkey").alias("item"), F.col("l_shipdate").cast("date").alias("expected"),
        number.alias("document"), F.col("l_linenumber").alias("line_id")).agg(F.sum(F.col("l_quantity").cast("long"))
            .alias("remaining"))


#: Names that a launch leaves out.
EXCLUDED = [f"Brand#{i}" for i in range(11, 35)]


@query(f"""WITH w AS (SELECT p_brand AS name, sum(l_quantity::BIGINT) FILTER (l_returnflag = 'A')::BIGINT AS A,
  sum(l_quantity::BIGINT) FILTER (l_returnflag = 'R' AND l_linenumber = 7 AND p_size = 1)::BIGINT AS R
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand NOT IN ({", ".join("'" + x + "'" for x in EXCLUDED)})
  GROUP BY 1)
SELECT name, 'A' AS channel, A AS value FROM w WHERE A IS NOT NULL UNION ALL SELECT name, 'R', R FROM w
  WHERE R IS NOT NULL""")
def new_product_allocations(spark, sf_dir):
    """Listed channels to rows, nulls dropped, a list of names left out before."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    q = F.col("l_quantity").cast("long")
    kept = p.where(~F.col("p_brand").isin(*EXCLUDED) | F.col("p_brand").isNull())
    wide = l.join(kept, l["l_partkey"] == kept["p_partkey"]).groupBy(F.col("p_brand").alias("name")).agg(
        F.sum(F.when(F.col("l_returnflag") == "A", q)).alias("A"),
            F.sum(F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7) & (F.col("p_size") == 1), q))
                .alias("R")
    )
    return reshape.unpivot(wide, ["name"], ["A", "R"], "channel", "value", keep_null=False)


@query(f"""WITH {_PLACE_SQL} SELECT l_shipdate::DATE AS ship_date, region AS territory, l_partkey AS item,
  date_diff('day', DATE '1997-06-01', l_shipdate::DATE)::INTEGER AS days_from_today,
  CASE region WHEN 'Americas' THEN 'JAX' WHEN 'EMEA' THEN 'ROT' WHEN 'Asia' THEN 'SZX' END AS fulfilment,
  sum(l_quantity)::BIGINT AS back_order
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN place ON c_nationkey = n_nationkey WHERE l_linestatus = 'O' GROUP BY ALL""")
def open_order_report(spark, sf_dir, as_of: str = "1997-06-01"):
    rows = customer_open_orders(spark, sf_dir)
    hub = F.when(F.col("region") == "Americas", "JAX").when(F.col("region") == "EMEA",
        "ROT").when(F.col("region") == "Asia", "SZX")
    return rows.select("ship_date", F.col("region").alias("territory"), "item",
        F.datediff("ship_date", F.lit(as_of).cast("date")).alias("days_from_today"), hub.alias("fulfilment"),
            "back_order")


@query("""SELECT n_name AS location, (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS yyyymm,
  sum(l_quantity)::BIGINT AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE year(o_orderdate) IN (1996, 1997) AND n_name NOT IN ('NATION_1', 'NATION_2', 'NATION_3') GROUP BY ALL""")
def validated_sales(spark, sf_dir):
    """Two years, three locations left out; the date bound reaches the scan."""
    l, o, c, n = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation"))
    two = o.where("o_orderdate >= '1996-01-01' and o_orderdate < '1998-01-01'")
    places = n.where(~F.col("n_name").isin("NATION_1", "NATION_2", "NATION_3"))
    return (
        l.join(two, l["l_orderkey"] == two["o_orderkey"]).join(c, two["o_custkey"] == c["c_custkey"])
            .join(places, c["c_nationkey"] == places["n_nationkey"])
        .groupBy(F.col("n_name").alias("location"), year_month(F.col("o_orderdate")).alias("yyyymm"))
            .agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    )


@query("""WITH s AS (SELECT l_partkey AS part, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'),
  0)::BIGINT AS on_hand, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'O'),
  0)::BIGINT AS back_orders,
  count(DISTINCT l_orderkey) AS used_in FROM lineitem GROUP BY 1) SELECT part, on_hand, back_orders,
  greatest(on_hand - back_orders, 0) AS available, used_in FROM s""")
def parts_live(spark, sf_dir):
    """Availability of a part net of back orders, and how many parents use it."""
    q, flag = F.col("l_quantity").cast("long"), F.col("l_returnflag")
    by = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(
        A.sum_if(flag == "A", q).alias("on_hand"), A.sum_if((flag == "R") & (F.col("l_linestatus") == "O"), q)
            .alias("back_orders"), F.countDistinct("l_orderkey").alias("used_in")
    )
    return by.select("part", "on_hand", "back_orders", numbers.floor_zero(F.col("on_hand") - F.col("back_orders"))
        .alias("available"), "used_in")
