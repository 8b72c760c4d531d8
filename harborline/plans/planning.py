"""Planning metrics: conditional sums, cover, ABC, waterfall, lookups, rates."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.dates import year_month
from ..operators import aggregates as A
from ..operators import entities, joins, windows
from ..streaming import drops
from .base import query, table


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query("""SELECT l_partkey, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'O'),
  0)::BIGINT AS back_order, coalesce(sum(l_quantity) FILTER (l_returnflag IN ('A', 'N')), 0)::BIGINT AS committed,
  coalesce(sum((l_quantity * l_extendedprice)::DECIMAL(18,4)) FILTER (l_linenumber > 3), 0)::DOUBLE AS value
  FROM lineitem GROUP BY 1""")
def conditional_sums(spark, sf_dir):
    """A family of conditional sums over one table is one aggregation."""
    q = F.col("l_quantity").cast("long")
    return _lines(spark, sf_dir).groupBy("l_partkey").agg(
        A.sum_if((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), q).alias("back_order"),
        A.sum_if(F.col("l_returnflag").isin("A", "N"), q).alias("committed"),
        F.coalesce(A.exact_total(F.when(F.col("l_linenumber") > 3, F.col("l_quantity") * F.col("l_extendedprice"))),
            F.lit(0.0)).alias("value"),
    )


@query("""SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_quantity >= 25
  AND l_linestatus = 'O') AS large_open, count(l_shipdate) AS dated FROM lineitem GROUP BY 1""")
def conditional_counts(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count_if((F.col("l_quantity") >= 25) & (F.col("l_linestatus") == "O")).alias("large_open"),
                F.count("l_shipdate").alias("dated")
    )


@query("""SELECT l_partkey, coalesce(min(l_quantity) FILTER (l_returnflag = 'R'), 0) AS least,
  coalesce(max(l_quantity) FILTER (l_returnflag = 'R'), 0) AS most FROM lineitem GROUP BY 1""")
def min_max_ifs(spark, sf_dir):
    c = F.col("l_returnflag") == "R"
    return _lines(spark, sf_dir).groupBy("l_partkey").agg(A.min_if(c, F.col("l_quantity")).alias("least"),
        A.max_if(c, F.col("l_quantity")).alias("most"))


@query("""SELECT l_partkey, l_suppkey, sum(q)::BIGINT AS qty, sum(n)::BIGINT AS n FROM (SELECT l_partkey, l_suppkey,
  l_returnflag, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY ALL""")
def two_level_sum(spark, sf_dir):
    """(sku, source, flag), then (sku, source): equal to one grouping, and planned as one."""
    return _lines(spark, sf_dir).groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_quantity").cast("long"))
        .alias("qty"), F.count(F.lit(1)).alias("n"))


@query("""SELECT c_mktsegment, c_nationkey, round(avg(c_acctbal), 6) AS mean_balance,
  sum(c_acctbal::DECIMAL(18,4))::DOUBLE AS balance, count(*) AS n, min(c_acctbal) AS least, max(c_acctbal) AS most
  FROM customer GROUP BY ALL""")
def multi_measure_group(spark, sf_dir):
    b = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        F.round(F.avg(b), 6).alias("mean_balance"), A.exact_total(b).alias("balance"), F.count(F.lit(1)).alias("n"),
            F.min(b).alias("least"), F.max(b).alias("most")
    )


@query("""SELECT l_partkey, year(l_shipdate)::INTEGER * 100 + month(l_shipdate)::INTEGER AS yyyymm,
  sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY 1, 2""")
def demand_monthly(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("l_partkey", year_month(F.col("l_shipdate"))
        .alias("yyyymm")).agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))


_COVER_SQL = """cover AS (SELECT l_partkey AS sku, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'),
  0)::BIGINT AS on_hand,
  coalesce(sum(l_quantity) FILTER (l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'),
  0)::BIGINT AS forward12,
  coalesce(sum(l_quantity) FILTER (l_shipdate >= DATE '1996-10-01' AND l_shipdate < DATE '1997-01-01'),
  0) / 3.0 AS run_rate FROM lineitem GROUP BY 1)"""


def cover(spark, sf_dir, as_of: str = "1997-01-01"):
    """Stock, 12-month forward demand and 3-month run rate by sku, in one pass."""
    d, q = F.col("l_shipdate"), F.col("l_quantity").cast("long")
    day = F.lit(as_of).cast("date")
    return _lines(spark, sf_dir).groupBy(F.col("l_partkey").alias("sku")).agg(
        A.sum_if(F.col("l_returnflag") == "R", q).alias("on_hand"),
        A.sum_if((d >= day) & (d < F.add_months(day, 12)), q).alias("forward12"),
        (A.sum_if((d >= F.add_months(day, -3)) & (d < day), q) / F.lit(3.0)).alias("run_rate"),
    )


_MOS_SQL = "CASE WHEN forward12 > 0 THEN on_hand / (forward12 / 12.0) WHEN run_rate > 0 THEN on_hand / run_rate WHEN on_hand > 0 THEN 999.0 ELSE 0.0 END"


@query(f"WITH {_COVER_SQL} SELECT sku, on_hand, forward12, round(run_rate::DOUBLE, 6) AS run_rate, round(({_MOS_SQL})::DOUBLE, 6) AS months_of_supply FROM cover")
def forward_cover(spark, sf_dir):
    mos = numbers.months_of_supply(F.col("on_hand"), F.col("forward12"), F.col("run_rate"))
    return cover(spark, sf_dir).select("sku", "on_hand", "forward12", F.round("run_rate", 6).alias("run_rate"),
        F.round(mos, 6).alias("months_of_supply"))


@query(f"""WITH {_COVER_SQL}, m AS (SELECT *, ({_MOS_SQL})::DOUBLE AS mos FROM cover)
SELECT sku, CASE WHEN on_hand = 0 AND forward12 > 0 THEN 'STOCKOUT' WHEN mos < 1 THEN 'SHORT'
  WHEN mos > 8 THEN 'OVERSTOCK' ELSE 'HEALTHY' END AS status FROM m""")
def position_status(spark, sf_dir, short: float = 1.0, over: float = 8.0):
    """Status ladder; the thresholds are parameters."""
    mos = numbers.months_of_supply(F.col("on_hand"), F.col("forward12"), F.col("run_rate"))
    status = F.when((F.col("on_hand") == 0) & (F.col("forward12") > 0), "STOCKOUT").when(mos < short,
        "SHORT").when(mos > over, "OVERSTOCK").otherwise("HEALTHY")
    return cover(spark, sf_dir).select("sku", status.alias("status"))


@query(f"""WITH {_COVER_SQL}, m AS (SELECT *, ({_MOS_SQL})::DOUBLE AS mos FROM cover)
SELECT sku, CASE WHEN mos > 8 AND forward12 > 0 THEN 'OVERSTOCK' WHEN forward12 = 0 AND on_hand > 0 THEN 'DEAD STOCK'
  WHEN abs(forward12 / 4.0 - run_rate * 3) / nullif(run_rate * 3, 0) > 0.5 THEN 'LOW CONFIDENCE'
  ELSE 'MONITOR' END AS worst_flag FROM m""")
def worst_flag(spark, sf_dir, over: float = 8.0, variance: float = 0.5):
    """First flag that holds, worst first."""
    mos = numbers.months_of_supply(F.col("on_hand"), F.col("forward12"), F.col("run_rate"))
    actual = F.col("run_rate") * 3
    off = numbers.ratio(F.abs(F.col("forward12") / F.lit(4.0) - actual), actual)
    flag = F.when((mos > over) & (F.col("forward12") > 0), "OVERSTOCK").when((F.col("forward12") == 0) & (F.col(
        "on_hand") > 0), "DEAD STOCK").when(off > variance, "LOW CONFIDENCE").otherwise("MONITOR")
    return cover(spark, sf_dir).select("sku", flag.alias("worst_flag"))


@query("""WITH r AS (SELECT l_partkey AS sku, sum(round(l_extendedprice * (1 - l_discount) * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY 1),
c AS (SELECT *, sum(cents) OVER (ORDER BY cents DESC, sku) AS cumulative, sum(cents) OVER () AS grand FROM r)
SELECT sku, cents, cumulative::BIGINT AS cumulative, CASE WHEN round(cumulative::DOUBLE / grand::DOUBLE,
  9) <= 0.8 THEN 'A' WHEN round(cumulative::DOUBLE / grand::DOUBLE, 9) <= 0.95 THEN 'B' ELSE 'C' END AS abc FROM c""")
def abc_class(spark, sf_dir):
    cents = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long")
    revenue = _lines(spark, sf_dir).groupBy(F.col("l_partkey").alias("sku")).agg(F.sum(cents).alias("cents"))
    ranked = windows.cumulative_share(revenue, "cents", "sku")
    return ranked.select("sku", "cents", "cumulative", windows.abc_class(F.col("cumulative"), F.col("grand"))
        .alias("abc"))


_FALL_SQL = """d AS (SELECT l_partkey AS sku, left(o_orderpriority, 1)::INTEGER AS priority,
  sum(l_quantity)::BIGINT AS wanted FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
s AS (SELECT l_partkey AS sku, sum(l_quantity) FILTER (l_returnflag = 'R')::BIGINT AS supply FROM lineitem GROUP BY 1),
f AS (SELECT d.*, coalesce(supply, 0) AS supply, (wanted * 3) // 5 AS quota FROM d JOIN s USING (sku)),
b AS (SELECT *, least(quota, greatest(supply - 5, 0)) AS base FROM f),
u AS (SELECT *, greatest(wanted - base, 0) AS unmet FROM b),
p AS (SELECT *, greatest(max(greatest(supply - 5, 0)) OVER (PARTITION BY sku) - sum(base) OVER (PARTITION BY sku),
  0)::BIGINT AS leftover,
  coalesce(sum(unmet) OVER (PARTITION BY sku ORDER BY priority RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  0)::BIGINT AS prior_unmet FROM u)"""


@query(f"WITH {_FALL_SQL} SELECT sku, priority, base, unmet, leftover, prior_unmet, least(unmet, greatest(leftover - prior_unmet, 0)) AS sweep FROM p")
def alloc_waterfall(spark, sf_dir):
    l, o = _lines(spark, sf_dir), table(spark, sf_dir, "orders")
    q = F.col("l_quantity").cast("long")
    demand = l.join(o, l["l_orderkey"] == o["o_orderkey"]).groupBy(F.col("l_partkey").alias("sku"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("priority")).agg(F.sum(q).alias("wanted"))
    supply = l.groupBy(F.col("l_partkey").alias("sku")).agg(A.sum_if(F.col("l_returnflag") == "R", q).alias("supply"))
    plan = demand.join(supply, "sku").withColumn("quota", F.floor(F.col("wanted") * 3 / 5)
        .cast("long")).withColumn("held", F.lit(5).cast("long"))
    out = windows.waterfall(plan, ["sku"], "priority", "supply", "held", "wanted", "quota", bounds=[2, 3, 4, 5])
    return out.select("sku", "priority", *[F.col(c).cast("long").alias(c)
        for c in ("base", "unmet", "leftover", "prior_unmet", "sweep")])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey,
  l_linenumber) > 1 AS duplicated FROM lineitem""")
def duplicate_mask(spark, sf_dir):
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        windows.duplicated(["l_orderkey", "l_linenumber"]).alias("duplicated"))


@query("""WITH e AS (SELECT o_orderkey, c_name, CASE WHEN o_orderstatus = 'P' THEN NULL
  ELSE o_orderdate::DATE END AS ship_date FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, c_name, ship_date FROM e WHERE lower(c_name) NOT LIKE '%0007%' AND (ship_date IS NULL
  OR ship_date >= DATE '1995-01-01')
AND NOT EXISTS (SELECT 1 FROM e x WHERE x.o_orderkey % 10 = 3 AND x.c_name = e.c_name AND x.ship_date IS NOT DISTINCT
  FROM e.ship_date)""")
def clean_backorders(spark, sf_dir):
    """Name exclusions, a date floor that blanks pass, and an exclusion list where blank meets blank."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    date = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    every = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_name", date.alias("ship_date"))
    kept = every.where(~F.contains(F.lower("c_name"), F.lit("0007")) & (F.col("ship_date")
        .isNull() | (F.col("ship_date") >= F.lit("1995-01-01").cast("date"))))
    return joins.excluding(kept, every.where("o_orderkey % 10 = 3"), ["c_name", "ship_date"])


@query("""SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON split_part(c_name, '#',
  -1) = lpad(s_suppkey::VARCHAR, 9, '0')""")
def wildcard_lookup(spark, sf_dir):
    """Names that end with a key, by the computed tail."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
        .alias("key"))
    return joins.ends_with_key(s, table(spark, sf_dir, "customer"), "c_name", "key",
        F.substring_index("c_name", "#", -1)).select("s_suppkey", "c_custkey")


@query("""WITH f AS (SELECT l_partkey, l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_returnflag) AS r FROM lineitem WHERE l_quantity > 40)
SELECT p_partkey, coalesce(l_suppkey, -1) AS l_suppkey, coalesce(l_returnflag, 'none') AS l_returnflag FROM part LEFT
  JOIN f ON p_partkey = l_partkey AND r = 1""")
def first_match_lookup(spark, sf_dir):
    right = _lines(spark, sf_dir).where("l_quantity > 40").withColumnRenamed("l_partkey", "p_partkey")
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")]
    return joins.first_match(table(spark, sf_dir, "part").select("p_partkey"), right, "p_partkey", order,
        {"l_suppkey": -1, "l_returnflag": "none"})


@query("""WITH need AS (SELECT l_orderkey AS parent, l_partkey AS member, max(l_linenumber) - 1 AS qty FROM lineitem
  GROUP BY 1, 2), have AS (SELECT p_partkey AS member, (p_size * 7)::BIGINT AS available FROM part),
b AS (SELECT parent, member, CASE WHEN qty <= 0 THEN 9999 ELSE available // qty END::BIGINT AS buildable FROM need
  JOIN have USING (member))
SELECT parent, min(buildable) AS buildable, arg_min(member, buildable * 100000000 + member) AS limiting_part FROM b
  GROUP BY 1""")
def bom_min_build(spark, sf_dir):
    """Least buildable over a parent's members and the member that limits it (ties: least key)."""
    need = _lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("parent"),
        F.col("l_partkey").alias("member")).agg((F.max("l_linenumber") - 1).alias("qty"))
    have = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("member"),
        (F.col("p_size") * 7).cast("long").alias("available"))
    can = F.when(F.col("qty") <= 0, 9999).otherwise(F.floor(F.col("available") / F.col("qty"))).cast("long")
    least = need.join(have, "member").groupBy("parent").agg(F.min(F.struct(can.alias("buildable"), F.col("member")))
        .alias("m"))
    return least.select("parent", "m.buildable", F.col("m.member").alias("limiting_part"))


@query("""WITH rate AS (SELECT n_nationkey, d.since, round(1 + n_nationkey / 100.0 + d.k / 1000.0, 6)::DOUBLE AS rate
  FROM nation, (VALUES (DATE '1993-01-01', 0), (DATE '1995-06-01', 1), (DATE '1997-01-01', 2)) d(since, k))
SELECT o_orderkey, c_nationkey, rate FROM (SELECT o_orderkey, c_nationkey, o_orderdate::DATE AS day FROM orders
  JOIN customer ON o_custkey = c_custkey) o
ASOF LEFT JOIN rate ON c_nationkey = n_nationkey AND day >= since""")
def asof_rate(spark, sf_dir):
    since = F.explode(F.array(*[F.struct(F.lit(d).cast("date").alias("since"), F.lit(k).alias("k")) for k,
        d in enumerate(("1993-01-01", "1995-06-01", "1997-01-01"))]))
    rates = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), since.alias("s")).select(
        "c_nationkey", "s.since", F.round(1 + F.col("c_nationkey") / 100.0 + F.col("s.k") / 1000.0, 6).alias("rate")
    )
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    facts = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_nationkey",
        F.col("o_orderdate").cast("date").alias("day"))
    return joins.effective(facts, rates, ["c_nationkey"], "day", "since", ["rate"]).select("o_orderkey", "c_nationkey",
        "rate")


@query("""WITH m AS (SELECT l_partkey AS sku, l_returnflag AS channel, sum(l_quantity)::BIGINT AS qty FROM lineitem
  GROUP BY 1, 2)
SELECT sku, channel, qty, round(qty / nullif(sum(qty) OVER (PARTITION BY sku), 0)::DOUBLE, 9) AS share FROM m""")
def channel_mix(spark, sf_dir):
    mix = _lines(spark, sf_dir).groupBy(F.col("l_partkey").alias("sku"),
        F.col("l_returnflag").alias("channel")).agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    whole = F.sum("qty").over(W.partitionBy("sku"))
    return mix.withColumn("share", F.round(numbers.ratio(F.col("qty"), whole), 9))


@query("""SELECT l_suppkey, quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.9) AS p90, count(d) AS n
  FROM (SELECT l_suppkey, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS d FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""")
def lead_time_percentiles(spark, sf_dir):
    l, o = _lines(spark, sf_dir), table(spark, sf_dir, "orders")
    days = l.join(o, l["l_orderkey"] == o["o_orderkey"]).select("l_suppkey",
        F.datediff("l_shipdate", "o_orderdate").alias("d"))
    return entities.percentiles(days, ["l_suppkey"], "d")


@query("""WITH m AS (SELECT l_partkey, (year(l_shipdate) * 12 + month(l_shipdate))::INTEGER AS month_no,
  sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY 1, 2)
SELECT l_partkey, month_no, qty, sum(qty) OVER (PARTITION BY l_partkey ORDER BY month_no RANGE BETWEEN 2 PRECEDING
  AND CURRENT ROW)::BIGINT AS trailing3 FROM m""")
def trailing_window(spark, sf_dir):
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("int")
    m = _lines(spark, sf_dir).groupBy("l_partkey", month.alias("month_no")).agg(F.sum(F.col("l_quantity").cast("long"))
        .alias("qty"))
    return m.withColumn("trailing3", F.sum("qty").over(W.partitionBy("l_partkey").orderBy("month_no")
        .rangeBetween(-2, 0)))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
  OR c_mktsegment IS NULL""")
def not_in_list(spark, sf_dir):
    seg = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").where(~seg.isin("BUILDING", "MACHINERY") | seg.isNull()).select("c_custkey",
        "c_name")


@query("""SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT LIKE '1%'""")
def drop_error_rows(spark, sf_dir):
    """Rows whose typed cell failed are dropped; blank cells aren't failures."""
    raw = F.when(F.col("o_orderpriority").startswith("1"), F.lit("#N/A")).when(F.col("o_orderpriority").startswith("2"),
        None).otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf_dir, "orders").where(raw.isNull() | numbers.parse_number(raw)
        .isNotNull()).select("o_orderkey", "o_orderpriority")


@query("""SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events""")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT p_partkey, p_brand, p_type, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20""")
def top_offenders(spark, sf_dir):
    """A top-k report: the limit is the feature."""
    p = table(spark, sf_dir, "part")
    return p.orderBy(F.desc("p_retailprice"), "p_partkey").limit(20).select("p_partkey", "p_brand", "p_type",
        "p_retailprice")


@query("""SELECT l_partkey AS sku, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A' AND l_linenumber = 1),
  NULL)::BIGINT AS kept_null, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A' AND l_linenumber = 1),
  0)::BIGINT AS zero_filled FROM lineitem GROUP BY 1""")
def null_sum_switch(spark, sf_dir):
    q = F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.col("l_quantity").cast("long"))
    return _lines(spark, sf_dir).groupBy(F.col("l_partkey").alias("sku")).agg(A.total(q).alias("kept_null"),
        A.total(q, zero_fill=True).alias("zero_filled"))


@query("""SELECT count(*) AS files, count(DISTINCT event_type) AS kinds,
  count(*) FILTER (event_type = 'error') AS failed, max(ts) AS last_seen,
  sum(value::DECIMAL(18,4))::DOUBLE AS total_value FROM events""")
def run_summary(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("files"), F.countDistinct("event_type").alias("kinds"),
            F.count_if(F.col("event_type") == "error").alias("failed"), F.max("ts").alias("last_seen"),
                A.exact_total(F.col("value")).alias("total_value")
    )


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n,
  sum(value::DECIMAL(18,4))::DOUBLE AS total_value FROM events GROUP BY ALL""")
def event_windows(spark, sf_dir):
    """The streaming extension's plan over the whole table."""
    return drops.event_windows(table(spark, sf_dir, "events")).withColumn("window_start",
        F.col("window_start").cast("timestamp_ntz"))
