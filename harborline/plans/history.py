"""Validity over time: overlaps, gaps, rates with end dates, sums in a row's own range."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals
from .base import query, table

_HELD_SQL = """held AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS since, CASE WHEN o_orderkey % 11 = 0 THEN NULL
  ELSE o_orderdate::DATE + ((o_orderkey % 200)::INTEGER - 5) END AS until FROM orders),
r AS (SELECT *, coalesce(until, DATE '9999-12-31') AS ends FROM held WHERE coalesce(until, DATE '9999-12-31') > since)"""


def _held(spark, sf_dir):
    """Orders as agreements of their customer: some without an end, some that end before they begin."""
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    ends = F.when(F.col("o_orderkey") % 11 != 0, F.date_add(day, (F.col("o_orderkey") % 200).cast("int") - 5))
    return o.select("o_custkey", "o_orderkey", day.alias("since"), ends.alias("until"))


@query(f"""WITH {_HELD_SQL}, d AS (SELECT DISTINCT o_custkey, unnest([since, ends]) AS day FROM r),
s AS (SELECT *, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS next FROM d),
c AS (SELECT s.o_custkey, day, next, count(r.o_orderkey) AS depth FROM s LEFT JOIN r ON r.o_custkey = s.o_custkey
  AND since <= day AND day < ends WHERE next IS NOT NULL GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day) - row_number() OVER (PARTITION BY o_custkey,
  depth > 1 ORDER BY day) AS run FROM c)
SELECT o_custkey, min(day) AS since, max(next) AS until, max(depth) AS depth FROM k WHERE depth > 1 GROUP BY o_custkey, run""")
def validity_overlaps(spark, sf_dir):
    """Stretches of days on which several agreements of a customer hold."""
    found = intervals.validity_issues(_held(spark, sf_dir), ["o_custkey"], "since", "until")
    return found.where("kind = 'overlap'").drop("kind")


@query(f"""WITH {_HELD_SQL}, m AS (SELECT *, max(ends) OVER (PARTITION BY o_custkey ORDER BY since, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far FROM r)
SELECT o_custkey, so_far AS since, since AS until FROM m WHERE since > so_far""")
def validity_gaps(spark, sf_dir):
    """Days between two agreements of a customer on which none holds."""
    found = intervals.validity_issues(_held(spark, sf_dir), ["o_custkey"], "since", "until")
    return found.where("kind = 'gap'").drop("kind", "depth")


_RATES = (("1993-01-01", "1996-01-01"), ("1995-06-01", "1997-03-01"), ("1995-09-01", "1995-11-01"), ("1998-01-01", None))


@query(f"""WITH rate AS (SELECT n_nationkey, d.since::DATE AS since, d.until::DATE AS until,
  n_nationkey * 10 + d.k AS rate FROM nation, (VALUES {", ".join(f"('{a}', {f"'{b}'" if b else "NULL"}, {k})"
  for k, (a, b) in enumerate(_RATES))}) d(since, until, k)),
o AS (SELECT o_orderkey, c_nationkey, o_orderdate::DATE AS day FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, c_nationkey, max_by(rate, since)::BIGINT AS rate FROM o LEFT JOIN rate ON c_nationkey = n_nationkey
  AND since <= day AND (until IS NULL OR day < until) GROUP BY 1, 2""")
def rate_in_force(spark, sf_dir):
    """Rates with end dates: one that ends gives way to an earlier one that still holds, or to none."""
    each = F.explode(F.array(*[F.struct(F.lit(a).cast("date").alias("since"), F.lit(b).cast("date").alias("until"),
        F.lit(k).alias("k")) for k, (a, b) in enumerate(_RATES)])).alias("d")
    rates = table(spark, sf_dir, "nation").select("n_nationkey", each).select(F.col("n_nationkey").alias("c_nationkey"),
        "d.since", "d.until", (F.col("n_nationkey").cast("long") * 10 + F.col("d.k")).alias("rate"))
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    facts = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_nationkey",
        F.col("o_orderdate").cast("date").alias("day"))
    return intervals.in_force(facts, rates, ["c_nationkey"], "day", "since", "until", ["rate"]).select("o_orderkey",
        "c_nationkey", "rate")


@query("""SELECT p.o_orderkey, coalesce(sum(l.l_quantity)::BIGINT, 0) AS quantity, count(l.l_partkey) AS lines
FROM (SELECT o_orderkey, o_custkey % 100 AS sku, o_orderdate::DATE AS since,
  o_orderdate::DATE + (o_orderkey % 45)::INTEGER AS until FROM orders) p
LEFT JOIN (SELECT l_partkey, l_partkey % 100 AS sku, l_quantity, l_shipdate::DATE AS day FROM lineitem) l
  ON l.sku = p.sku AND since <= day AND day < until GROUP BY 1""")
def facts_in_own_range(spark, sf_dir):
    """What was shipped of an order's line of goods in the days that the order itself names."""
    day = F.col("o_orderdate").cast("date")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 100).alias("sku"), day.alias("since"),
        F.date_add(day, (F.col("o_orderkey") % 45).cast("int")).alias("until"))
    facts = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("sku"), "l_quantity",
        F.col("l_shipdate").cast("date").alias("day"))
    return intervals.sum_in_range(rows, facts, ["sku"], "day", "since", "until", {
        "quantity": F.sum(F.col("l_quantity").cast("long")), "lines": F.count(F.lit(1))}).select("o_orderkey", "quantity",
        "lines")
