"""Estate judgements over the driver's tables and stated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import estate
from .base import query, table


#: A page's address as it is, and as a media file, a team site's file, a path and a name.
_ADDRESS = ("url", "media", "site", "path", "name")


@query(r"""WITH u AS (
  SELECT page_id, unnest(['url', 'media', 'site', 'path', 'name']) AS kind, unnest([url,
  'https://' || page_id % 9 || '.app.example.com/core/media/media.nl?c=1&ID=' || page_id % 20 || '&h=' || md5(url),
    'https://team.SharePoint.com/' || page_id % 5 || '/Book.xlsx?web=' || page_id,
    '\\\\srv\Share' || page_id || '\Plan ' || page_id % 7 || '.XLSX', 'Table' || page_id % 3]) AS address FROM pages)
SELECT page_id, kind, CASE kind WHEN 'media' THEN 'media:' || page_id % 20
  WHEN 'site' THEN 'sharepoint:https://team.sharepoint.com/' || page_id % 5 || '/book.xlsx'
  WHEN 'path' THEN 'file:plan ' || page_id % 7 || '.xlsx' WHEN 'name' THEN 'query:table' || page_id % 3
  ELSE 'web:' || regexp_replace(lower(address), '[?#].*$', '') END AS upstream FROM u""")
def upstream_identity(spark, sf_dir):
    k = F.col("page_id")
    media = F.concat(F.lit("https://"), k % 9, F.lit(".app.example.com/core/media/media.nl?c=1&ID="), k % 20,
        F.lit("&h="), F.md5("url"))
    site = F.concat(F.lit("https://team.SharePoint.com/"), k % 5, F.lit("/Book.xlsx?web="), k)
    path = F.concat(F.lit("\\\\srv\\Share"), k, F.lit("\\Plan "), k % 7, F.lit(".XLSX"))
    given = dict(zip(_ADDRESS, (F.col("url"), media, site, path, F.concat(F.lit("Table"), k % 3)), strict=True))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), c.alias("address")) for n,
        c in given.items()])).alias("a")
    return table(spark, sf_dir, "pages").select("page_id", each).select("page_id", "a.kind",
        estate.upstream_identity(F.col("a.address"), "query").alias("upstream"))


@query("""SELECT user_id, count(*) AS rows_, count(*) FILTER (value > 150) AS valued, count(*) >= 10
  AND count(*) FILTER (value > 150) < 0.1 * count(*) AS bloated FROM events GROUP BY 1""")
def bloat_flags(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("rows_"),
        F.count_if(F.col("value") > 150).alias("valued"))
    return e.withColumn("bloated", estate.is_bloated(F.col("rows_"), F.col("valued"), least=10))


@query("""SELECT user_id, max((event_type = 'error')::INTEGER) AS failed, count(DISTINCT event_type) AS risk,
  count(*) AS rows_ FROM events GROUP BY 1 ORDER BY failed DESC, risk DESC, rows_ DESC, user_id""")
def source_priority(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max((F.col("event_type") == "error").cast("int"))
        .alias("failed"), F.countDistinct("event_type").alias("risk"), F.count(F.lit(1)).alias("rows_"))
    return estate.work_order(e, "failed", "risk", "rows_", "user_id")


@query("""SELECT r_name, coalesce((SELECT string_agg(n_name, ',' ORDER BY n_nationkey) FROM nation
  WHERE n_regionkey = r_regionkey), '') AS members FROM region""")
def nested_join(spark, sf_dir):
    r = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    n = table(spark, sf_dir, "nation")
    return estate.nest(r, n, "n_regionkey", "members", ["n_nationkey"]).select("r_name",
        F.array_join(F.transform("members", lambda m: m["n_name"]), ",").alias("members"))


@query("""SELECT o_custkey, count(*) FILTER (o_totalprice > 100000) AS large, min_by(o_totalprice,
  o_orderkey) FILTER (o_totalprice > 100000) AS first_large FROM orders GROUP BY 1""")
def spill_filter(spark, sf_dir):
    """How many of a customer's orders are large, and the first of them: aggregates, no list of all orders."""
    large = F.col("o_totalprice") > 100000
    first = F.min_by("o_totalprice", F.when(large, F.col("o_orderkey")))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(large).alias("large"),
        F.when(F.count_if(large) > 0, first).alias("first_large"))


@query("""SELECT o_custkey, o_orderkey, len(list_filter(d, lambda x: x > 0.05))::INTEGER AS discounted, list_filter(d,
  lambda x: x > 0.05)[1] AS first_discount
FROM (SELECT l_orderkey, list(l_discount ORDER BY l_discount) AS d FROM lineitem GROUP BY 1)
  JOIN orders ON l_orderkey = o_orderkey""")
def array_filter(spark, sf_dir):
    """Array filter and first element over the lines of an order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_discount"))
        .alias("d"))  # an order's own lines
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    some = F.filter("d", lambda x: x > 0.05)
    return o.select("o_custkey", "o_orderkey", F.size(some).alias("discounted"), F.get(some, 0).alias("first_discount"))
