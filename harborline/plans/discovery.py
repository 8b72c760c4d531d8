"""Discovery judgements over the driver's tables: roles, domains, risk, redaction, overlaps, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import discovery, estate, joins
from ..session import checkpointed
from .base import dealt, query, table

_FIRST = ("Qty", "PO", "Item", "Container", "Ship", "On", "Region", "Vendor", "Unit", "Line", "Order", "POL", "Due",
    "Invoice", "Location", "Price")
_SECOND = ("#", "Number", "Date", "on PO", "Hand", "of Measure", "Code", "")
_TOKENS = "array_to_string(list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> ''), ' ')"

#: An event as a header of its user's sheet, and every claim of a role on it.
_CLAIMS_SQL = f"""
h AS (
  SELECT DISTINCT 'u' || user_id AS sheet, {[*_FIRST]}[1 + event_id % 16] || ' ' || {[*_SECOND]}[1 + (event_id + user_id) % 8] AS header FROM events
), hn AS (SELECT *, {_TOKENS.format("header")} AS t FROM h),
p AS (SELECT role, {_TOKENS.format("pattern")} AS p
  FROM (VALUES {", ".join(f"('{r}', '{w}')" for r, ws in discovery.KEY_PATTERNS.items() for w in ws)}) v(role,
  pattern)),
c AS (
  SELECT sheet, header, role, CASE WHEN replace(t, ' ', '') = replace(p, ' ', '') THEN 'exact'
  WHEN starts_with(t || ' ', p || ' ') THEN 'leading'
    WHEN contains(' ' || t || ' ', ' ' || p || ' ') THEN 'contained' END AS match, len(string_split(p, ' ')) AS n
    FROM hn, p
), s AS (
  SELECT *, round(CASE match WHEN 'exact' THEN 1.0 WHEN 'leading' THEN 0.75
  ELSE 0.55 END::DOUBLE + 0.08::DOUBLE * (n - 1), 9) AS score FROM c WHERE match IS NOT NULL
), claims AS (
  SELECT sheet, header, role, max(score) AS score, max_by(match, score) AS match FROM s GROUP BY 1, 2, 3
)"""


def headers(spark, sf_dir):
    """Events as headers of their user's sheet."""
    first = F.get(F.array(*map(F.lit, _FIRST)), (F.col("event_id") % 16).cast("int"))
    second = F.get(F.array(*map(F.lit, _SECOND)), ((F.col("event_id") + F.col("user_id")) % 8).cast("int"))
    return table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("sheet"),
        F.concat(first, F.lit(" "), second).alias("header"))


@query(f"WITH {_CLAIMS_SQL} SELECT * FROM claims")
def key_claims(spark, sf_dir):
    """The best claim of every role on every header."""
    return discovery.key_candidates(headers(spark, sf_dir), "sheet", "header")


@query(f"""WITH RECURSIVE {_CLAIMS_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY score DESC, role, header) AS i FROM claims
), g AS (
  SELECT sheet, 0::BIGINT AS i, []::VARCHAR[] AS hs, []::VARCHAR[] AS rs, false AS won FROM (SELECT DISTINCT sheet
  FROM claims)
  UNION ALL
  SELECT g.sheet, r.i, CASE WHEN list_contains(hs, header) OR list_contains(rs, role) THEN hs ELSE list_append(hs,
  header) END,
    CASE WHEN list_contains(hs, header) OR list_contains(rs, role) THEN rs ELSE list_append(rs, role) END,
    NOT (list_contains(hs, header) OR list_contains(rs, role))
  FROM g JOIN ranked r ON r.sheet = g.sheet AND r.i = g.i + 1
)
SELECT sheet, header, role, round(least(score, 1), 3) AS score, match, score < 0.7 AS needs_confirmation FROM g
  JOIN ranked USING (sheet, i) WHERE won""")
def key_role_detect(spark, sf_dir):
    """Each role at most once a sheet, each header for one role, the best claim first."""
    return discovery.key_roles(headers(spark, sf_dir), "sheet", "header")


@query(f"""WITH RECURSIVE {_CLAIMS_SQL}, r AS (SELECT sheet, list(DISTINCT role) AS roles FROM claims GROUP BY 1)
SELECT sheet, coalesce(nullif(array_to_string(list_filter({[*discovery.GRAIN]}, lambda x: list_contains(roles, x)),
  ' x '), ''), 'unresolved') AS grain FROM r""")
def grain_of_roles(spark, sf_dir):
    claims = discovery.key_candidates(headers(spark, sf_dir), "sheet",
        "header").groupBy("sheet").agg(F.collect_set("role").alias("roles"))  # fifteen roles at most
    return claims.select("sheet", discovery.grain(F.col("roles")).alias("grain"))


DOMAINS = {
    "inventory": ["on hand", "onhand", "inventory", "small"], "purchasing": ["purchase order", "economy", "bolt"],
        "demand": ["forecast", "brand#1", "red widget"],
    "quality": ["promo", "ring"], "tariff": ["hts", "standard"],
}


def _domain_sql() -> str:
    flat = "regexp_replace({}, '[^a-z0-9]+', '', 'g')"
    out = []
    for name, words in DOMAINS.items():
        terms = []
        for w in words:
            bare = "".join(ch for ch in w if ch.isalnum())
            inside = lambda whole: f"(contains({whole}, '{w}')" + (f" OR contains({flat.format(whole)}, '{bare}'))"
                if len(bare) > 3 else ")")  # noqa: B023, E731
            terms.append(f"CASE WHEN {inside('path')} THEN 3 WHEN {inside('heads')} THEN 1 ELSE 0 END")
        out.append(f"({' + '.join(terms)}) AS {name}")
    best = "greatest(" + ", ".join(DOMAINS) + ")"
    pick = " ".join(f"WHEN {n} THEN '{n}'" for n in DOMAINS)
    return f"""WITH d AS (SELECT p_partkey, lower(p_type || '/' || replace(p_name, ' ', '_') || '.csv') AS path,
  lower(p_brand || ' | on-hand | ' || p_name) AS heads FROM part),
s AS (SELECT p_partkey, {", ".join(out)} FROM d) SELECT p_partkey, CASE WHEN {best} = 0 THEN 'unclassified'
  ELSE CASE {best} {pick} END END AS domain, {best} AS score FROM s"""


@query(_domain_sql())
def domain_classify(spark, sf_dir):
    """Parts as files: a word in the path weighs 3, one that is only in the headers 1; the best domain wins, ties to the first."""
    path = F.concat("p_type", F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".csv"))
    best = discovery.domain(path, F.array("p_brand", F.lit("On-Hand"), "p_name"), DOMAINS)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_brand")
    return dealt(p, "p_partkey").select("p_partkey", best.alias("d")).select("p_partkey", "d.domain", "d.score")


_SOURCE_SQL = """s AS (
  SELECT user_id, count(*) FILTER (event_type = 'signup' AND value > 20) AS queries,
  count(*) FILTER (event_type = 'error' AND value > 30) AS links,
    count(*) FILTER (event_type = 'purchase' AND value > 60) AS connections, sum(floor(value))::BIGINT AS formulas,
    count(*) FILTER (value > 5) AS rows_,
    max(value) > 80 AS macros, user_id % 7 = 0 AS is_csv FROM events GROUP BY 1)"""


def sources(spark, sf_dir):
    """Users as files, what they hold counted from their events."""
    kind, v = F.col("event_type"), F.col("value")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if((kind == "signup") & (v > 20)).alias("queries"),
            F.count_if((kind == "error") & (v > 30)).alias("links"),
        F.count_if((kind == "purchase") & (v > 60)).alias("connections"), F.sum(F.floor(v)).alias("formulas"),
            F.count_if(v > 5).alias("rows_"),
        (F.max(v) > 80).alias("macros"), (F.col("user_id") % 7 == 0).alias("is_csv"),
    )


@query(f"""WITH {_SOURCE_SQL}, v AS (SELECT *, queries > 0 OR links > 0 OR connections > 0 AS pulls, formulas > 100
  AND rows_ > 0 AND formulas >= 8 * rows_ AS computes FROM s)
SELECT user_id, CASE WHEN is_csv THEN 'true_source' WHEN pulls AND computes THEN 'hybrid' WHEN pulls THEN 'derived_copy'
  WHEN computes THEN 'calculated_output' WHEN rows_ > 0 THEN 'true_source' ELSE 'unknown' END AS role,
CASE WHEN is_csv OR pulls THEN 'high' WHEN computes OR rows_ > 0 THEN 'medium' ELSE 'low' END AS confidence,
CASE WHEN is_csv THEN 'export' ELSE coalesce(nullif(concat_ws(' + ', CASE
  WHEN queries > 0 THEN 'queries (' || queries || ')' END, CASE
  WHEN connections > 0 THEN 'connections (' || connections || ')' END,
  CASE WHEN links > 0 THEN 'formula links (' || links || ')' END, CASE WHEN macros THEN 'macro' END), ''),
  'manual') END AS refresh,
CASE WHEN is_csv THEN 1 ELSE pulls::INT + computes::INT + macros::INT + (pulls AND computes)::INT + (NOT pulls
  AND NOT computes)::INT END AS reasons FROM v""")
def role_verdict(spark, sf_dir):
    s = sources(spark, sf_dir)
    c = {n: F.col(n) for n in s.columns}
    part = discovery.part_played(c["queries"], c["links"], c["connections"], c["formulas"], c["rows_"], c["macros"],
        c["is_csv"], heavy=100, heavy_per_row=8)
    how = discovery.refresh_mechanism(c["queries"], c["connections"], c["links"], c["macros"], c["is_csv"])
    return s.select("user_id", part.alias("p"), how.alias("refresh")).select("user_id", "p.role", "p.confidence",
        "refresh", F.size("p.reasons").alias("reasons"))


_PLACES = (r"C:\Users\me\x.xlsx", r"file:///\\srv\share\b%20c.xlsx", "https://x.SharePoint.com/t/b.xlsx",
    r"D:\OneDrive\b.xlsx", r"D:\Downloads\b.csv", "https://example.com/b.csv", r"D:\data\b.csv")


@query(f"""WITH l AS (
  SELECT event_id, list_transform([event_id, event_id // 7, event_id // 3, user_id, event_id + user_id],
  lambda k: {[*_PLACES]}[1 + (k % 7)::INTEGER]) AS places, value, user_id, event_type FROM events
), n AS (
  SELECT *, list_count(list_filter(places, lambda x: x LIKE 'C:%')) AS a, list_count(list_filter(places,
  lambda x: x LIKE 'file:%')) AS b, list_count(list_filter(places, lambda x: x LIKE '%OneDrive%')) AS o,
    list_count(list_filter(places, lambda x: x LIKE '%SharePoint%')) AS s, list_count(list_filter(places,
    lambda x: x LIKE '%example.com%')) AS w, list_count(list_filter(places, lambda x: x LIKE '%Downloads%')) AS d FROM l
), r AS (
  SELECT event_id, (40 * least(a, 3) + 25 * least(b, 3) + 20 * least(o, 3) + 8 * least(s, 3) + 8 * least(w,
  3) + 45 * least(d, 3) + 10 * (event_type = 'error')::INT + 10 * (event_type = 'error' AND value > 30)::INT
    + least(3 * (user_id % 12), 24) + 15 * (value > 70)::INT + 12 * (value > 0
    AND value / 100 < 0.55)::INT + 20 * (user_id % 5 = 0)::INT)::INTEGER AS score FROM n
)
SELECT event_id, score, CASE WHEN score >= 70 THEN 'critical' WHEN score >= 40 THEN 'high'
  WHEN score >= 15 THEN 'medium' ELSE 'low' END AS band FROM r""")
def risk_score(spark, sf_dir):
    """Events as workbooks that read five places each."""
    k, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    places = F.array(*map(F.lit, _PLACES))
    at = [F.get(places, (x % 7).cast("int")) for x in (k, F.floor(k / 7), F.floor(k / 3), u, k + u)]
    bad = F.col("event_type") == "error"
    r = discovery.risk(F.array(*at), bad, bad & (v > 30), (u % 12).cast("int"), v > 70, v / 100,
        F.when(u % 5 == 0, 1).otherwise(0))
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return dealt(e, "event_id").select("event_id", r.alias("r")).select("event_id", "r.score", "r.band")


RULES = {
    "mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "phone": r"(\b)\+?[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b",
    **{k: text.REDACT_RULES[k] for k in ("media_token", "signature", "api_key", "bearer_token", "connection_secret")},
}


def _redact_sql() -> str:
    steps, before = [], "SELECT doc_id, text AS t FROM documents"
    for i, (name, p) in enumerate(RULES.items()):
        p = p.replace("'", "''")
        kept = r"\1" if name != "mail" else ""
        held = "".join(f", n{j}" for j in range(i))
        steps.append(f"r{i} AS (SELECT doc_id{held}, coalesce(len(regexp_extract_all(t, '{p}')), 0) AS n{i}, regexp_replace(t, '{p}', '{kept}<REDACTED>', 'g') AS t FROM ({before}))")
        before = f"SELECT * FROM r{i}"
    hits = " + ".join(f"n{i}" for i in range(len(RULES)))
    return f"WITH {', '.join(steps)} SELECT doc_id, n0::INTEGER AS mails, n1::INTEGER AS phones, ({hits})::INTEGER AS hits, md5(t) AS scrubbed FROM ({before})"


@query(_redact_sql())
def redact_text(spark, sf_dir):
    d = text.redact(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", RULES,
        needs=text.REDACT_NEEDS | {"mail": "@"})
    n = lambda name: F.coalesce(F.col("hits")[name], F.lit(0))
    total = F.aggregate(F.map_values("hits"), F.lit(0), lambda a, b: a + b)
    return d.select("doc_id", n("mail").alias("mails"), n("phone").alias("phones"), total.alias("hits"),
        F.md5("text").alias("scrubbed"))


_SETS = "list_sort(list_distinct(list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')))"


@query(f"""WITH raw AS (SELECT item_id AS owner, {_SETS.format("text")} AS items, length(text) AS rows_ FROM benchmark
  UNION ALL SELECT doc_id + 1000000000, {_SETS.format("text")}, length(text) FROM documents),
k AS (SELECT items, min(owner) AS owner, min_by(rows_, owner) AS rows_, count(*) AS members FROM raw
  WHERE len(items) >= 4 GROUP BY items),
t AS (SELECT owner, unnest(items) AS item FROM k), p AS (SELECT a.owner AS a, b.owner AS b, count(*) AS shared FROM t a
  JOIN t b ON a.item = b.item AND a.owner < b.owner GROUP BY 1, 2)
SELECT a, b, shared, round(shared / (len(x.items) + len(y.items) - shared)::DOUBLE, 9) AS jaccard,
  x.rows_ - y.rows_ AS row_delta, x.rows_ <> y.rows_ AS conflict, x.members AS members_a, y.members AS members_b
FROM p JOIN k x ON a = x.owner JOIN k y ON b = y.owner
  WHERE shared / (len(x.items) + len(y.items) - shared)::DOUBLE >= 0.7""")
def header_overlap(spark, sf_dir):
    """Token sets of all texts standing for headers. Equal sets are one, with its members counted, so copies don't pair all with all."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("owner"), "text")
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1_000_000_000).alias("owner"), "text")
    texts = b.union(d)
    items = F.array_sort(F.array_distinct(F.transform(text.header_tokens(F.col("text")), lambda i: F.xxhash64(i))))
    sets = texts.select("owner", F.length("text").alias("rows_"), items.alias("items")).select("owner", "rows_", "items",
        F.size("items").alias("n"), F.xxhash64(F.lit(1), "items").alias("kind"), F.xxhash64(F.lit(2), "items").alias("more"))
    one = checkpointed(sets.groupBy("n", "kind", "more").agg(F.min("owner").alias("owner"), F.count(F.lit(1)).alias("members"),
        F.min_by("rows_", "owner").alias("rows_")))
    near = joins.hashed_candidates(sets, "owner", "items", same="kind", sizes=one)
    found = joins.hashed_counts(near, texts, "owner", items)
    for s in "ab":
        found = found.join(one.select(F.col("owner").alias(s), F.col("rows_").alias(f"rows_{s}"), F.col("members")
            .alias(f"members_{s}")), s)
    delta = F.col("rows_a") - F.col("rows_b")
    return found.select("a", "b", "shared", F.round("jaccard", 9).alias("jaccard"), delta.alias("row_delta"),
        (delta != 0).alias("conflict"), "members_a", "members_b")


@query("""SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) > 20 AS capped FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 20""")
def row_cap(spark, sf_dir):
    """The first 20 events of each user, and whether there are more: the cap is the feature."""
    return discovery.capped(table(spark, sf_dir, "events").select("event_id", "user_id"), ["user_id"], ["event_id"], 20)


@query("""WITH cur AS (SELECT doc_id, md5(text) AS m FROM documents),
prev AS (SELECT CASE WHEN right(md5(text), 1) = 'f' THEN doc_id + 1000000000 ELSE doc_id END AS doc_id, md5(CASE
  WHEN left(md5(text), 1) < '4' THEN text || 'x' ELSE text END) AS m FROM documents)
SELECT coalesce(cur.doc_id, prev.doc_id) AS doc_id, CASE WHEN prev.doc_id IS NULL THEN 'added'
  WHEN cur.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM cur FULL JOIN prev USING (doc_id) WHERE cur.m IS DISTINCT FROM prev.m""")
def query_diff(spark, sf_dir):
    """What changed since a snapshot in which some texts differed and some had another id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.md5("text")
    before = d.select(
        F.when(F.substring(m, -1, 1) == "f", F.col("doc_id") + 1_000_000_000).otherwise(F.col("doc_id"))
            .alias("doc_id"),
        F.when(F.substring(m, 1, 1) < "4", F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("text"),
    )
    return estate.snapshot_diff(before, d, ["doc_id"])


@query(r"""SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS host, substr(sha1(lower(url)), 1,
  12) AS file_id, trim(regexp_replace(url, '[^A-Za-z0-9.-]+', '_', 'g'), '_') AS safe_name FROM pages""")
def file_identity(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.lower(F.regexp_extract(u, "^[a-z]+://([^/]+)", 1))
        .alias("host"), F.substring(F.sha1(F.lower(u)), 1, 12).alias("file_id"), text.safe_name(u).alias("safe_name"))


@query(r"""SELECT page_id, CASE WHEN url LIKE '%sharepoint%' THEN 'sharepoint' WHEN regexp_matches(url,
  '(?i)^.*\.csv$') THEN 'csv' WHEN regexp_matches(url, '^https?://') THEN 'web' ELSE 'file' END AS kind,
regexp_matches(url, '(?i)^.*/[b-f][a-z]/[!0-4]*.*$') AS globbed FROM pages""".replace("[!0-4]*", "[^0-4].*"))
def connector_kind(spark, sf_dir):
    u = F.col("url")
    kind = text.first_rule(u, {"sharepoint": "sharepoint", "csv": text.glob_regex("*.csv"), "web": "^https?://"},
        "file")
    return table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"),
        text.matches_any(u, ["*/[b-f][a-z]/[!0-4]**"]).alias("globbed"))
