"""The registered queries of this subpackage: thin wrappers and their SQL.

Each takes (spark, sf_dir), applies its operator with production parameters to
the whole of its table and derives digests from the operator's outputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, embed_dedup, langid, line_dedup, lm, merkle, mixing, secrets, sharding, simhash, whitening
from .common import table


def ranks_path() -> str:
    """The public rank file; HARBORLINE_RANKS names another."""
    if own := os.environ.get("HARBORLINE_RANKS"):
        return own
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_documents(table(spark, sf_dir, "documents"))
    return scored.select(
        F.col("id").alias("doc_id"), "n_tokens", F.round("log_score", 4).alias("log_score"),
            F.round("mean_log_score", 6).alias("mean_log_score")
    )


def op3_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_common_lines(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
            F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), keep_row=False)
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ledger = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda rule: F.size(rule).cast("long").alias(f"n_{rule}")
    spans = secrets.span_text()
    return found.select("doc_id", *map(n, secrets.RULES), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op9_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, ranks_path()).select(
        F.col("id").alias("doc_id"),
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select(F.col("doc.doc_id").alias("doc_id"), "held_out", "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
            "explained", "identity_error", F.col("deviation").cast("string").alias("deviation_exact")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = merkle.leaf_digest([more if c == "n_chars" else F.col(c) for c in names])
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    made = merkle.manifest(docs, names, also={"tampered": F.when(struck, tampered)})
    now = merkle.folded(F.coalesce("also.tampered", "leaf"), F.col("proof"))
    return made.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"), now.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    placed = sharding.place(table(spark, sf_dir, "documents"), 24, keep={
        "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8, "text_crc32": F.crc32(text.cast("binary"))})
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_dedup, op2_lm_score, op3_ann_search, op4_line_dedup, op5_embed_dedup,
        op6_chat_format, op7_mix_sources, op8_secret_scan, op9_bpe_tokens, op10_language_id,
        op11_whitening, op12_merkle_manifest, op13_sharding,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op2_lm_score": rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
  '{_WORD}') AS ws FROM documents
), t AS (
  SELECT row, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d
), g AS (
  SELECT row, w, lag(w) OVER (PARTITION BY row ORDER BY pos) AS p FROM t
), total AS (
  SELECT greatest(count(*), 1)::DOUBLE AS n FROM t
), u AS (
  SELECT w, ln(count(*)) AS log FROM t GROUP BY w
), b AS (
  SELECT p, w, ln(count(*)) AS log FROM g WHERE p IS NOT NULL GROUP BY p, w HAVING count(*) >= 2
), weight AS (
  SELECT b.p, b.w, round((b.log + (ln(total.n) - ln(0.4)) - a.log - c.log) * 100000000)::BIGINT AS more
  FROM b JOIN u AS a ON a.w = b.p JOIN u AS c ON c.w = b.w, total
), s AS (
  SELECT row, sum(round(u.log * 100000000)::BIGINT + coalesce(more, 0)) AS value, count(*) AS n
  FROM g JOIN u USING (w) LEFT JOIN weight ON weight.p = g.p AND weight.w = g.w GROUP BY row
), r AS (
  SELECT doc_id, coalesce(sum(s.n), 0)::BIGINT AS n_tokens, count(s.n) AS firsts, coalesce(sum(value),
  0)::DOUBLE / 100000000 AS value
  FROM d LEFT JOIN s USING (row) GROUP BY doc_id
), f AS (
  SELECT doc_id, n_tokens, value - n_tokens * ln(total.n) + (n_tokens - firsts) * ln(0.4) AS log_score FROM r, total
)
SELECT doc_id, n_tokens, round(log_score, 4) AS log_score, CASE WHEN n_tokens > 0 THEN round(log_score / n_tokens,
  6) END AS mean_log_score FROM f""",
    "op4_line_dedup": rf"""
WITH line AS (
  SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), each AS (
  SELECT doc_id, row, unnest(ls) AS body, generate_subscripts(ls, 1) AS pos FROM line
), keyed AS (
  SELECT *, translate(trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}',
  '{_LOWER}') AS k FROM each
), common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (c.k IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k GROUP BY doc_id, row""",
    "op6_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text,
  '') || chr(10) || '<|end|>' AS body FROM conversations
), p AS (
  SELECT conv_id, row_number() OVER w AS place, string_agg(md5(body), '') OVER w AS prefix,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, body ROWS UNBOUNDED PRECEDING)
), whole AS (
  SELECT prefix, n, min(conv_id) AS conv_id, count(*) AS same FROM p WHERE place = n GROUP BY prefix, n
), kept AS (
  SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM p WHERE place < n)
)
SELECT conv_id, n AS n_turns, same - 1 AS n_absorbed, string_agg(body, chr(10) ORDER BY turn, body) AS rendered
FROM kept JOIN t USING (conv_id) GROUP BY conv_id, n, same""",
    "op7_mix_sources": rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')), 1, 12) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d
  GROUP BY source
), w AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[place % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap,
    1.5::DOUBLE * (SELECT sum(size)::BIGINT FROM d) AS budget FROM s
), o AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  0) AS spent,
    sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM w
), f AS (
  SELECT *, cap * open_weight <= weight * (budget - spent) AS full_ FROM o
), t AS (
  SELECT source, source_size, CASE WHEN full_ THEN cap ELSE weight * (budget - coalesce(sum(cap) FILTER (full_) OVER (),
  0))
    / sum(weight) FILTER (NOT full_) OVER () END AS target FROM f
), g AS (
  SELECT d.source, key, sum(size) AS size FROM d GROUP BY d.source, key
), r AS (
  SELECT g.*, floor(target / greatest(source_size, 1)) AS rounds, target - floor(target / greatest(source_size,
  1)) * source_size AS rest,
    sum(size) OVER (PARTITION BY g.source ORDER BY key) AS upto, source_size, target
  FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, row_number() OVER (PARTITION BY source, upto > rest ORDER BY key) = 1 AND upto > rest AS edge FROM r
)
SELECT doc_id, d.size, source_size, target,
  (d.size * (rounds + CASE WHEN upto <= rest OR edge
  AND size_of_edge - (rest - (upto - size_of_edge)) < rest - (upto - size_of_edge) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN (SELECT *, size AS size_of_edge FROM e) e ON d.source IS NOT DISTINCT FROM e.source AND d.key = e.key""",
}


def _spans_sql(name: str, pattern: str, kind: int, ok: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
{name}0 AS (
  SELECT row, string_split_regex(body, '{p}') AS gaps, regexp_extract_all(body, '{p}') AS hits FROM docs
), {name}1 AS (
  SELECT row, hits, gaps, unnest(hits) AS hit, generate_subscripts(hits, 1) AS i FROM {name}0
), {name} AS (
  SELECT row, {kind} AS kind, '{name}' AS word, length(hit) AS n,
    coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))),
    0)::BIGINT + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start
  FROM {name}1 WHERE {ok}
)"""


ORACLE["op8_secret_scan"] = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS body FROM documents),
{_spans_sql("assign", secrets.ASSIGN, 0, "length(regexp_extract(hit, '" + secrets.ASSIGN.replace("'", "''") + "', 2)) >= 12")},
{_spans_sql("access", "AKIA[A-Z0-9]+", 1, "length(hit) >= 18")},
{_spans_sql("hex", "[0-9a-f]+", 2, "length(hit) >= 16")},
every AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
found AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
    string_agg(word || ':' || start || ':' || (start + n), ',' ORDER BY start, kind) AS spans FROM every GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (row)"""

#: CRC-32 by its table, which follows from the polynomial.
_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
)"""


def _crc_sql(text: str) -> str:
    byte = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce(list_concat([4294967295], {byte}), "
        "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)")


def _leaf_sql(*fields: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """Levels of a tree over (g, n, idx, hash)."""
    return f"""
{name} AS (
  SELECT g, n, 0 AS level, idx, hash FROM {leaves}
  UNION ALL
  SELECT g, (n + 1) // 2, level + 1, idx // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM {name} WHERE n > 1
  GROUP BY g, n, level, idx // 2
)"""


def _steps_sql(leaves: str, tree: str, more: str, first: int) -> str:
    """The way up from each leaf: N without a sibling, else its side and digest."""
    return f"""
  SELECT {more}, own.level + {first} AS level,
    CASE WHEN sib.hash IS NULL THEN 'N' WHEN sib.idx < own.idx THEN 'L' || sib.hash ELSE 'R' || sib.hash END AS step
  FROM {leaves} l JOIN {tree} own ON own.g IS NOT DISTINCT FROM l.g AND own.n > 1 AND own.idx = l.idx >> own.level
  LEFT JOIN {tree} sib ON sib.g IS NOT DISTINCT FROM own.g AND sib.level = own.level AND sib.idx = xor(own.idx, 1)"""


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS row, doc_id, lang AS g,
    {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} AS hash,
    {_leaf_sql("doc_id", "source", "lang", "n_chars::HUGEINT + 1", "text")} AS changed,
    coalesce({_crc_sql("doc_id::VARCHAR")} % 7 = 0, false) AS struck
  FROM documents, crc_table
), leaf AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n FROM d
), {_tree_sql("low", "leaf")}, sub AS (
  SELECT '' AS g, g AS lang, hash, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM low WHERE n = 1
), {_tree_sql("high", "sub")}, step AS (
  {_steps_sql("leaf", "low", "l.row", 0)}
  UNION ALL
  SELECT leaf.row, s.level, s.step FROM leaf JOIN ({_steps_sql("sub", "high", "l.lang", 1000)}) s
  ON s.lang IS NOT DISTINCT FROM leaf.g
), way AS (
  SELECT row, list(step ORDER BY level) AS steps, string_agg(step[2:], '' ORDER BY level) AS proof FROM step GROUP BY row
), f AS (
  SELECT doc_id, leaf.hash AS leaf, sub.hash AS subroot, (SELECT hash FROM high WHERE n = 1) AS root,
    sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_concat([CASE WHEN struck THEN changed ELSE leaf.hash END], coalesce(steps, [])),
      lambda acc, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || acc WHEN 'R' THEN acc || s[2:] ELSE acc END)) AS folded_root
  FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.g LEFT JOIN way USING (row)
)
SELECT *, folded_root = root AS verified FROM f"""

ORACLE["op13_sharding"] = f"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(strlen(text), 0)::BIGINT + 8 AS size,
    CASE WHEN text = '' THEN 0 ELSE {_crc_sql("text")} END AS text_crc32, md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents, crc_table
), k AS MATERIALIZED (
  SELECT *, ('0x' || key[:4])::BIGINT AS point,
    row_number() OVER (ORDER BY ('0x' || key[5:19])::BIGINT, doc_id NULLS FIRST, size, text_crc32 NULLS FIRST) - 1 AS rank
  FROM d
), node AS (
  SELECT s, ('0x' || md5(s || ':' || v)[:4])::BIGINT AS point FROM range(24) a(s), range(128) b(v)
), near AS (
  SELECT p.point, s, min((node.point - p.point + 65536) % 65536) AS way FROM (SELECT DISTINCT point FROM k) p, node
  GROUP BY p.point, s
), around AS (
  SELECT point, list(s ORDER BY way, s) AS shards FROM near GROUP BY point
), turn AS MATERIALIZED (
  SELECT rank, shards FROM k JOIN around USING (point)
), dealt AS (
  SELECT -1::BIGINT AS rank, -1::BIGINT AS shard,
    list_transform(range(24), lambda i: n // 24 + (i < n % 24)::BIGINT) AS room FROM (SELECT count(*) AS n FROM d)
  UNION ALL
  SELECT rank, shard, list_transform(range(24), lambda i: room[i + 1] - (i = shard)::BIGINT) FROM (
    SELECT turn.rank, room, list_filter(shards, lambda s: room[s + 1] > 0)[1] AS shard
    FROM dealt JOIN turn ON turn.rank = dealt.rank + 1
  )
)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY rank) - 1 AS slot,
  NULL::INTEGER AS grown_shard
FROM k JOIN dealt USING (rank)"""
