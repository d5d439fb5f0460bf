"""Registered queries of the text operators, each over its whole table, with SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliogrid.llm import exact, html, jaccard, lines, mixing, negatives, packing, privacy, quality, repair, suffix, tokens, urls
from heliogrid.queries.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


URL_RULES = (
    urls.host_rule("com/", "allow"),
    urls.host_rule("example.com/en/", "block"),
    urls.host_rule("www.example.com/en/", "allow"),
    urls.host_rule("net/es/", "block"),
    urls.host_rule("net/fr/", "block"),
)

@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule, rhost, rpath, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block'))
SELECT page_id, host, path,
       (SELECT arg_max(rule, length(rule)) FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rule)) FROM r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)), 'allow') AS verdict
FROM h"""


@query("op2_url_filters", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
g AS (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY plain ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY plain) AS group_size, sha256(plain) AS text_sha256 FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""


@query("op3_exact_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*privacy.KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in privacy.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * o >= 85 * (x.n + y.n - o)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)"""


@query("op6_jaccard_join", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), jaccard.Similarity(words=4, percent=85))


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts="n_removed")
    return kept.select("doc_id", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  substr(md5('mix-1:' || doc_id), 1, 15) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
f AS (SELECT *, 3 * source_size AS cap, coalesce(sum(3 * source_size) OVER o, 0) AS caps, coalesce(sum(weight) OVER o, 0) AS weights,
             sum(source_size) OVER () AS words, sum(weight) OVER () AS all_weight
      FROM w WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (words - caps)::DOUBLE * weight > cap::DOUBLE * (all_weight - weights) OR cap = 0 AS is_full FROM f),
r AS (SELECT words - coalesce(sum(cap) FILTER (WHERE is_full), 0) AS rest, all_weight - coalesce(sum(weight) FILTER (WHERE is_full), 0) AS rest_weight
      FROM c GROUP BY words, all_weight),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE least(rest::DOUBLE * weight / rest_weight::DOUBLE, cap::DOUBLE) END AS target FROM c, r),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM p"""


@query("op9_mixing", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
e AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
c AS (SELECT rid, count(DISTINCT i + j) AS n FROM e, range(0, 3) AS o(j) GROUP BY rid),
l AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(l.dup, 0)::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '!!(?:[\x20\x09-\x0D]|$)')) AS shouted,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_
      FROM d LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_symbols > 25 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 100 * shouted > 30 * n_words OR (upper_ > 50 AND 100 * upper_ > 70 * (upper_ + lower_))) AS kept,
       (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 8 * (100 * n_symbols > 25 * n_words)::BIGINT
       + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 25 * n_words)::BIGINT + 64 * (100 * shouted > 30 * n_words)::BIGINT
       + 128 * (upper_ > 50 AND 100 * upper_ > 70 * (upper_ + lower_))::BIGINT AS fail_bits
FROM b"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.with_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measures = [F.col(f"ledger.{m}").alias(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return ledger.select("doc_id", *measures, (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.STANDARD).alias("kept"), F.col("ledger.fail_bits").alias("fail_bits"))


OP11_SQL = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.schema("vec_id bigint, embedding array<float>, label int").parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT)),
             lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, left(role, 1) AS x,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, count(*) OVER (PARTITION BY conv_id) AS n FROM d),
f AS (SELECT *, lead(x) OVER (PARTITION BY conv_id ORDER BY i) AS y, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN seen > 1 THEN 2
             WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 3 ELSE 0 END AS fault FROM o),
ins(q, r, e, lines) AS (VALUES (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'),
  (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:')),
act(q, r, e, initial, price, new_role) AS (VALUES (0, 0, 'D', '', 3, ''), (1, 1, 'D', '', 3, ''), (2, 2, 'D', '', 3, ''), (3, 3, 'D', '', 3, ''),
  (0, 1, 'K', 's', 0, ''), (0, 2, 'K', 'u', 0, ''), (1, 2, 'K', 'u', 0, ''), (2, 3, 'K', 'a', 0, ''), (3, 2, 'K', 'u', 0, ''),
  (0, 2, 'R', '', 2, 'user'), (1, 2, 'R', '', 2, 'user'), (2, 3, 'R', '', 2, 'assistant'), (3, 2, 'R', '', 2, 'user')),
v(conv_id, i, q, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} FROM o
  UNION ALL
  SELECT v.conv_id, f.i, act.r, min({'cost': v.best.cost + 2 * length(ins.e) + act.price + CASE WHEN act.e <> 'D' AND fault = 3 THEN 1 ELSE 0 END, 'audit': v.best.audit || ins.e || act.e,
         'lines': v.best.lines || ins.lines || CASE act.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || act.new_role || ':' || f.text END})
  FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1 JOIN ins ON ins.q = v.q
       JOIN act ON act.q = ins.r AND (act.e = 'D' OR fault NOT IN (1, 2)) AND (act.e <> 'K' OR f.x = act.initial)
  GROUP BY v.conv_id, f.i, act.r),
z AS (SELECT v.conv_id, min({'cost': v.best.cost + 2 * length(ins.e), 'audit': v.best.audit || ins.e, 'lines': v.best.lines || ins.lines}) AS best
      FROM v JOIN (SELECT DISTINCT conv_id, n FROM o) m ON m.conv_id IS NOT DISTINCT FROM v.conv_id AND m.n = v.i
           JOIN ins ON ins.q = v.q AND ins.r IN (0, 3) AND (v.q <> 0 OR ins.r = 0) GROUP BY v.conv_id),
t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
             count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE y IS NOT NULL AND x || y NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.best.cost, 0)::BIGINT AS cost, coalesce(z.best.audit, '') AS audit, sha256(coalesce(substr(z.best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op12_conversation_repair", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair_report(repair.damage(rows), rows.select("conv_id"))


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.with_token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
