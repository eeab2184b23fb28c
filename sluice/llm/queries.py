"""The operators as queries over the given tables, and an SQL statement for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import read, staged
from sluice.llm.exact_dedup import duplicate_groups
from sluice.llm.filter_audit import filter_audit
from sluice.llm.html_text import html_text
from sluice.llm.jaccard import near_duplicates
from sluice.llm.language import fitted, held_out, predicted
from sluice.llm.line_dedup import line_dedup
from sluice.llm.mixing import temperature_mix
from sluice.llm.packing import best_fit_packing
from sluice.llm.prefix_trie import numbered_turns, prefix_trie, spliced
from sluice.llm.token_counts import token_counts
from sluice.llm.url_filter import SOFT_TERMS, STRICT, judged_urls
from sluice.llm.vamana import nearest
from sluice.llm.winnowing import next_compared

#: Length of a packed sequence in tokens, and the id that ends a document.
SEQUENCE, END = 4096, 1


def vocabulary(name: str) -> str:
    """A public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vamana(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged_urls(read(spark, folder, "pages"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text(read(spark, folder, "pages"))


def op4_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = temperature_mix(read(spark, folder, "documents"), entropy=0.5, repeats=4.0, keep_text=False)
    return mixed.select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "place")


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").withColumn("held_out", held_out())
    found = fitted(documents.filter("NOT held_out"))
    return predicted(documents.select("doc_id", "held_out", "text"), found).drop("text")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing(read(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), END, SEQUENCE)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup(read(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = duplicate_groups(read(spark, folder, "documents"), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op12_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return next_compared(read(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read(spark, folder, "conversations")
    c = F.col("conv_id").cast("long")
    heads = conversations.select(c.alias("conv_id"), (c - c % 5).alias("donor"), (F.crc32(c.cast("string")) % 9).cast("int").alias("h"))
    heads = heads.filter("conv_id IS NOT NULL").distinct()
    return prefix_trie(spliced(staged(numbered_turns(conversations)), heads)).drop("node", "parent")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vamana": op1_vamana,
    "op2_url_filter": op2_url_filter,
    "op3_html_text": op3_html_text,
    "op4_temperature_mix": op4_temperature_mix,
    "op5_language": op5_language,
    "op6_token_counts": op6_token_counts,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_filter_audit": op11_filter_audit,
    "op12_winnowing": op12_winnowing,
    "op13_prefix_trie": op13_prefix_trie,
}

#: Lower case for A-Z only.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _hits(terms: tuple[str, ...]) -> str:
    """The number of terms that stand alone in host and path."""
    return " + ".join(f"CAST(regexp_matches(lower(host || path), '(^|[^\\p{{L}}\\p{{N}}]){t}([^\\p{{L}}\\p{{N}}]|$)') AS INT)" for t in terms)

#: Words between white space.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: CRC-32 of an integer's decimal digits, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

STATEMENTS: dict[str, str] = {
    "op2_url_filter": f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') > 0 AS whole FROM pages),
r AS (SELECT page_id, CASE WHEN whole THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM u),
h AS (
  SELECT page_id, {LOWER.format("regexp_extract(rest, '^[^/]*')")} AS host, substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM r),
m AS (
  SELECT *, {_hits(STRICT)} AS strict_hits, {_hits(SOFT_TERMS)} AS soft_hits, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN strict_hits > 0 OR soft_hits > 1 THEN 'block' ELSE 'allow' END AS verdict,
       CAST(strict_hits AS INT) AS strict_hits, CAST(soft_hits AS INT) AS soft_hits
FROM m""",
    "op8_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
k AS (SELECT *, {LOWER.format("trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, s.first IS NOT NULL AND s.first < k.doc_id AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op9_exact_dedup": f"""
WITH t AS (SELECT doc_id, sha256({LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op11_filter_audit": f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
f AS (
  SELECT doc_id, part, CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
    + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS mask
  FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
e AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM e a, e b, e c, e d, e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
p AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM o),
s AS (SELECT p.*, e.f AS filter, e.bit, (SELECT coalesce(sum(x.bit), 0) FROM e x WHERE strpos(filter_order, x.f) < step)::INT AS state
      FROM p JOIN e ON substr(filter_order, step, 1) = e.f),
r AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN mask & (state | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & state = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & state > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & state = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & state = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, filter)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r""",
    "op13_prefix_trie": f"""
WITH t AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key, strlen(coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos, key, b FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS donor, {CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
g AS (SELECT c.conv_id, o.pos, o.key, o.b FROM c JOIN o ON o.conv_id = c.donor AND o.pos <= c.h),
k AS (SELECT c.conv_id, c.h, count(g.pos) AS have FROM c LEFT JOIN g USING (conv_id) GROUP BY c.conv_id, c.h),
r AS (SELECT * FROM g UNION ALL SELECT o.conv_id, o.pos - k.h + k.have, o.key, o.b FROM o JOIN k USING (conv_id) WHERE o.pos > k.h),
s AS (SELECT k.conv_id, coalesce(list(r.key ORDER BY r.pos) FILTER (r.key IS NOT NULL), []) AS keys, list(r.b ORDER BY r.pos) AS sizes
      FROM k LEFT JOIN r USING (conv_id) GROUP BY k.conv_id),
p AS (
  SELECT conv_id, depth, sha256(array_to_string(keys[1:depth], '')) AS path, CASE WHEN depth > 0 THEN sha256(array_to_string(keys[1:depth - 1], '')) END AS parent,
    CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS b, depth = len(keys) AS ends
  FROM (SELECT *, unnest(range(len(keys) + 1)) AS depth FROM s)),
n AS (
  SELECT path, depth, any_value(parent) AS parent, any_value(b) AS b, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY path, depth),
m AS (SELECT n.*, coalesce(x.n_children, 0) AS n_children FROM n LEFT JOIN (SELECT parent AS path, count(*) AS n_children FROM n GROUP BY parent) x USING (path)),
u AS (SELECT p.path, sum(CAST(m.n_children = 0 AS INT))::BIGINT AS n_leaves, sum((m.n_convs - 1) * m.b)::BIGINT AS saved_tokens
      FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY p.path)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, u.saved_tokens, m.ends_sha256
FROM m JOIN u USING (path) LEFT JOIN n q ON q.path = m.parent""",
}
