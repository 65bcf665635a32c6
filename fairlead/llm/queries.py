"""The driver's queries over the text tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, language, line_dedup, mix, quality, simhash, tokens, url_filter, warc

RULES = [
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
]

VOCABULARY = "word_bpe_49k.json"
MAX_TOKENS = 2048


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_counts(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, vocabulary_path()).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), outcomes, RULES)


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.archive(table(spark, sf_dir, "pages"))
    return warc.records_of(warc.read_chunks(manifest))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components_of(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False)))
    weights = language.train(docs.filter(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "held_out", "text"), weights).select("doc_id", "held_out", "lang_pred", "score")


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each rendered perspective; the operator returns the texts themselves."""
    shown = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return shown.select("conv_id", "speaker", "part", "begin", "n_turns", "n_own", F.length("rendered").cast("long").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256"), F.array_join(spans, ",").alias("mask"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text that is left; the operator returns the texts themselves."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.dedup_lines(docs, counts=("n_lines", "n_removed"))
    text = F.coalesce("text", F.lit(""))
    return cut.select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_decontaminate,
        op3_warc_chunks,
        op4_simhash,
        op5_quality_rules,
        op6_language_id,
        op7_chat_rotation,
        op8_token_counts,
        op9_line_dedup,
        op10_url_filter,
    )
}

ORACLE = {}

ORACLE["op2_decontaminate"] = r"""
WITH w AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM w WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), ks AS (SELECT DISTINCT k FROM grams
), dw AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k)
), hits AS (SELECT DISTINCT r, dw.k, i, item_id FROM dw JOIN grams USING (k, g)
), n AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS j FROM hits) GROUP BY r
), its AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN its USING (r)
"""

ORACLE["op5_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), win AS (
  SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
), twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
), rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(generate_series(i, i + 4)) AS j FROM twice) GROUP BY r
), ln AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
), s AS (
  SELECT d.r, doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(ln.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN ln ON d.r = ln.r
), f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s
), h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS failed FROM f GROUP BY host
), t AS (SELECT sum(n) AS n, sum(failed) AS f, count(*) AS k, sum(n * n) AS n2, sum(failed) / sum(n) AS m FROM h
), v AS (SELECT sum(h.n * power(h.failed / h.n - t.m, 2)) AS dev FROM h, t
), rho AS (
  SELECT t.m, CASE WHEN m * (1 - m) > 0 AND n - n2 / n - (k - 1) > 0
    THEN least(0.999e0, greatest(0.001e0, (dev / (m * (1 - m)) - (k - 1)) / (n - n2 / n - (k - 1)))) ELSE 0.001e0 END AS rho
  FROM t, v
), verdict AS (
  SELECT host, ((1 / rho - 1) * m + failed) / ((1 / rho - 1) + n) > 0.8 AS rejected FROM h, rho
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM f JOIN verdict USING (host)
"""

_UP = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_STRENGTH = """SELECT CASE WHEN n IS NULL THEN 1e3 WHEN m * (1 - m) <= 0 OR n - c - free <= 0 THEN 1e3
  ELSE 1 / least(0.999e0, greatest(0.001e0, (dev / (m * (1 - m)) - free) / (n - c - free))) - 1 END AS k FROM (
  SELECT sum(bad) / sum(n) AS m, sum(n) AS n, count(*) - count(DISTINCT up) AS free, sum(n * power(bad / n - pb / pn, 2)) AS dev,
    sum(n * n / pn) AS c
  FROM (SELECT up, CAST(n AS DOUBLE) AS n, CAST(bad AS DOUBLE) AS bad, CAST(sum(n) OVER (PARTITION BY up) AS DOUBLE) AS pn, CAST(sum(bad) OVER (PARTITION BY up) AS DOUBLE) AS pb
    FROM (SELECT {up} AS up, n, bad FROM {level} WHERE n > 0)))"""

# The chance that a host's bad share is at most 0.5, by the power series of the incomplete beta function, all of whose terms are positive.
ORACLE["op10_url_filter"] = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {_UP}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), marks AS (
  SELECT doc_id AS page_id, max(CAST(quality = 0 OR toxic = 1 AS INT)) AS bad FROM labels WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY 1
), named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', '') AS name FROM u
), counted AS (SELECT name, string_split(name, '.') AS l, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM named LEFT JOIN marks USING (page_id) GROUP BY name
), ends AS (
  SELECT *, regexp_matches(name, '{url_filter._ADDRESS}') AS address, CASE WHEN list_contains([{", ".join(f"'{x}'" for x in url_filter.SUFFIXES)}], array_to_string(l[-2:], '.')) AND len(l) > 1 THEN 2 ELSE 1 END AS k FROM counted
), hosts AS (
  SELECT name, n, bad, CASE WHEN address THEN '{url_filter.ADDRESS}' ELSE array_to_string(l[-k:], '.') END AS suffix, CASE WHEN address THEN name ELSE array_to_string(l[-k - 1:], '.') END AS domain FROM ends
), domains AS (SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix
), base AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM suffixes
), ks AS ({_STRENGTH.format(up="1", level="suffixes")}
), kd AS ({_STRENGTH.format(up="suffix", level="domains")}
), kh AS ({_STRENGTH.format(up="domain", level="hosts")}
), sm AS (SELECT suffix, (ks.k * base.m + bad) / (ks.k + n) AS m FROM suffixes, ks, base
), dm AS (SELECT domain, (kd.k * sm.m + bad) / (kd.k + n) AS m FROM domains JOIN sm USING (suffix), kd
), hm AS (SELECT name, kh.k * dm.m + bad AS a, kh.k * (1 - dm.m) + n - bad AS b FROM hosts JOIN dm USING (domain), kh
), terms AS (
  SELECT name, a, b, exp(lgamma(a + b + i) - lgamma(a + 1 + i) - lgamma(b) + (a + b + i) * ln(0.5e0)) AS term
  FROM (SELECT *, unnest(generate_series(0, CAST(ceil(b) AS BIGINT) + 200)) AS i FROM hm)
), bad AS (SELECT name FROM terms GROUP BY name HAVING sum(term) < 0.05
), rules(action, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), best AS (
  SELECT page_id, host, path, arg_max(action, length(rhost || rpath)) AS action, arg_max(rhost || rpath, length(rhost || rpath)) AS rule
  FROM (SELECT DISTINCT page_id, host, path FROM u) JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY page_id, host, path
)
SELECT n.page_id, n.host, n.path, best.rule, coalesce(action, CASE WHEN bad.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN best ON n.page_id IS NOT DISTINCT FROM best.page_id AND n.host = best.host AND n.path = best.path LEFT JOIN bad ON n.name = bad.name
"""

ORACLE["op3_warc_chunks"] = """
WITH r AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS top FROM r)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""

ORACLE["op7_chat_rotation"] = f"""
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS who, coalesce(text, '') AS text FROM conversations
), r AS (
  SELECT *, row_number() OVER w AS i, sum(length(text)) OVER w - length(text) AS before
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), q AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY (i - 1) // {chat.PART_TURNS}, before // {chat.PART_CHARS}) - 1 AS BIGINT) AS part FROM r
), p AS (SELECT DISTINCT conv_id, who AS speaker FROM t WHERE who <> 'system'
), h AS (
  SELECT q.conv_id, speaker, part, i, who = speaker AS own,
    '<|im_start|>' || CASE WHEN who = speaker THEN 'assistant' WHEN who = 'system' THEN 'system' ELSE 'user name=' || replace(who, '<|im_', '< |im_') END || chr(10) AS head,
    replace(text, '<|im_', '< |im_') || '<|im_end|>' || chr(10) AS body
  FROM q JOIN p ON q.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS s
  FROM h
)
SELECT conv_id, speaker, part, CAST(min(s - length(head)) AS BIGINT) AS begin, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
  CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars,
  sha256(string_agg(head || body, '' ORDER BY s)) AS rendered_sha256,
  coalesce(string_agg(CAST(CAST(s AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(s + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY s) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, speaker, part
"""

ORACLE["op9_line_dedup"] = r"""
WITH d AS (SELECT doc_id, text, coalesce(text, '') AS t FROM documents
), l AS (
  SELECT doc_id, t, i, ls[i] AS line FROM (SELECT doc_id, t, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, t, string_split(t, chr(10)) AS ls FROM (SELECT DISTINCT doc_id, t FROM d)))
), n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, t ORDER BY i) AS k FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), w AS (
  SELECT doc_id, t, k, [line, lead(line, 1) OVER v, lead(line, 2) OVER v] AS g, lead(line, 2) OVER v AS third
  FROM n WINDOW v AS (PARTITION BY doc_id, t ORDER BY k)
), later AS (
  SELECT doc_id, t, k FROM (SELECT doc_id, t, k, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, t, k) AS r FROM w WHERE third IS NOT NULL) WHERE r > 1
), gone AS (
  SELECT DISTINCT n.doc_id, n.t, n.i FROM n JOIN (SELECT doc_id, t, unnest([k, k + 1, k + 2]) AS k FROM later) x ON n.doc_id IS NOT DISTINCT FROM x.doc_id AND n.t = x.t AND n.k = x.k
), kept AS (
  SELECT l.doc_id, l.t, count(*) AS n_lines, count(gone.i) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS x
  FROM l LEFT JOIN gone ON l.doc_id IS NOT DISTINCT FROM gone.doc_id AND l.t = gone.t AND l.i = gone.i GROUP BY l.doc_id, l.t
)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_removed, CAST(length(x) AS BIGINT) AS n_chars, sha256(x) AS text_sha256
FROM d JOIN kept ON d.doc_id IS NOT DISTINCT FROM kept.doc_id AND d.t = kept.t
"""
