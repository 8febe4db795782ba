"""The queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bagminhash, compression, fertility, filteraudit, fingerprint, langid, mixing, negatives, pii, sentencepieces, urlfilter, warc, wavelet


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file; the folder is that of the package public_tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_index(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


#: The key of the queries' surrogates; a deployment passes its own.
PII_KEY = "rotate-me"


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archived(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_ok", "payload_ok", "error")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.balanced(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classed(table(spark, sf_dir, "documents"))


#: Fixed values of the query: rules (verdict, host, path).
URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]


#: Articles of fewer words are thin.
THIN_WORDS = 100


def thin(pages: DataFrame) -> DataFrame:
    """``canonical``: where a page was served whose article has fewer than ``THIN_WORDS`` words outside its tags; pages without an
    article, without html or without a URL list nothing."""
    article = F.substring_index(F.regexp_extract("html", r"(?s)<article[^>]*>(.*)", 1), "</article>", 1)
    words = F.regexp_count(F.regexp_replace(article, "<[^>]*>", " "), F.lit(r"[^\x20\x09-\x0D]+"))
    return pages.where(F.contains("html", F.lit("<article")) & (words < THIN_WORDS)).select(urlfilter.canonical(F.col("url")).alias("canonical"))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list comes from what pages hold, not from their urls: canonical URLs that served a thin article."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judged(pages, URL_RULES, thin(pages)).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH parts AS (
  SELECT page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: length(p) > 0 AND NOT starts_with(p, 'utm_') AND split_part(p, '=', 1) NOT IN ('ref', 'fbclid', 'gclid'))) AS kept
  FROM pages
), canon AS (
  SELECT page_id, html, host, path, CASE WHEN contains(url, '://') THEN
      regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN coalesce(array_to_string(kept, '&'), '') <> '' THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM parts
), listed AS (
  SELECT DISTINCT canonical FROM canon WHERE canonical IS NOT NULL AND contains(html, '<article')
    AND len(regexp_extract_all(regexp_replace(split_part(regexp_extract(html, '(?s)<article[^>]*>(.*)', 1), '</article>', 1), '<[^>]*>', ' ', 'g'), '[^\x20\x09-\x0D]+')) < 100
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM canon
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed ON ruled.canonical = listed.canonical
"""


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fertility.judged(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), tokenizer_file("byte_bpe_50k.json"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_entropy", "n_tokens_2", "chars_per_token_2", "byte_share_2", "token_entropy_2", "grp")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.train(docs))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are changed where the id is divisible by 7, anchors are the ids divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = negatives.mined(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), n AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank, other AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose id's crc32, modulo 3, isn't 1; judges all."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = compression.train(docs, table(spark, sf_dir, "labels"), F.coalesce(~held, F.lit(False)))
    return compression.scored(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted", "size_good", "size_bad")


def op13_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(filteraudit.failure_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), m AS (
  SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
    [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fail
  FROM d LEFT JOIN (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS q, max(CAST(toxic = 1 AS INTEGER)) AS x FROM labels GROUP BY doc_id) USING (doc_id)
), c AS (SELECT part, fail, count(*) AS n, sum(q) AS good, sum(x) AS toxic FROM m GROUP BY part, fail),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, e.i, f.i, g.i] AS ord FROM l a, l b, l e, l f, l g WHERE len(list_distinct([a.i, b.i, e.i, f.i, g.i])) = 5),
s AS (SELECT ord, i AS step, ord[i] AS f, ord[1:i - 1] AS earlier FROM o, l),
r AS (
  SELECT part, ord, step, f, sum(CASE WHEN NOT before AND NOT own THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT before AND own THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN before AND own THEN n ELSE 0 END) AS redundant, sum(CASE WHEN own AND len(list_filter(fail, lambda z: z)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT before AND own THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT before AND own THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT part, n, good, toxic, fail, ord, step, f, fail[f] AS own, len(list_filter(earlier, lambda k: fail[k])) > 0 AS before FROM c, s) GROUP BY part, ord, step, f
)
SELECT part, array_to_string(list_transform(ord, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

QUERIES = {
    f.__name__: f
    for f in (op1_wavelet, op2_pii, op3_fingerprint, op4_warc, op5_mixing, op6_sentencepiece, op7_urlfilter, op8_bagminhash, op9_fertility, op10_langid, op11_negatives, op12_compression, op13_filteraudit)
}
OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
 g AS (SELECT html, max(page_id) AS stored FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT p.page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN g.stored IS NOT NULL AND p.page_id IS DISTINCT FROM g.stored THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id IS DISTINCT FROM g.stored THEN g.stored END AS refers_to, true AS block_ok, true AS payload_ok, CAST(NULL AS VARCHAR) AS error
FROM p LEFT JOIN g ON p.html = g.html
"""

ORACLES: dict[str, str] = {"op4_warc": OP4_SQL, "op7_urlfilter": OP7_SQL, "op11_negatives": OP11_SQL, "op13_filteraudit": OP13_SQL}
