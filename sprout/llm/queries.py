"""Registered queries of the operators and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontam import decontaminate
from .divergence import source_divergence
from .exact_dedup import exact_dedup
from .ftrl import quality_scores
from .jaccard import jaccard_components
from .licenses import scan_licenses
from .packing import pack
from .pii import scan_pii
from .secrets_scan import scan_secrets
from .sharding import shard
from .simhash import simhash_components
from .toxicity import toxicity_scores
from .vector_codes import vector_codes


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled splitters: eight shards of near-equal bytes."""
    return shard(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered signature rules: license labels of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees with isotonic calibration: a score for every document."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content sort: who keeps its text, for every document."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional inverted index: benchmark phrases in every document (the operator's proximity counts are left out)."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_near")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large-item matching: every piece and its place in a sequence."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set-relation skipping: every document's component of Jaccard links."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns and sliding-window entropy: secrets in every document."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns and a conditional random field: personal data in every document."""
    return scan_pii(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FTRL logistic regression on hashed n-grams: a score for every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covering masks: every document's fingerprint and component of near fingerprints."""
    return simhash_components(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cube partitioning: divergences between the sources of each language, and their terms."""
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric trees over parts: a code for every vector."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_secret_scan": op8_secret_scan,
    "op9_pii": op9_pii,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_simhash": op11_simhash,
    "op12_source_divergence": op12_source_divergence,
    "op13_vector_codes": op13_vector_codes,
}

def vector_codes_sql(rounds: int = 4) -> str:
    """The rounds of op13, one after the other, over (row, part, component) triples."""
    nearest = """a{k} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT x.r, x.p, c.e, sum((x.y - c.y) * (x.y - c.y))::BIGINT AS d
    FROM x JOIN c{k} c ON x.p = c.p AND x.i = c.i GROUP BY ALL) GROUP BY r, p),"""
    average = """c{n} AS MATERIALIZED (
  SELECT c.p, c.e, c.i, coalesce(m.y, c.y) AS y FROM c{k} c LEFT JOIN (
    SELECT a.p, a.e, x.i, ((sum(x.y) - ((sum(x.y) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS y
    FROM a{k} a JOIN x ON a.r = x.r AND a.p = x.p GROUP BY ALL) m ON m.p = c.p AND m.e = c.e AND m.i = c.i),"""
    steps = "\n".join(nearest.format(k=k) + "\n" + average.format(k=k, n=k + 1) for k in range(rounds))
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (
  SELECT r, (i - 1) // (len(v) // 4) AS p, (i - 1) % (len(v) // 4) AS i, floor(1024 * v[i]::DOUBLE)::BIGINT AS y
  FROM k, unnest(range(1, len(v) + 1)) AS t(i)),
c0 AS (SELECT p, r - 1 AS e, i, y FROM x WHERE r <= 256),
{steps}
{nearest.format(k=rounds)}
f AS (
  SELECT r, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, i)) FROM c{rounds}) AS codebooks_sha256
FROM k JOIN f USING (r)"""


LLM_ORACLES = {
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d""",
    "op5_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + 9), ' ') AS gram
  FROM i, unnest(range(1, greatest(len(w) - 8, 2))) AS r(s) WHERE len(w) > 0),
m AS (
  SELECT DISTINCT doc_id, s, l.n, array_to_string(list_slice(w, s, s + l.n - 1), ' ') AS gram
  FROM (SELECT DISTINCT n FROM win) l, d, unnest(range(1, len(w) - l.n + 2)) AS r(s)
  WHERE len(w) >= l.n),
hit AS (SELECT doc_id, s, m.n, item_id FROM m JOIN win ON m.gram = win.gram AND m.n = win.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS r(p) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT a.lang, a.source, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) a LEFT JOIN c ON c.lang = a.lang AND c.source = a.source
  GROUP BY ALL),
s AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 1)) // (l.total + l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept ON kept.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
    FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) z
  ON z.lang = a.lang AND z.source = a.source AND z.item = b.source),
terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM s WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS "rank" FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS "rank" FROM terms)
WHERE "rank" <= 200""",
    "op13_vector_codes": vector_codes_sql(),
}
