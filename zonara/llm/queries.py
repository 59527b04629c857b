"""One query for each corpus operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonara.llm import bpe, filter_audit, jaccard_join, language_id, licences, packing, pii, quality, search, sharding, source_divergence, token_counts, toxicity
from zonara.llm.common import documents

K = 10


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).drop("spans")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limits(token_counts.histogram(token_counts.lengths(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), pattern())))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op5_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return search.top_k(docs, docs.filter("doc_id % 100 = 0"), K)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(documents(spark, sf_dir)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"), pattern())


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.clustered(documents(spark, sf_dir)).drop("key")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir, "text", "lang", "source"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir, "doc_id", "text", "source"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_license_scan, op3_token_counts, op4_quality_rules, op5_exact_search, op6_pii, op7_toxicity, op8_packing, op9_bpe, op10_jaccard_join, op11_source_divergence, op12_filter_audit, op13_sharding)}

_WORDS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"""
ORACLE_SQL = {
    "op5_exact_search": f"""
WITH word AS (SELECT doc_id, {_WORDS} AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS dl FROM word GROUP BY doc_id),
corpus AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM size)::DOUBLE AS words),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
hit AS (
  SELECT q.doc_id AS query_id, d.doc_id,
    sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * dl / (words / n)))) AS score
  FROM (SELECT doc_id, term FROM tf WHERE doc_id % 100 = 0) q JOIN tf d USING (term) JOIN df USING (term) JOIN size ON size.doc_id = d.doc_id, corpus
  GROUP BY ALL),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank, doc_id, round(score, 6) AS score FROM hit)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= {K}""",
    "op10_jaccard_join": r"""
WITH RECURSIVE word AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
member AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM word WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM member GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM member a JOIN member b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y WHERE 100 * c >= 85 * (s.n + t.n - c)),
reached AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT link.y, reached.root FROM reached JOIN link ON link.x = reached.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id FROM reached LEFT JOIN size USING (doc_id) GROUP BY doc_id, n""",
    "op11_source_divergence": r"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY ALL HAVING count(DISTINCT r) >= 30),
grp AS (SELECT DISTINCT lang, source FROM doc),
own AS (SELECT lang, source, term, count(*) AS n FROM occ GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS c, k.n AS l FROM grp g JOIN kept k ON k.lang = g.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
share AS (SELECT lang, source, term, c,
  CAST(1 + 1000000000::HUGEINT * (c + 5) // (sum(c) OVER g + 5 * count(*) OVER g) AS BIGINT) AS p, CAST(1 + 1000000000::HUGEINT * (l + 5) // (sum(l) OVER g + 5 * count(*) OVER g) AS BIGINT) AS q
  FROM cell WINDOW g AS (PARTITION BY lang, source)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM share WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM listed)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op12_filter_audit": r"""
WITH mark AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
doc AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
fail AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f
  FROM doc LEFT JOIN mark USING (doc_id)),
cell AS (SELECT part, good, toxic, f, count(*) AS n FROM fail GROUP BY ALL),
letter AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
ord AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
placed AS (SELECT part, good, toxic, f, n, o, s.x AS step, f[o[s.x]] AS failed, len(list_filter(o[1:s.x - 1], lambda y: f[y])) > 0 AS earlier FROM cell, ord, letter s),
num AS (SELECT part, o, step, coalesce(sum(n) FILTER (NOT failed AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (failed AND NOT earlier), 0) AS removed, coalesce(sum(n) FILTER (failed AND earlier), 0) AS redundant,
  coalesce(sum(n) FILTER (failed AND len(list_filter(f, lambda y: y)) = 1), 0) AS unique_fails, coalesce(sum(n) FILTER (failed AND NOT earlier AND good), 0) AS good_lost, coalesce(sum(n) FILTER (failed AND NOT earlier AND toxic), 0) AS toxic_lost
  FROM placed GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda y: chr(64 + y)), '') AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley FROM num""",
}
