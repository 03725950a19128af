"""The registered queries of the text operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, divergence, exact_dedup, language_id, license_scan, near_dedup, packing, passage_dedup, pii, quality_classifier, quality_rules, sentencepiece_codec, suffix_dedup
from .common import table


def op1_compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def vocabulary(name: str) -> bytes:
    """A public tokenizer's file, read on the driver; it travels with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json").decode())


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_predictions(table(spark, sf_dir, "documents"))


def pii_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts of op7, which SQL can state."""
    return pii.find(table(spark, sf_dir, "documents")).select("doc_id", *[f"n_{kind}" for kind in pii.KINDS])


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op10, which SQL can state."""
    return op10_quality_rules(spark, sf_dir).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compact_window_passages, op2_exact_dedup, op3_minhash_near_dedup, op4_suffix_array_dedup, op5_sentencepiece,
        op6_quality_classifier, op7_pii, op8_best_fit_packing, op9_license_scan, op10_quality_rules,
        op11_source_divergence, op12_centroid_clustering, op13_language_id, pii_base_counts, quality_base_counts,
    )
}


def _cluster_sql(k: int = centroids.CENTROIDS, rounds: int = centroids.ROUNDS, n: int = centroids.DIMENSIONS) -> str:
    """The clustering as one SQL statement: each round is an assignment and a table of means."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {n} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {n})""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, q) - 1 AS k, q AS c FROM v QUALIFY k < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q, min({{'d': d, 'k': k}}) AS best
  FROM (SELECT r, vec_id, q, k, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{i})
  GROUP BY r)""")
        if i < rounds:
            parts.append(f"""m{i} AS (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c
  FROM (SELECT best.k AS k, j, sum(q[j]) AS s, count(*) AS n FROM a{i}, range(1, {n + 1}) t(j) GROUP BY ALL) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} ON c{i}.k = m{i}.k)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.k = c{rounds}.k"""

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
  row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(x) AS text_sha256
FROM t""",
    "op11_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
words AS (SELECT r, lang, source, unnest(found) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM counts GROUP BY ALL),
every AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // (coalesce(total, 0) + v) AS p
  FROM groups JOIN kept USING (lang) JOIN size USING (lang)
  LEFT JOIN counts USING (lang, source, term) LEFT JOIN totals USING (lang, source)),
whole AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 1) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q
  FROM counts JOIN size USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN every x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN every y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM every JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200""",
    "op12_centroid_clustering": _cluster_sql(),
    "pii_base_counts": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
m AS (
  SELECT doc_id,
    regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+', 0) AS email,
    regexp_extract_all(x, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)', 0) AS ip,
    list_transform(regexp_extract_all(x, '[0-9]([\x20-]?[0-9])+', 0), lambda c: regexp_replace(c, '[^0-9]', '', 'g')) AS card,
    list_transform(regexp_extract_all(x, '\+[0-9][\x20().0-9-]+[0-9]', 0), lambda c: regexp_replace(c, '[^0-9]', '', 'g')) AS phone
  FROM t)
SELECT doc_id, CAST(len(email) AS BIGINT) AS n_email,
  CAST(len(list_filter(ip, lambda a: list_max(list_transform(string_split(a, '.'),
    lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 999 ELSE coalesce(TRY_CAST(ltrim(p, '0') AS INTEGER), 0) END)) <= 255)) AS BIGINT) AS n_ip,
  CAST(len(list_filter(card, lambda d: length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(string_split(reverse(d), ''),
    lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INTEGER) ELSE (2 * CAST(c AS INTEGER)) // 10 + (2 * CAST(c AS INTEGER)) % 10 END)) % 10 = 0)) AS BIGINT) AS n_card,
  CAST(len(list_filter(phone, lambda d: length(d) BETWEEN 10 AND 15)) AS BIGINT) AS n_phone
FROM m""",
    "quality_base_counts": r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
wins AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM t WHERE len(ws) >= 3)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM wins) WHERE n >= 2),
marked AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(3) s(k) GROUP BY r),
c AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(n, 0) AS n_repeat_words
  FROM t LEFT JOIN marked USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
FROM c""",
}
