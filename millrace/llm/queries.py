"""Queries of the numbered operators over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    bpe,
    exact_dedup,
    hard_negatives,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    quality_rules,
    secret_scan,
    spelling,
    suffix_dedup,
    token_counts,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Files of public tokenizers on the driver; they are broadcast, never copied here.
WORD_BPE, BYTE_BPE = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.license_scan(docs).drop("spans")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("n_links")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify_split(docs)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, BYTE_BPE)


def encoded_digests(encoded: DataFrame) -> DataFrame:
    """Digest columns in place of the packed ids and the decoded text."""
    return encoded.withColumns(
        {"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    ).drop("ids", "decoded")


def op8_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded_digests(bpe.encode_decode(docs, WORD_BPE))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge_urls(pages).drop("trust", "distrust")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.secret_scan(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return hard_negatives.hard_negatives(hard_negatives.shifted(vectors), anchors=F.col("id") % 50 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_source_mix": op1_source_mix,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_ngram_join": op4_ngram_join,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_counts": op7_token_counts,
    "op8_bpe_encode_decode": op8_bpe_encode_decode,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_secret_scan": op11_secret_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}

_STOP_WORDS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

ORACLES: dict[str, str] = {
    "op4_ngram_join": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3)
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND 2
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 90 * (p.n + q.n - shared.n)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT docs.doc_id, coalesce(max(sizes.n), 0) AS n_shingles, min(reach.y) AS component_id
FROM docs LEFT JOIN sizes ON sizes.doc_id = docs.doc_id JOIN reach ON reach.x = docs.doc_id
GROUP BY docs.doc_id
""",
    "op6_quality_rules": rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM docs
), windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP_WORDS}))) AS n_stop_words
  FROM docs JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars BETWEEN 2.0 * n_words AND 20.0 * n_words AND n_symbols <= 0.1 * n_words
       AND n_dup_lines <= 0.5 * n_lines AND n_stop_words >= 0.01 * n_words AS kept
FROM m
""",
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
""",
    "op11_secret_scan": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), kinds(kind, name, least, grp, pat) AS (VALUES
  (0, 'assign', 6, 2, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 20, 0, 'AKIA[A-Z0-9]+'),
  (2, 'hex', 24, 0, '[0-9a-f]+'),
  (3, 'random', 16, 0, '[A-Za-z0-9+/=_-]+')
), pieces AS (
  SELECT r, 0 AS kind, string_split_regex(t, (SELECT pat FROM kinds WHERE kind = 0)) AS gaps,
         regexp_extract_all(t, (SELECT pat FROM kinds WHERE kind = 0)) AS m,
         regexp_extract_all(t, (SELECT pat FROM kinds WHERE kind = 0), 2) AS v FROM docs
  UNION ALL SELECT r, 1, string_split_regex(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') AS x, x FROM docs
  UNION ALL SELECT r, 2, string_split_regex(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') AS x, x FROM docs
  UNION ALL SELECT r, 3, string_split_regex(t, '[A-Za-z0-9+/=_-]+'), regexp_extract_all(t, '[A-Za-z0-9+/=_-]+') AS x, x FROM docs
), each AS (
  SELECT r, kind, unnest(range(1, len(m) + 1)) AS i, unnest(list_slice(gaps, 1, len(m))) AS gap,
         unnest(m) AS m, unnest(v) AS v
  FROM pieces WHERE len(m) > 0
), placed AS (
  SELECT r, kind, m, v, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM each
), finds AS (
  SELECT r, kind, name, e - length(m) AS s, e, m, v
  FROM placed JOIN kinds USING (kind) WHERE length(v) >= least
), bare AS (
  SELECT regexp_replace(regexp_replace(regexp_replace(t, (SELECT pat FROM kinds WHERE kind = 0), ' ', 'g'),
         'AKIA[A-Z0-9]{16,}', ' ', 'g'), '[0-9a-f]{24,}', ' ', 'g') AS t FROM docs
), samples AS (
  SELECT v AS s, true AS random FROM finds WHERE kind < 3
  UNION ALL SELECT unnest(regexp_extract_all(t, '[A-Za-z0-9+/=_-]{8,}')), false FROM bare
), met AS (
  SELECT random, substr(s, i, 1) AS a, substr(s, i + 1, 1) AS b
  FROM (SELECT random, s, unnest(range(1, length(s))) AS i FROM samples) WHERE i % 1024 <> 0
), counted AS (
  SELECT random, a, b, count(*) AS n FROM met
  WHERE regexp_full_match(a, '[0-9A-Za-z]') AND regexp_full_match(b, '[0-9A-Za-z]') GROUP BY ALL
), counts AS (
  SELECT random, a, b, sum(n) AS n FROM (
    FROM counted UNION ALL SELECT random, upper(a), upper(b), n FROM counted
    WHERE NOT random AND regexp_full_match(a || b, '[a-z][a-z]')) GROUP BY ALL
), letters AS (
  SELECT substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', i, 1) AS x FROM range(1, 63) q(i)
), labels(random) AS (VALUES (true), (false)
), chances AS (
  SELECT l.random, p.x AS a, q.x AS b,
    (coalesce((SELECT sum(n) FROM counts c WHERE c.random = l.random AND c.a = p.x AND c.b = q.x), 0)
     + 62.0::DOUBLE * CASE WHEN l.random THEN 1 / 62::DOUBLE ELSE
       (coalesce((SELECT sum(n) FROM counts c WHERE c.random = l.random AND c.b = q.x), 0) + 1)::DOUBLE
       / (coalesce((SELECT sum(n) FROM counts c WHERE c.random = l.random), 0) + 62)::DOUBLE END)
    / (coalesce((SELECT sum(n) FROM counts c WHERE c.random = l.random AND c.a = p.x), 0) + 62.0::DOUBLE) AS chance
  FROM labels l, letters p, letters q
), ratios AS (
  SELECT a, b, round(1000 * (ln(x.chance) - ln(y.chance)))::BIGINT AS ratio
  FROM chances x JOIN chances y USING (a, b) WHERE x.random AND NOT y.random
), runs AS (
  SELECT DISTINCT m FROM finds WHERE kind = 3
), scored AS (
  SELECT m FROM (SELECT m, unnest(range(1, length(m))) AS i FROM runs)
  JOIN ratios ON a = substr(m, i, 1) AND b = substr(m, i + 1, 1)
  WHERE i % 1024 <> 0 GROUP BY m HAVING sum(ratio) >= 20000
), kept AS (
  SELECT * FROM finds WHERE kind < 3 OR m IN (SELECT m FROM scored)
), listed AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(concat(name, ':', s, ':', e), ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
         string_agg(concat(name, ':', s, ':', e), ',' ORDER BY s, kind) AS spans
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE bytes AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
  FROM range(256) r(i)
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bytes
), runs AS (
  SELECT d, w, count(*) AS c FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS d,
           translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
    FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT w, c, length(w) AS l, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda k: ('0x' || substr(x, k, 2))::BIGINT)),
    lambda a, b: xor(a // 256, t[1 + xor(a % 256, b)]))) AS h
  FROM (SELECT w, c, hex(encode(d || ':' || w)) AS x FROM runs), crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % l) || substr(w, h % l + 2) ELSE w END AS word,
         sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), shorter AS (
  SELECT DISTINCT a.word AS long, a.n AS long_n, b.word AS short, b.n AS short_n
  FROM cut a JOIN words b ON b.word = a.head || a.tail
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM shorter
  UNION ALL SELECT short, long, long_n FROM shorter
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
         CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT path.word, forms.form FROM path JOIN forms ON forms.word = path.root WHERE forms.form IS NOT NULL
)
SELECT word, form, path.root, n, n_near, form_n
FROM forms JOIN path USING (word) JOIN (SELECT word AS root FROM forms WHERE form IS NULL) USING (root)
""",
}
