"""One query per operator over its whole table, with DuckDB statements where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm import (
    archives,
    exact_dedup,
    fingerprints,
    langid,
    lexical_search,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    secrets,
    spelling,
    url_rules,
    vector_graph,
)
from millwatch.llm.common import crc_of_id, table


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    return url_rules.judge_urls(table(spark, folder, "pages"), rules)


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, folder, "documents"), n=3, num=90, den=100)


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[secrets.count_of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("bigint").alias("n_entropy"),
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archives.archive_pages(table(spark, folder, "pages")).drop("payload")


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprints.with_next(table(spark, folder, "documents"))
    rows = rows.withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_vector", fingerprints.vector_of(F.col("edited")))
    return rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_hex(F.col("vector")).alias("fingerprint"),
        fingerprints.as_hex(F.col("edited_vector")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        fingerprints.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit_model(langid.training_rows(docs))
    held_out = F.coalesce(F.pmod(crc_of_id(), F.lit(4)) == 2, F.lit(True))
    return langid.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.near_vectors(table(spark, folder, "embeddings"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_url_filters, op3_ngram_jaccard, op4_secret_scans, op5_mixing, op6_lm_scoring,
        op7_warc, op8_fingerprints, op9_packing, op10_language_id, op11_spelling_variants,
        op12_embedding_dedup, op13_lexical_search, pipeline,
    )
}

_DEDUP = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""

# All prefixes that fit, the longest first: no sweep, the same verdicts.
_URLS = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN translate(
           regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN
           regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(verdict, host, path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
hits AS (
  SELECT page_id, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host)) AS hit
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, 'allow') AS verdict
FROM p LEFT JOIN hits USING (page_id)
"""

_WARC = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 1 + CAST((i // 4) * 5 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '')
           AS payload_digest
  FROM d),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
FROM g
"""

# Every pair that shares a shingle, counted; then everything reachable.
_NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY u, v),
links AS (
  SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT l.v, r.other FROM reach r JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) l ON l.u = r.doc_id)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = w.doc_id GROUP BY w.doc_id
"""

# The hash is folded byte by byte; words meet where they agree but for one character.
_SPELLING = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
low AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS c
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT low, c, flatten(list_transform(string_split(id || ':' || low, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)) AS bytes
  FROM low),
hashed AS (
  SELECT low, c, xor(list_reduce(list_prepend(4294967295, CAST(bytes AS BIGINT[])),
    lambda s, b: xor(t[CAST((xor(s, b) & 255) + 1 AS INTEGER)], s >> 8)), 4294967295) AS h
  FROM coded, crc_table),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(low, CAST(h % length(low) AS INTEGER)) || substr(low, CAST(h % length(low) AS INTEGER) + 2)
    ELSE low END AS word, c FROM hashed),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT word, n, i, left(word, CAST(i AS INTEGER) - 1) || substr(word, CAST(i AS INTEGER) + 1) AS rest FROM places),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (m = top) AS other
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN near USING (word)),
chain(word, root) AS (
  SELECT word, word FROM words
  UNION ALL SELECT chain.word, judged.form FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NOT NULL),
ends AS (SELECT chain.word, chain.root FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""

# Terms of all documents cut out and joined with those of the items; scores in 64-bit integers.
_SEARCH = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
sized AS (SELECT doc_id, len(ts)::BIGINT AS n, ts, row_number() OVER () AS r FROM lowered WHERE len(ts) > 0),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sized),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM sized) SEMI JOIN wanted USING (term) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term, docs),
gain AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS g
  FROM tf JOIN weight USING (term) JOIN sized USING (r), whole),
score AS (SELECT item_id, r, doc_id, CAST(sum(g) AS BIGINT) AS score FROM gain JOIN wanted USING (term) GROUP BY item_id, r, doc_id),
placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0)
SELECT doc_id, item_id, rank, score FROM placed WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": _DEDUP,
    "op2_url_filters": _URLS,
    "op3_ngram_jaccard": _NEAR,
    "op7_warc": _WARC,
    "op11_spelling_variants": _SPELLING,
    "op13_lexical_search": _SEARCH,
}
