"""Registered queries of the operators and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.llm import align, decontaminate, exact, licenses, lm, mixing, near, search, spans, tokens, toxicity, urls, warc
from termscope.llm.session import prepared
from termscope.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(table(spark, sf_dir, "documents"), threshold=0.8).drop("th")


#: All pairs of documents that share a run of five words, counted in full; classes by following the links.
OP1_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM worded
), each AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) = a.n AND a.n = b.n AS equal
  FROM each AS a JOIN each AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM worded UNION SELECT y, root FROM reached JOIN links ON x = doc_id
), classes AS (
  SELECT doc_id, min(root) AS class_id FROM reached GROUP BY doc_id
)
SELECT c.doc_id, class_id, coalesce(n, 0) AS n_links, coalesce(e, 0) + 1 AS copies,
       count(*) OVER (PARTITION BY class_id) AS class_size, c.doc_id = class_id AS kept
FROM classes AS c
LEFT JOIN (SELECT x, count(*) AS n, count(*) FILTER (equal) AS e FROM links GROUP BY x) ON x = c.doc_id
"""


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    tokens.write_tokens(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokens.with_crc(tokens.read_tokens(spark, path))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = spans.without_repeats(table(spark, sf_dir, "documents"))
    return cleaned.withColumn("n_removed", F.size("removed"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=~held_out(F.col("doc_id")))
    scored = toxicity.with_score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size, source_size * 3 AS cap, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals
), filled AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS free
  FROM weighted
  WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest, free FROM filled WHERE weight * rest / free <= cap ORDER BY cap / weight LIMIT 1
), targets AS (
  SELECT source, source_size, CAST(least(cap, weight * CAST(l.rest AS DOUBLE) / l.free) AS DOUBLE) AS target
  FROM weighted, level AS l
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN before + size / 2 < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM t WINDOW same AS (PARTITION BY text)
"""


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = warc.read_records(warc.read_index(spark, path), path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS t, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY t) AS top FROM payloads
)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(16 * CAST(bits[i + 1] AS INT) + 8 * CAST(bits[i + 2] AS INT) + 4 * CAST(bits[i + 3] AS INT)
                + 2 * CAST(bits[i + 4] AS INT) + CAST(bits[i + 5] AS INT) + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM grouped
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.coverage(docs, table(spark, sf_dir, "benchmark"), threshold=0.5, min_match=5)
    best = F.array_max(F.transform("leaks", lambda x: x.covered / x.words))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").alias("n_items"),
        F.coalesce(best, F.lit(0.0)).alias("coverage"),
        F.array_sort(F.transform("leaks", lambda x: x.item_id)).alias("item_ids"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build(table(spark, sf_dir, "documents"), depth=50)
    return search.search(index, table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS k
  FROM documents
), sizes AS (
  SELECT k, doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), each AS (
  SELECT k, unnest(w) AS term FROM words
), tf AS (
  SELECT k, term, count(*)::BIGINT AS tf FROM each GROUP BY k, term
), weights AS (
  SELECT term, floor(1000 * ln((2.0 * any_value(n_docs) + 2)::DOUBLE / (2.0 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (k), corpus GROUP BY item_id, k, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


#: host, path, verdict
URL_RULES = "('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), " \
    "('com', '/fr/', 'allow'), ('com', '/de/', 'block')"


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS rules(host, path, verdict)")
    return urls.verdicts(table(spark, sf_dir, "pages"), rules, default="allow")


OP12_SQL = rf"""
WITH rules(host, path, verdict) AS (VALUES {URL_RULES}), parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM parts
), fitting AS (
  SELECT *, (SELECT list({{'l': length(r.host || r.path), 'h': length(r.host), 'rule': r.host || r.path, 'verdict': r.verdict}}
                         ORDER BY length(r.host || r.path) DESC, length(r.host) DESC)
             FROM rules AS r
             WHERE (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)) AS rs
  FROM cut AS c
)
SELECT page_id, host, path, rs[1].rule AS rule, coalesce(rs[1].verdict, 'allow') AS verdict,
       CAST(coalesce(len(rs), 0) AS BIGINT) AS n_rules
FROM fitting
"""


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.scores(align.build(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))


_QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_output": op2_token_output,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc": op9_warc,
    "op10_decontamination": op10_decontamination,
    "op11_ranked_search": op11_ranked_search,
    "op12_url_filters": op12_url_filters,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op4_license_scan": licenses.report_sql(),
    "op6_mixing": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_url_filters": OP12_SQL,
}


def _prepared(run: Query) -> Query:
    return lambda spark, sf_dir: run(prepared(spark), sf_dir)


QUERIES: dict[str, Query] = {name: _prepared(run) for name, run in _QUERIES.items()}
