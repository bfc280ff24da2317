"""Checks of review parsing, sentiment, aspects and name matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as B
from checks.sql import clean, query, strings, tokens
from checks.tidy import big, dbl, tidy
from termscope import defaults as D
from termscope.functions.text import clean_text, lexicon_hits, normalize_name
from termscope.functions.text import tokens as words
from termscope.operators import reviews as R


def review_sentiment(spark, sf_dir):
    text = F.col("full_review_text")
    return tidy(B.reviews(spark, sf_dir).select(
        "review_key", "course_id", "professor_name", "updated_at",
        F.size(words(text)).alias("n_tokens"),
        lexicon_hits(text, B.POSITIVE).alias("positive_hits"),
        lexicon_hits(text, B.NEGATIVE).alias("negative_hits"),
        "sentiment_score", "professor_sentiment_score", "course_sentiment_score", "sentiment_label",
    ))


def review_summary(spark, sf_dir):
    return tidy(R.summarize_reviews(B.reviews(spark, sf_dir)))


def review_aspects(spark, sf_dir):
    return tidy(B.review_aspects(B.reviews(spark, sf_dir)))


def aspect_summary(spark, sf_dir):
    return tidy(R.summarize_aspects(B.review_aspects(B.reviews(spark, sf_dir))))


def blocks(spark, sf_dir):
    """Every document as a review block of its page (one page per language)."""
    n = F.col("n_chars")
    season = F.when(n % 7 != 0, F.array(F.concat(F.lit("fall 20"), (n % 20 + 10).cast("string"))))
    updated = F.when(
        n % 11 != 0, F.array(F.concat_ws("/", F.concat(F.lit("Updated "), (n % 12 + 1).cast("string")),
                                         (n % 28 + 1).cast("string"), F.lit("24")))
    )
    none = F.array().cast("array<string>")
    tail = F.when(n % 3 == 0, F.array(F.lit("4.5"), F.lit("-2"), F.lit("Show more"))).otherwise(none)
    body = F.filter(F.transform(F.split("text", "\n"), clean_text), lambda s: s != "")
    lines = F.concat(
        F.coalesce(season, none), F.coalesce(updated, none),
        F.when(n % 2 == 0, F.array(F.lit("Jane Doe"), F.lit("Questions"))).otherwise(none), body, tail,
    )
    return B.read(spark, sf_dir, "documents").select(
        F.length("lang").alias("course_id"), F.lit("Doe, Jane").alias("professor_name"),
        F.concat(F.lit("/r/"), "lang").alias("professor_page_url"),
        F.col("doc_id").alias("position"), lines.alias("lines"),
    )


def parse_reviews(spark, sf_dir):
    return tidy(R.distinct_reviews(R.parse_reviews(blocks(spark, sf_dir))))


def professor_match(spark, sf_dir):
    key = F.col("s_suppkey")
    form = F.when(key % 3 == 0, F.concat(F.lit("Doe ,  N"), (key / 4).cast("int").cast("string")))
    plain = F.concat(F.lit("n"), (key / 4).cast("int").cast("string"), F.lit("  DOE"))
    known = B.read(spark, sf_dir, "supplier").select(
        key.alias("professor_id"), F.when(key % 4 > 1, F.lit("Ann, ")).otherwise(F.coalesce(form, plain)).alias("name")
    )
    pages = B.read(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("N"), (F.col("c_custkey") % 40).cast("string"), F.lit(" Doe")).alias("professor_name")
    )
    return tidy(R.match_unique_name(pages, known).withColumn("shown", normalize_name(F.col("professor_name"))))


QUERIES = {
    "review_sentiment": review_sentiment,
    "review_summary": review_summary,
    "review_aspects": review_aspects,
    "aspect_summary": aspect_summary,
    "parse_reviews": parse_reviews,
    "professor_match": professor_match,
}


def _hits(values) -> str:
    return f"len(list_filter({tokens('full_review_text')}, lambda x: x IN ({strings(values)})))"


_PROMPTS = strings(D.PROMPT_LINES)
_SEASON = "regexp_matches(s, '^(?i)(Spring|Summer|Fall|Winter)\\s+[0-9]{4}$')"
_UPDATED = "regexp_matches(s, '^(?i)Updated\\s+[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$')"

ORACLES = {
    "review_sentiment": query(f"""
        SELECT review_key, {big("course_id")}, professor_name, updated_at,
               len({tokens("full_review_text")}) AS n_tokens, {_hits(B.POSITIVE)} AS positive_hits,
               {_hits(B.NEGATIVE)} AS negative_hits,
               {dbl("sentiment_score", "professor_sentiment_score", "course_sentiment_score")},
               sentiment_label FROM review"""),
    "review_summary": query(f"""
        SELECT {big("course_id", "professor_id", "review_count", "positive_review_count",
                    "neutral_review_count", "negative_review_count")},
               subject, catalog_nbr, professor_name, professor_page_url,
               {dbl("avg_sentiment_score", "avg_professor_sentiment_score",
                    "avg_course_sentiment_score", "sentiment_demand_score")},
               most_recent_review_at, most_recent_review_date::VARCHAR AS most_recent_review_date
        FROM review_summary"""),
    "review_aspects": query(f"""
        SELECT review_key, {big("course_id", "professor_id", "mention_count", "exam_mentions",
                                "project_mentions", "assignment_mentions")},
               subject, catalog_nbr, professor_name, aspect_name, supporting_text,
               {dbl("sentiment_score")}, sentiment_label FROM review_aspect"""),
    "aspect_summary": query(f"""
        SELECT {big("course_id", "professor_id", "review_mentions", "total_mentions",
                    "positive_mentions", "neutral_mentions", "negative_mentions", "exam_mentions",
                    "project_mentions", "assignment_mentions")},
               subject, catalog_nbr, professor_name, aspect_name, {dbl("avg_sentiment_score")}
        FROM aspect_summary"""),
    "parse_reviews": query(
        f"""
        SELECT length(lang)::BIGINT AS course_id, 'Doe, Jane' AS professor_name,
               '/r/' || lang AS professor_page_url, doc_id AS position, n_lines, review_term_label,
               updated_at, content[1] AS professor_review_text,
               CASE WHEN len(content) > 1
                    THEN array_to_string(content[2:], chr(10) || chr(10)) END AS course_review_text,
               full_review_text, sha1(length(lang) || '|/r/' || lang || '|' ||
                   coalesce(review_term_label, '') || '|' || updated_at || '|' || full_review_text)
                   AS review_key
        FROM full_text WHERE full_review_text <> ''
        QUALIFY row_number() OVER (PARTITION BY review_key ORDER BY n_lines, position) = 1""",
        block=f"""
        SELECT doc_id, lang, list_concat(list_concat(list_concat(list_concat(
            CASE WHEN n_chars % 7 <> 0 THEN ['fall 20' || (n_chars % 20 + 10)] ELSE []::VARCHAR[] END,
            CASE WHEN n_chars % 11 <> 0 THEN ['Updated ' || (n_chars % 12 + 1) || '/' ||
                 (n_chars % 28 + 1) || '/24'] ELSE []::VARCHAR[] END),
            CASE WHEN n_chars % 2 = 0 THEN ['Jane Doe', 'Questions'] ELSE []::VARCHAR[] END),
            list_filter(list_transform(string_split(text, chr(10)), lambda s: {clean("s")}),
                        lambda s: s <> '')),
            CASE WHEN n_chars % 3 = 0 THEN ['4.5', '-2', 'Show more'] ELSE []::VARCHAR[] END) AS lines
        FROM documents""",
        trimmed="""
        SELECT doc_id, lang, len(lines)::BIGINT AS n_lines, lines[1:coalesce(list_max(list_transform(
            lines, lambda s, i: CASE WHEN NOT (regexp_matches(s, '^-?[0-9]+([.][0-9]+)?$')
                OR s IN ('Show more', 'Show less')) THEN i END)), 0)] AS lines
        FROM block""",
        marked=f"""
        SELECT *, list_filter(lines, lambda s: {_SEASON})[1] AS review_term_label,
               list_filter(lines, lambda s: {_UPDATED})[1] AS mark
        FROM trimmed WHERE len(lines) >= 3""",
        content_lines=f"""
        SELECT *, trim(replace(mark, 'Updated', '')) AS updated_at,
               list_filter(lines[list_position(lines, mark) + 1:], lambda s:
                   NOT (s IN ('Doe, Jane', 'Jane Doe', {_PROMPTS}) OR {_SEASON} OR {_UPDATED}))
                   AS content
        FROM marked WHERE mark IS NOT NULL""",
        full_text=f"""
        SELECT *, {clean("array_to_string(content, ' ')")} AS full_review_text
        FROM content_lines WHERE len(content) > 0""",
    ),
    "professor_match": query(
        """
        SELECT c_custkey, 'N' || (c_custkey % 40) || ' Doe' AS professor_name, k.professor_id,
               'N' || (c_custkey % 40) || ' Doe' AS shown
        FROM customer c LEFT JOIN known k ON k.name = 'n' || (c_custkey % 40) || ' doe'""",
        known="""
        SELECT name, min(professor_id) AS professor_id
        FROM (SELECT s_suppkey AS professor_id, CASE WHEN s_suppkey % 4 > 1 THEN 'ann,'
                     ELSE 'n' || (s_suppkey // 4) || ' doe' END AS name FROM supplier)
        GROUP BY name HAVING count(DISTINCT professor_id) = 1""",
    ),
}
