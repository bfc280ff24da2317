"""Reviews: parsing, sentiment, aspects and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.functions.text import (
    begins_with,
    clean_text,
    normalize_name,
    sentences,
    sentiment,
    sentiment_label,
    term_counts,
    term_starts,
)
from termscope.operators.upsert import dedupe

PAGE_KEYS = ("course_id", "subject", "catalog_nbr", "professor_name", "professor_page_url")


def _first(lines: Column, pattern: str) -> Column:
    return F.get(F.filter(lines, lambda s: s.rlike(pattern)), F.lit(0))


def parse_reviews(
    blocks: DataFrame,
    season: str = D.SEASON_LINE,
    updated: str = D.UPDATED_LINE,
    prompts: Sequence[str] = D.PROMPT_LINES,
) -> DataFrame:
    """Blocks of lines to review columns; blocks without content drop.

    Needs ``lines`` and ``professor_name``; adds n_lines, review_term_label,
    updated_at, professor_review_text, course_review_text, full_review_text.
    """

    name = F.col("professor_name")

    def is_tail(s: Column) -> Column:
        return s.rlike(D.NUMERIC_LINE) | s.isin(*D.TOGGLE_LINES)

    def is_content(s: Column) -> Column:
        skip = (s == name) | (s == normalize_name(name)) | s.isin(*prompts)
        return ~(F.coalesce(skip, F.lit(False)) | s.rlike(season) | s.rlike(updated))

    def trimmed(lines: Column) -> Column:
        last = F.array_max(F.transform(lines, lambda s, n: F.when(~is_tail(s), n + 1)))
        kept = F.slice(lines, 1, F.coalesce(last, F.lit(0)))
        return F.struct(F.size(lines).alias("n_lines"), kept.alias("lines"))

    def marked(b: Column) -> Column:
        return F.struct(
            b["n_lines"].alias("n_lines"),
            b["lines"].alias("lines"),
            _first(b["lines"], season).alias("term"),
            _first(b["lines"], updated).alias("mark"),
        )

    def with_content(b: Column) -> Column:
        start = F.array_position(b["lines"], b["mark"]).cast("int") + 1
        after = F.slice(b["lines"], start, F.size(b["lines"]))
        return b.withField("content", F.filter(after, is_content))

    def review(b: Column) -> Column:
        content = b["content"]
        rest = F.array_join(F.slice(content, 2, F.size(content)), "\n\n")
        return F.struct(
            b["n_lines"].alias("n_lines"),
            b["term"].alias("review_term_label"),
            F.trim(F.replace(b["mark"], F.lit("Updated"), F.lit(""))).alias("updated_at"),
            F.get(content, F.lit(0)).alias("professor_review_text"),
            F.when(F.size(content) > 1, rest).alias("course_review_text"),
            clean_text(F.array_join(content, " ")).alias("full_review_text"),
        )

    # The block goes through the steps as an array of one element, or none once
    # a step rejects it.  As row filters, the conditions would be pushed down
    # one below the other and each would compute all steps before it again.
    found = F.filter(F.transform(F.array("lines"), trimmed), lambda b: F.size(b["lines"]) >= 3)
    found = F.filter(F.transform(found, marked), lambda b: b["mark"].isNotNull())
    found = F.filter(F.transform(found, with_content), lambda b: F.size(b["content"]) > 0)
    found = F.filter(F.transform(found, review), lambda r: r["full_review_text"] != "")
    keep = [c for c in blocks.columns if c != "lines"]
    return blocks.select(*keep, F.explode(found).alias("r")).select(*keep, "r.*")


def review_key(df: DataFrame) -> Column:
    """SHA-1 of course, page address, term, date and text; missing parts are empty."""
    parts = ("course_id", "professor_page_url", "review_term_label", "updated_at", "full_review_text")
    return F.sha1(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts]))


def distinct_reviews(parsed: DataFrame) -> DataFrame:
    """One row per review of a page: the one from the shortest, earliest block."""
    keyed = parsed.withColumn("review_key", review_key(parsed))
    return dedupe(keyed, ["review_key"], ["n_lines", "position"], keep="first")


def score_reviews(
    reviews: DataFrame,
    positive: Sequence[str] = D.POSITIVE_WORDS,
    negative: Sequence[str] = D.NEGATIVE_WORDS,
) -> DataFrame:
    """Add the sentiment of the full, professor and course texts and the label."""

    def score(c: str) -> Column:
        return sentiment(F.col(c), positive, negative)

    scored = reviews.select(
        "*",
        F.coalesce(score("full_review_text"), F.lit(0.0)).alias("sentiment_score"),
        score("professor_review_text").alias("professor_sentiment_score"),
        score("course_review_text").alias("course_sentiment_score"),
    )
    label = sentiment_label(F.col("sentiment_score"), on_null="unknown")
    return scored.withColumn("sentiment_label", label)


def match_unique_name(pages: DataFrame, professors: DataFrame, name: str = "professor_name") -> DataFrame:
    """Add professor_id where exactly one professor has the (normalised) name."""
    known = professors.groupBy(F.lower(normalize_name(F.col("name"))).alias("match")).agg(
        F.min("professor_id").alias("professor_id"), F.max("professor_id").alias("other_id")
    )
    unique = known.filter(F.col("professor_id") == F.col("other_id")).drop("other_id")
    keyed = pages.withColumn("match", F.lower(normalize_name(F.col(name))))
    return keyed.join(unique, "match", "left").drop("match")


def review_rows(
    blocks: DataFrame,
    professors: DataFrame,
    positive: Sequence[str] = D.POSITIVE_WORDS,
    negative: Sequence[str] = D.NEGATIVE_WORDS,
) -> DataFrame:
    """Blocks of professor pages to scored review rows with keys and ids."""
    named = blocks.withColumn("professor_name", normalize_name(F.col("professor_name")))
    reviews = distinct_reviews(parse_reviews(named)).drop("position", "n_lines")
    return match_unique_name(score_reviews(reviews, positive, negative), professors)


def summarize_reviews(reviews: DataFrame) -> DataFrame:
    """One summary per (course, professor name); of several pages the last address wins."""

    def share(label: str) -> Column:
        return F.count_if(F.col("sentiment_label") == label)

    date = F.when(F.col("updated_at") != "", clean_text(F.col("updated_at")))
    pages = reviews.groupBy("course_id", "professor_name", "professor_page_url").agg(
        F.max("professor_id").alias("professor_id"),
        F.max("subject").alias("subject"),
        F.max("catalog_nbr").alias("catalog_nbr"),
        F.count("*").alias("review_count"),
        share("positive").alias("positive_review_count"),
        share("neutral").alias("neutral_review_count"),
        share("negative").alias("negative_review_count"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.avg("professor_sentiment_score").alias("avg_professor_sentiment_score"),
        F.avg("course_sentiment_score").alias("avg_course_sentiment_score"),
        F.max(date).alias("most_recent_review_at"),
        F.max(F.try_to_date(date, "M/d/yy")).alias("most_recent_review_date"),
    )
    demand = F.log1p("review_count") * (F.col("avg_sentiment_score") + 1.0)
    last = dedupe(pages, ["course_id", "professor_name"], ["professor_page_url"], keep="last")
    return last.withColumn("sentiment_demand_score", demand)


def aspects(
    reviews: DataFrame,
    keywords: Mapping[str, Sequence[str]] = D.ASPECT_KEYWORDS,
    positive: Sequence[str] = D.POSITIVE_WORDS,
    negative: Sequence[str] = D.NEGATIVE_WORDS,
    exam_terms: Sequence[str] = D.EXAM_TERMS,
    project_terms: Sequence[str] = D.PROJECT_TERMS,
    assignment_terms: Sequence[str] = D.ASSIGNMENT_TERMS,
) -> DataFrame:
    """One row per review and mentioned aspect, with the matching sentences' score."""
    terms = [t for name in keywords for t in keywords[name]]

    def marked(s: Column) -> Column:
        return F.struct(s.alias("s"), term_starts(F.lower(s), terms).alias("starts"))

    keep = [c for c in reviews.columns if c != "full_review_text"]
    split = reviews.select(*keep, F.transform(sentences(F.col("full_review_text")), marked).alias("pairs"))

    def found(name: str) -> Column:
        def hit(p: Column) -> Column:
            return F.exists(p["starts"], lambda t: begins_with(t, keywords[name], terms))

        return F.struct(F.lit(name).alias("aspect_name"), F.transform(F.filter("pairs", hit), lambda p: p["s"]).alias("hits"))

    rows = split.select(*keep, F.explode(F.array(*[found(a) for a in keywords])).alias("a"))
    text = mentioned(
        rows.select(
            *keep,
            "a.aspect_name",
            F.size("a.hits").alias("mention_count"),
            F.array_join("a.hits", " ").alias("supporting_text"),
        )
    )
    scored = text.withColumn("sentiment_score", sentiment(F.col("supporting_text"), positive, negative))
    names = ("exam_mentions", "project_mentions", "assignment_mentions")
    counts = F.array(*term_counts(F.col("supporting_text"), (exam_terms, project_terms, assignment_terms)))
    return scored.withColumn("counts", counts).select(
        *scored.columns,
        sentiment_label(F.col("sentiment_score")).alias("sentiment_label"),
        *[F.col("counts")[k].alias(name) for k, name in enumerate(names)],
    )


def mentioned(rows: DataFrame) -> DataFrame:
    """Keep aspects with at least one mention."""
    return rows.filter(F.col("mention_count") > 0)


def summarize_aspects(rows: DataFrame) -> DataFrame:
    """Aspect totals per (course, professor name, aspect).

    Totals are taken per professor id, subject and number first; where one name
    has several of those, the one whose first review key is largest wins.
    """
    label = F.col("sentiment_label")
    totals = rows.groupBy(
        "course_id", "professor_name", "aspect_name", "professor_id", "subject", "catalog_nbr"
    ).agg(
        F.count("*").alias("review_mentions"),
        F.sum("mention_count").alias("total_mentions"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.count_if(label == "positive").alias("positive_mentions"),
        F.count_if(F.coalesce(label, F.lit("neutral")) == "neutral").alias("neutral_mentions"),
        F.count_if(label == "negative").alias("negative_mentions"),
        F.sum("exam_mentions").alias("exam_mentions"),
        F.sum("project_mentions").alias("project_mentions"),
        F.sum("assignment_mentions").alias("assignment_mentions"),
        F.min("review_key").alias("first_key"),
    )
    return dedupe(totals, ["course_id", "professor_name", "aspect_name"], ["first_key"]).drop("first_key")
