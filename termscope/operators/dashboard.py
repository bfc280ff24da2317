"""The per-term section dashboard."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.functions.codes import seats_open, term_label
from termscope.operators.ingest import for_term

SEARCH_COLUMNS = ("subject_id", "catalog_nbr", "title", "class_nbr", "professor_names")


def course_sentiment(summary: DataFrame) -> DataFrame:
    """Average demand and sentiment and the number of reviews per course."""
    return summary.groupBy("course_id").agg(
        F.avg("sentiment_demand_score").alias("demand_score"),
        F.avg("avg_sentiment_score").alias("overall_sentiment"),
        F.sum("review_count").alias("total_reviews"),
    )


def term_professors(links: DataFrame, professor: DataFrame) -> DataFrame:
    """Distinct professor names per (term, course), sorted and joined by ", "."""
    named = links.join(professor, "professor_id").select("term_id", "course_id", "name")
    names = F.array_join(F.array_sort(F.collect_set("name")), ", ")  # distinct names of their own would be dealt out twice
    return named.groupBy("term_id", "course_id").agg(names.alias("professor_names"))


def search(df: DataFrame, text: str, columns=SEARCH_COLUMNS) -> DataFrame:
    """Rows where any column contains ``text``, ignoring case; blank keeps all.

    ``%`` and ``_`` in the text act as wildcards.
    """
    wanted = text.strip()
    if not wanted:
        return df
    hits = [F.coalesce(F.col(c).cast("string"), F.lit("")).ilike(f"%{wanted}%") for c in columns]
    return df.filter(reduce(lambda a, b: a | b, hits))


def dashboard(tables: Mapping[str, DataFrame], term: str | None = D.DEFAULT_TERM, text: str = "") -> DataFrame:
    """Sections of one term (all terms for None) with professors and sentiment.

    ``tables`` needs section, course, professor, section_professor (keyed by
    course) and review_summary.
    """
    section, links = tables["section"], tables["section_professor"]
    if term is not None:
        section, links = for_term(section, term), for_term(links, term)
    rows = (
        section.join(tables["course"], "course_id")
        .join(course_sentiment(tables["review_summary"]), "course_id", "left")
        .join(term_professors(links, tables["professor"]), ["term_id", "course_id"], "left")
    )
    shown = search(rows, text).select(
        *([] if term is not None else ["term_id"]),
        "class_nbr",
        "course_id",
        "subject_id",
        "catalog_nbr",
        "title",
        "enrollment_status",
        "capacity",
        "seats_taken",
        "current_waitlist",
        seats_open(F.col("capacity"), F.col("seats_taken")).alias("seats_open"),
        F.coalesce("professor_names", F.lit(D.UNKNOWN_MEETING)).alias("professor_names"),
        "demand_score",
        "overall_sentiment",
        F.coalesce("total_reviews", F.lit(0)).alias("total_reviews"),
    )
    return shown


def dashboard_order(shown: DataFrame) -> DataFrame:
    """The order in which the rows are shown; for the sink, as it sorts all rows."""
    return shown.orderBy("subject_id", "catalog_nbr", "class_nbr")


def dashboard_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Totals of the shown rows, over all or per ``by`` columns."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("total_sections"),
        F.count_distinct(F.struct("subject_id", "catalog_nbr")).alias("total_courses"),
        F.count_if(F.col("enrollment_status") == "O").alias("open_sections"),
        F.count_if(F.col("total_reviews") > 0).alias("sections_with_reviews"),
    )


def display_bands(df: DataFrame) -> DataFrame:
    """Add the status badge and sentiment band shown for each row."""
    score = F.col("overall_sentiment")
    band: Column = (
        F.when(score.isNull(), "no-data")
        .when(score > 0.2, "positive")
        .when(score < -0.1, "negative")
        .otherwise("neutral")
    )
    open_now = F.col("enrollment_status").eqNullSafe("O")
    return df.select(
        "*",
        F.when(open_now, "Open").otherwise("Closed").alias("status_badge"),
        band.alias("sentiment_band"),
    )


def available_terms(section: DataFrame, default: str = D.DEFAULT_TERM) -> DataFrame:
    """Terms with their labels, newest first; the default term is always there.

    A default term that no section has is listed first.
    """
    known = section.select("term_id").filter(F.col("term_id").isNotNull()).distinct()
    extra = section.sparkSession.createDataFrame([(default,)], "term_id string")
    terms = known.withColumn("missing", F.lit(False)).union(
        extra.join(known, "term_id", "left_anti").withColumn("missing", F.lit(True))
    )
    return terms.orderBy(F.desc("missing"), F.desc("term_id")).select(
        F.col("term_id").alias("value"), term_label(F.col("term_id")).alias("label")
    )
