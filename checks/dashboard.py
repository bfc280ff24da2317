"""Checks of the dashboard query."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as B
from checks.sql import query, term_of
from checks.tidy import big, dbl, tidy
from termscope.operators import dashboard as W
from termscope.session import scratch_dir
from termscope.sources import terms as T

TERM = "1068"
SEARCH = "r_ng"


def _rows(spark, sf_dir, term=None, text=""):
    return W.dashboard(B.tables(spark, sf_dir), term, text)


def dashboard_rows(spark, sf_dir):
    return tidy(W.display_bands(_rows(spark, sf_dir)))


def dashboard_term_search(spark, sf_dir):
    return tidy(_rows(spark, sf_dir, TERM, SEARCH))


def dashboard_by_term(spark, sf_dir):
    """The same from sections and links that are stored by term: one folder of each is read."""
    tables = B.tables(spark, sf_dir)
    for name in ("section", "section_professor"):
        path, schema = scratch_dir(spark), tables[name].schema
        T.store_by_term(tables[name], path)
        tables[name] = T.read_terms(spark, path, schema, [TERM]).select(*schema.names)
    return tidy(W.dashboard(tables, TERM, SEARCH))


def stored_term_bounds(spark, sf_dir):
    """First and last term of the stored sections, from the folders, and the rows of both."""
    path, section = scratch_dir(spark), B.section(spark, sf_dir)
    T.store_by_term(section, path)
    both = T.read_terms(spark, path, section.schema, T.two_stored_terms(spark, path))
    return tidy(both.groupBy("term_id").agg(F.count("*").alias("rows")))


def dashboard_counts(spark, sf_dir):
    return tidy(W.dashboard_counts(_rows(spark, sf_dir), "term_id"))


def available_terms(spark, sf_dir):
    return W.available_terms(B.section(spark, sf_dir))


QUERIES = {
    "dashboard_rows": dashboard_rows,
    "dashboard_term_search": dashboard_term_search,
    "dashboard_by_term": dashboard_by_term,
    "stored_term_bounds": stored_term_bounds,
    "dashboard_counts": dashboard_counts,
    "available_terms": available_terms,
}

# Each section looks its own reviews and people up.
_CTES = {
    "board": """
        SELECT * EXCLUDE (waitlist_size), greatest(0, coalesce(capacity, 0) - coalesce(seats_taken, 0)) AS seats_open,
               coalesce((SELECT array_to_string(list_sort(list_distinct(list(who.name))), ', ')
                         FROM professor AS who WHERE who.professor_id IN (
                             SELECT l.professor_id FROM section_professor AS l
                             WHERE l.course_id = shown.course_id AND l.term_id = shown.term_id)), 'TBA') AS professor_names,
               (SELECT avg(sentiment_demand_score) FROM review_summary AS x WHERE x.course_id = shown.course_id) AS demand_score,
               (SELECT avg(avg_sentiment_score) FROM review_summary AS x WHERE x.course_id = shown.course_id) AS overall_sentiment,
               coalesce((SELECT sum(review_count) FROM review_summary AS x WHERE x.course_id = shown.course_id), 0) AS total_reviews
        FROM (SELECT * FROM course JOIN section USING (course_id)) AS shown""",
}
_SHOWN = f"""class_nbr, subject_id, title, enrollment_status, professor_names,
    {big("course_id", "catalog_nbr", "capacity", "seats_taken", "current_waitlist", "seats_open",
         "total_reviews")}, {dbl("demand_score", "overall_sentiment")}"""

ORACLES = {
    "dashboard_rows": query(
        f"""
        SELECT term_id, {_SHOWN},
               CASE WHEN enrollment_status = 'O' THEN 'Open' ELSE 'Closed' END AS status_badge,
               CASE WHEN overall_sentiment IS NULL THEN 'no-data'
                    WHEN overall_sentiment > 0.2 THEN 'positive'
                    WHEN overall_sentiment < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_band
        FROM board""", **_CTES),
    "dashboard_term_search": query(
        f"""
        SELECT {_SHOWN} FROM board
        WHERE term_id = '{TERM}' AND (subject_id ILIKE '%{SEARCH}%'
              OR catalog_nbr::VARCHAR ILIKE '%{SEARCH}%' OR title ILIKE '%{SEARCH}%'
              OR class_nbr ILIKE '%{SEARCH}%' OR professor_names ILIKE '%{SEARCH}%')""", **_CTES),
    "dashboard_counts": query(
        """
        SELECT term_id, count(*) AS total_sections,
               count(DISTINCT (subject_id, catalog_nbr)) AS total_courses,
               count(*) FILTER (enrollment_status = 'O') AS open_sections,
               count(*) FILTER (total_reviews > 0) AS sections_with_reviews
        FROM board GROUP BY 1""", **_CTES),
    "available_terms": query("""
        SELECT term_id AS value, CASE right(term_id, 1) WHEN '1' THEN 'J-Term' WHEN '2' THEN 'Spring'
                   WHEN '3' THEN 'Summer' WHEN '4' THEN 'Fall' WHEN '8' THEN 'Fall' ELSE 'Unknown' END
                   || ' 20' || substr(term_id, 2, 2) AS label
        FROM (SELECT DISTINCT term_id FROM section UNION SELECT '1262')"""),
}
ORACLES["dashboard_by_term"] = ORACLES["dashboard_term_search"]
ORACLES["stored_term_bounds"] = """
    SELECT term_id, count(*) AS rows FROM (SELECT DISTINCT {t} AS term_id, l_partkey, l_suppkey FROM lineitem)
    WHERE term_id IN (SELECT min({t}) FROM lineitem UNION SELECT max({t}) FROM lineitem) GROUP BY term_id""".format(t=term_of("l_shipdate"))
