"""Checks of the section feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as B
from checks.sql import CTE, query
from checks.tidy import tidy
from termscope.operators import features as P
from termscope.operators.history import merge_states
from termscope.operators.model import two_terms
from termscope.plans.enrollment import enrollment_features, section_state
from termscope.session import materialize


def features(spark, sf_dir):
    return tidy(enrollment_features(B.tables(spark, sf_dir), dealt=B.dealt(spark, sf_dir)))


def features_legacy(spark, sf_dir):
    return tidy(enrollment_features(B.tables(spark, sf_dir, legacy=True), dealt=B.dealt(spark, sf_dir, legacy=True)))


def meeting_features(spark, sf_dir):
    return tidy(P.python_features(B.section(spark, sf_dir)))


def features_from_state(spark, sf_dir):
    """The last term from its own sections and the stored states of the terms before, added up."""
    tables = B.tables(spark, sf_dir)
    section, course = tables["section"], tables["course"]
    _, last = two_terms(section)
    old = section.where(F.col("term_id") < last).withColumn("half", F.pmod(F.hash("term_id"), F.lit(2)))
    halves = [materialize(section_state(old.where(F.col("half") == k).drop("half"), course)) for k in (0, 1)]
    new = {**tables, "section": section.where(F.col("term_id") == last)}
    return tidy(enrollment_features(new, state=merge_states(*halves)))


def features_prior_terms(spark, sf_dir):
    """History of earlier terms only, as it is known when a term begins."""
    rows = enrollment_features(B.tables(spark, sf_dir), prior_terms_only=True)
    return tidy(rows.select(
        "term_id", "class_nbr", "prev_fill_ratio", "prior_course_terms", "avg_fill_ratio_prior_course", "avg_capacity_prior_course",
        "avg_fill_ratio_prior_subject_level", "prior_subject_offerings"))


QUERIES = {
    "enrollment_features": features,
    "features_from_state": features_from_state,
    "features_prior_terms": features_prior_terms,
    "enrollment_features_legacy": features_legacy,
    "python_features": meeting_features,
}

_TEXT = {
    "term_id", "season", "class_nbr", "subject_id", "title", "component", "enrollment_status",
    "meetings_days", "meetings_start_time", "meetings_end_time",
}
_BOOL = {"has_discussion", "has_lab"}
_DOUBLE = {
    c for c in (*P.PLAIN_COLUMNS, *P.ZERO_COLUMNS, *P.NULLABLE_COLUMNS)
    if "ratio" in c or c.startswith("avg") or c == "credits"
}


def _out(c: str, zero: bool) -> str:
    value = f"coalesce({c}, 0)" if zero else c
    if c in _TEXT | _BOOL:
        return c
    return f"round({value}::DOUBLE, 6) AS {c}" if c in _DOUBLE else f"({value})::BIGINT AS {c}"


FEATURE_SELECT = "SELECT " + ", ".join(
    [_out(c, False) for c in P.PLAIN_COLUMNS]
    + [_out(c, True) for c in P.ZERO_COLUMNS]
    + [_out(c, False) for c in P.NULLABLE_COLUMNS]
    + ["filled_binary::BIGINT AS filled_binary"]
) + " FROM feature_history"

_LEGACY = CTE["professor_features"].replace("sp.course_id", "s.course_id").replace(
    "FROM section_professor sp",
    "FROM section_professor_legacy sp JOIN section s ON s.term_id = sp.term_id"
    " AND s.class_nbr = sp.class_nbr",
)


def _minutes(c: str) -> str:
    formats = ("%I:%M%p", "%I:%M %p", "%H:%M", "%H:%M:%S")
    return f"""(SELECT hour(t) * 60 + minute(t) FROM (SELECT coalesce({", ".join(
        f"try_strptime(upper(trim({c})), '{f}')" for f in formats)}) AS t))"""


ORACLES = {
    "features_from_state": query(FEATURE_SELECT + " WHERE term_id = (SELECT max(term_id) FROM section)"),
    "features_prior_terms": query("""
        SELECT term_id, class_nbr,
               round(coalesce(last(fill_ratio ORDER BY term_numeric, md5(class_nbr)) OVER course, 0)::DOUBLE, 6) AS prev_fill_ratio,
               (count(*) OVER course)::BIGINT AS prior_course_terms,
               round((avg(fill_ratio) OVER course)::DOUBLE, 6) AS avg_fill_ratio_prior_course,
               round((avg(capacity) OVER course)::DOUBLE, 6) AS avg_capacity_prior_course,
               round((avg(fill_ratio) OVER level)::DOUBLE, 6) AS avg_fill_ratio_prior_subject_level,
               (count(*) OVER subject)::BIGINT AS prior_subject_offerings
        FROM feature_history
        WINDOW course AS (PARTITION BY course_id ORDER BY term_numeric RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               level AS (PARTITION BY subject_id, coalesce(course_level, 0) ORDER BY term_numeric
                         RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               subject AS (PARTITION BY subject_id ORDER BY term_numeric RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
    "enrollment_features": query(FEATURE_SELECT),
    "enrollment_features_legacy": query(FEATURE_SELECT, professor_features=_LEGACY),
    "python_features": query(f"""
        SELECT course_id::BIGINT AS course_id, class_nbr, term_id, enrollment_status,
               capacity::BIGINT AS capacity, seats_taken::BIGINT AS seats_taken,
               waitlist_size::BIGINT AS waitlist_size, current_waitlist::BIGINT AS current_waitlist,
               meetings_days, meetings_start_time, meetings_end_time,
               a AS meetings_start_minutes, b AS meetings_end_minutes,
               b - a AS meeting_duration_minutes,
               coalesce(a BETWEEN 360 AND 719, false) AS is_morning,
               coalesce(a BETWEEN 720 AND 1019, false) AS is_afternoon,
               coalesce(a >= 1020, false) AS is_evening,
               contains(d, 'M') AS meets_monday, contains(d, 'T') AS meets_tuesday,
               contains(d, 'W') AS meets_wednesday, contains(d, 'R') AS meets_thursday,
               contains(d, 'F') AS meets_friday, contains(d, 'S') AS meets_saturday,
               contains(d, 'U') AS meets_sunday
        FROM (SELECT *, coalesce(meetings_days, '') AS d,
                     {_minutes("meetings_start_time")}::BIGINT AS a,
                     {_minutes("meetings_end_time")}::BIGINT AS b FROM section)"""),
}
