"""Section features: link layouts, professor aggregates, base columns, projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.functions import codes as C
from termscope.operators.upsert import set_if_present

LINK_COLUMNS = ("term_id", "course_id", "professor_id", "rating", "difficulty")
# (aspect, source column, output column)
ASPECT_AVERAGES = (
    ("difficulty", "avg_sentiment_score", "avg_difficulty_sentiment"),
    ("workload", "avg_sentiment_score", "avg_workload_sentiment"),
    ("professor_personality", "avg_sentiment_score", "avg_personality_sentiment"),
    ("assessments", "avg_sentiment_score", "avg_assessment_sentiment"),
    ("difficulty", "total_mentions", "avg_difficulty_mentions"),
    ("workload", "total_mentions", "avg_workload_mentions"),
    ("assessments", "exam_mentions", "avg_exam_mentions"),
    ("assessments", "project_mentions", "avg_project_mentions"),
)
REVIEW_AVERAGES = (
    ("avg_sentiment_score", "avg_course_forum_sentiment"),
    ("sentiment_demand_score", "avg_course_forum_demand"),
    ("review_count", "avg_course_forum_review_count"),
)


def resolve_link_table(links: DataFrame, section: DataFrame) -> DataFrame:
    """Link rows keyed by course; the older layout finds it through the section."""
    if "course_id" in links.columns:
        return links.select(*LINK_COLUMNS)
    owner = section.select("term_id", "class_nbr", "course_id")
    return links.join(owner, ["term_id", "class_nbr"]).select(*LINK_COLUMNS)


def apply_ratings(
    links: DataFrame, ratings: DataFrame, term: str, section: DataFrame | None = None
) -> DataFrame:
    """Write page ratings into the links of one term; missing figures change nothing.

    ``ratings`` has course_id, professor_id, rating and difficulty, and may
    have fetched_at.  Of several rows for one pair the last page's counts, without
    times the one with the highest figures; rating and difficulty stay together.
    Links of the older layout need ``section`` to find their course.
    """
    pair = ["course_id", "professor_id"]
    figures = {c: F.col(c).try_cast("decimal(10,2)") for c in ("rating", "difficulty")}
    both = F.struct("rating", "difficulty")
    order = F.struct("fetched_at", both) if "fetched_at" in ratings.columns else both
    new = ratings.withColumns(figures).groupBy(*pair).agg(F.max_by(both, order).alias("new"))
    new = new.select(*pair, F.col("new.rating").alias("new_rating"), F.col("new.difficulty").alias("new_difficulty"))
    rows = links
    if "course_id" not in links.columns:
        owner = section.select("term_id", "class_nbr", "course_id")
        rows = links.join(owner, ["term_id", "class_nbr"], "left")
    here = F.col("term_id") == term
    return rows.join(new, pair, "left").select(
        *[
            set_if_present(F.when(here, F.col(f"new_{c}")), F.col(c)).alias(c) if c in figures else c
            for c in links.columns
        ]
    )


def professor_features(
    links: DataFrame, reviews: DataFrame, aspects: DataFrame, dedupe_fanout: bool = False
) -> DataFrame:
    """Instructor, rating, review and aspect averages per (term, course).

    The averages are those of links LEFT JOIN reviews LEFT JOIN aspects, where
    every pair of matches of a link gives one row.  Those rows are not made:
    both sides are first added up per (course, professor), and a value counts
    as often as the other side has matches.  ``dedupe_fanout`` counts once.
    """
    pair = ["course_id", "professor_id"]

    def add_up(value: Column, out: str) -> list[Column]:
        return [F.sum(value.cast("double")).alias(f"sum_{out}"), F.count(value).alias(f"cnt_{out}")]

    review_sums = [c for source, out in REVIEW_AVERAGES for c in add_up(F.col(source), out)]
    by_review = reviews.filter(F.col("professor_id").isNotNull()).groupBy(*pair).agg(
        F.count("*").alias("n_reviews"),
        F.sum("review_count").cast("bigint").alias("reviews_total"),
        *review_sums,
    )
    aspect_sums = [
        c
        for aspect, source, out in ASPECT_AVERAGES
        for c in add_up(F.when(F.col("aspect_name") == aspect, F.col(source)), out)
    ]
    by_aspect = aspects.filter(F.col("professor_id").isNotNull()).groupBy(*pair).agg(
        F.count("*").alias("n_aspects"), *aspect_sums
    )
    joined = links.join(by_review, pair, "left").join(by_aspect, pair, "left")
    once = F.lit(1)
    n_reviews = once if dedupe_fanout else F.coalesce("n_reviews", once)
    n_aspects = once if dedupe_fanout else F.coalesce("n_aspects", once)

    def weigh(value: str, count: Column, weight: Column, out: str) -> list[Column]:
        return [
            F.sum(F.col(value).cast("double") * weight).alias(f"sum_{out}"),
            F.sum(count * weight).alias(f"cnt_{out}"),
        ]

    sums = []
    for c in ("rating", "difficulty"):
        sums += weigh(c, F.col(c).isNotNull().cast("int"), n_reviews * n_aspects, f"avg_prof_{c}")
    for _, out in REVIEW_AVERAGES:
        sums += weigh(f"sum_{out}", F.col(f"cnt_{out}"), n_aspects, out)
    for _, _, out in ASPECT_AVERAGES:
        sums += weigh(f"sum_{out}", F.col(f"cnt_{out}"), n_reviews, out)
    sums.append(F.sum(F.coalesce("reviews_total", F.lit(0)) * n_aspects).alias("total"))

    # Two levels: the first runs where the joins left the rows, and makes the
    # distinct instructor count a plain count in the second.
    per_person = joined.groupBy("term_id", "course_id", "professor_id").agg(*sums)
    names = ["avg_prof_rating", "avg_prof_difficulty"]
    names += [out for _, out in REVIEW_AVERAGES] + [out for _, _, out in ASPECT_AVERAGES]
    grouped = per_person.groupBy("term_id", "course_id").agg(
        F.count("professor_id").alias("instructor_count"),
        F.sum("total").alias("total_course_forum_reviews"),
        *[
            (F.sum(f"sum_{n}") / F.nullif(F.sum(f"cnt_{n}"), F.lit(0))).alias(n)
            for n in names
        ],
    )
    return grouped


def section_facts(section: DataFrame, course: DataFrame) -> DataFrame:
    """Sections with their course columns and the computed base columns."""
    s = section.join(course, "course_id")
    capacity, waitlist = F.col("capacity"), F.col("current_waitlist")
    return s.select(
        "*",
        C.term_numeric(F.col("term_id")).alias("term_numeric"),
        C.safe_ratio(F.col("seats_taken"), capacity).alias("fill_ratio"),
        C.safe_ratio(waitlist, capacity).alias("waitlist_ratio"),
        C.filled_flag(F.col("seats_taken"), capacity, waitlist).alias("filled_binary"),
        C.level_band(F.col("catalog_nbr")).alias("course_level"),
        C.season(F.col("term_id")).alias("season"),
        C.day_count(F.col("meetings_days")).alias("meeting_day_count"),
        C.is_tba(F.col("meetings_start_time")).alias("is_tba_time"),
    )


def section_base(section: DataFrame, course: DataFrame, professors: DataFrame) -> DataFrame:
    """Section facts with the professor features of their term and course."""
    return with_professors(section_facts(section, course), professors)


def with_professors(facts: DataFrame, professors: DataFrame) -> DataFrame:
    """Section rows with the professor features of their term and course."""
    return facts.join(professors, ["term_id", "course_id"], "left")


PLAIN_COLUMNS = (
    "term_id", "term_numeric", "season", "course_id", "class_nbr", "subject_id",
    "catalog_nbr", "title", "credits", "component", "has_discussion", "has_lab",
    "course_level", "enrollment_status", "capacity", "seats_taken",
    "waitlist_size", "current_waitlist", "fill_ratio", "waitlist_ratio",
    "meetings_days", "meetings_start_time", "meetings_end_time",
    "meeting_day_count", "is_tba_time",
)
ZERO_COLUMNS = (
    "instructor_count", "avg_course_forum_sentiment", "avg_course_forum_demand",
    "avg_course_forum_review_count", "total_course_forum_reviews",
    "avg_difficulty_sentiment", "avg_workload_sentiment",
    "avg_personality_sentiment", "avg_assessment_sentiment",
    "avg_difficulty_mentions", "avg_workload_mentions", "avg_exam_mentions",
    "avg_project_mentions", "prev_fill_ratio", "prev_waitlist",
    "prev_capacity", "prior_course_terms", "prior_subject_offerings",
)
NULLABLE_COLUMNS = (
    "avg_prof_rating", "avg_prof_difficulty", "avg_fill_ratio_prior_course",
    "avg_waitlist_prior_course", "avg_capacity_prior_course",
    "avg_fill_ratio_prior_subject_level", "avg_waitlist_prior_subject_level",
)


def feature_projection(df: DataFrame) -> DataFrame:
    """The 51 output columns: 18 default to 0, 7 stay null when unknown."""
    return df.select(
        *PLAIN_COLUMNS,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ZERO_COLUMNS],
        *NULLABLE_COLUMNS,
        "filled_binary",
    )


def feature_order(df: DataFrame) -> DataFrame:
    """Sort the feature table for display or export."""
    return df.orderBy("term_numeric", "subject_id", "catalog_nbr", "class_nbr")


def python_features(df: DataFrame) -> DataFrame:
    """Add meeting minutes, duration, day part and weekday flags."""
    timed = df.select(
        "*",
        C.clock_minutes(F.col("meetings_start_time")).alias("meetings_start_minutes"),
        C.clock_minutes(F.col("meetings_end_time")).alias("meetings_end_minutes"),
    )
    start = F.col("meetings_start_minutes")
    days = F.coalesce("meetings_days", F.lit(""))

    def known(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return timed.select(
        "*",
        (F.col("meetings_end_minutes") - start).alias("meeting_duration_minutes"),
        known(start.between(360, 719)).alias("is_morning"),
        known(start.between(720, 1019)).alias("is_afternoon"),
        known(start >= 1020).alias("is_evening"),
        *[F.contains(days, F.lit(letter)).alias(name) for letter, name in D.WEEKDAYS.items()],
    )
