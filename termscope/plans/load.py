"""Landed pages to stored tables: classes, reviews and requirements, each as one call.

Every plan takes the stored tables by name and a batch of pages and returns the
tables' new snapshots, with what could not be read beside them.  Rows that several
tables are made from are written once; their numbers are observed in that write.
The caller stores the snapshots, e.g. with ``sources.published`` or ``sources.keyed``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.operators import extract as X
from termscope.operators import features as P
from termscope.operators import ingest as I
from termscope.operators import requirements as Q
from termscope.operators import reviews as R
from termscope.operators import upsert as U
from termscope.session import materialize, spread
from termscope.sources import classes as C

Tables = Mapping[str, DataFrame]


@dataclass
class Loaded:
    """New snapshots by table name, rejected rows by kind, and how many rows the batch brought."""

    tables: dict[str, DataFrame]
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)


def _stored(rows: DataFrame, name: str, counts: dict[str, int], **more: Column) -> DataFrame:
    """``rows`` written once, with their number (and ``more`` aggregates) observed on the way."""
    seen = Observation()
    out = materialize(rows.observe(seen, F.count(F.lit(1)).alias(name), *[c.alias(n) for n, c in more.items()]))
    counts |= {n: v or 0 for n, v in seen.get.items()}
    return out


def load_class_pages(tables: Tables, pages: DataFrame) -> Loaded:
    """Response pages into raw_class, course, section, professor and section_professor."""
    counts: dict[str, int] = {}
    raw = _stored(C.to_raw_rows(C.unwrap_classes(pages)), "classes", counts)
    people = _stored(I.instructor_rows(raw), "instructors", counts)
    professor = materialize(I.load_professors(tables["professor"], people))
    return Loaded(
        {
            "raw_class": I.load_raw(tables["raw_class"], raw),
            "course": I.load_courses(tables["course"], raw),
            "section": I.load_sections(tables["section"], raw),
            "professor": professor,
            "section_professor": I.load_links(tables["section_professor"], people, professor),
        },
        {"page": C.rejected_pages(pages), "instructor": I.rejected_instructors(people)},
        counts,
    )


def load_review_pages(
    tables: Tables,
    listings: DataFrame,
    professor_pages: DataFrame,
    base_url: str,
    term: str,
    positive: Sequence[str] = D.POSITIVE_WORDS,
    negative: Sequence[str] = D.NEGATIVE_WORDS,
) -> Loaded:
    """Listing and professor pages into links, ratings, reviews, aspects and their summaries.

    ``listings`` has course_id and raw_html; ``professor_pages`` has the columns of that
    table.  Ratings go to the links of ``term``; reviews that are known stay as they are.
    """
    counts: dict[str, int] = {}
    listings, professor_pages = spread(listings), spread(professor_pages)
    links = _stored(X.page_links(listings, base_url), "links", counts)
    ratings = R.match_unique_name(X.page_ratings(listings, base_url), tables["professor"]).where("professor_id is not null")
    new = R.review_rows(X.review_blocks(professor_pages), tables["professor"], positive, negative)
    new = _stored(new.select(*tables["review"].columns), "reviews", counts)
    review = materialize(U.insert_missing(tables["review"], new, ["review_key"]))
    aspects = materialize(R.aspects(
        review.select("review_key", "course_id", "professor_id", "subject", "catalog_nbr", "professor_name", "full_review_text"),
        positive=positive, negative=negative))
    return Loaded(
        {
            "professor_link": links,
            "section_professor": P.apply_ratings(tables["section_professor"], ratings, term, tables.get("section")),
            "review": review,
            "review_summary": R.summarize_reviews(review),
            "review_aspect": aspects,
            "aspect_summary": R.summarize_aspects(aspects),
        },
        {"listing": X.page_errors(listings, key=("course_id",)),
         "professor_page": X.page_errors(professor_pages, key=("course_id", "professor_page_url"))},
        counts,
    )


def load_requirement_pages(
    tables: Tables,
    config: DataFrame,
    fetched: DataFrame,
    parser_name: str,
    completed_at: Column,
    headings: Sequence[str] = D.GROUP_HEADINGS,
    code_pattern: str = D.COURSE_CODE,
) -> Loaded:
    """Configured sources and their fetched pages into programmes, groups, rules, course links and runs.

    ``config`` has the columns of a source and parser_name; ``fetched`` has source_id,
    raw_html and parse_error.  Rules, groups and course rows of parsed sources are replaced.
    """
    counts: dict[str, int] = {}
    source = materialize(Q.load_sources(tables["requirement_source"], config))
    program = U.upsert(tables["academic_program"], Q.program_rows(config), ["program_id"])
    raw = materialize(Q.load_raw_pages(
        tables["requirement_source_raw"], fetched.withColumns({"raw_text": F.lit(None).cast("string"), "raw_json": F.lit(None).cast("string")})))
    pages = materialize(Q.match_sources(config, Q.sources_with_html(source, raw)))
    rules = Q.with_rule_ids(Q.requirement_rules(pages, headings, "raw_html", code_pattern))
    rules = _stored(rules, "rules", counts, course_codes=F.sum(F.size("courses")))
    errors = materialize(X.page_errors(pages))
    ledger = _stored(
        Q.run_ledger(pages, rules, errors), "runs", counts, failures=F.count_if(F.col("run_status") == "failed"))
    runs = Q.run_rows(ledger, parser_name, completed_at)
    courses = Q.load_requirement_courses(tables["requirement_course"], rules, tables["course"])
    return Loaded(
        {
            "requirement_source": source,
            "requirement_source_raw": raw,
            "academic_program": program,
            "requirement_group": U.upsert(tables["requirement_group"], Q.group_rows(rules), ["group_id"]),
            "requirement_rule": U.upsert(tables["requirement_rule"], Q.rule_rows(rules), ["rule_id"]),
            "requirement_course": courses,
            "requirement_run": U.upsert(tables["requirement_run"], runs, ["run_id"]),
        },
        {"page": errors},
        counts,
    )
