"""Dashboard helpers, requirement sources and the feature order."""

from pyspark.sql import functions as F

from termscope import schemas as S
from termscope.operators import dashboard as W
from termscope.operators import features as P
from termscope.operators import requirements as Q


def test_available_terms_puts_a_missing_default_first(spark):
    section = spark.createDataFrame([("1268",), ("1258",), (None,), ("1258",)], "term_id string")
    assert [tuple(r) for r in W.available_terms(section).collect()] == [
        ("1262", "Spring 2026"), ("1268", "Fall 2026"), ("1258", "Fall 2025")]
    assert [r.value for r in W.available_terms(section, "1258").collect()] == ["1268", "1258"]


def test_search_and_bands(spark):
    rows = spark.createDataFrame(
        [("CS", 1110, "Intro", "5", None, "O", 0.3), ("HIST", 2, "War_time", "6", "Ann Lee", "C", -0.2), ("X", 3, "t", "7", None, None, None)],
        "subject_id string, catalog_nbr int, title string, class_nbr string, professor_names string,"
        " enrollment_status string, overall_sentiment double")
    found = lambda q: [r.subject_id for r in W.search(rows, q).orderBy("subject_id").collect()]
    assert found("  ") == ["CS", "HIST", "X"] and found("ann") == ["HIST"] and found("1%0") == ["CS"]
    assert found("R_T") == ["HIST"] and found("zzz") == []
    bands = {r.subject_id: (r.status_badge, r.sentiment_band) for r in W.display_bands(rows).collect()}
    assert bands == {"CS": ("Open", "positive"), "HIST": ("Closed", "negative"), "X": ("Closed", "no-data")}


CONFIG = ("source_type string, school string, program_type string, program_code string, program_name string,"
          " source_url string, source_title string, source_format string, confidence string, fetched_at timestamp,"
          " parser_name string")


def config(spark, title="t"):
    row = lambda code, kind, parser: ("page", "E", "major", code, f"name {code}", f"/u/{code}", title, kind, "low", None, parser)
    return spark.createDataFrame([row("A", "html", "p"), row("B", "pdf", None), row("C", "html", None)], CONFIG)


def test_sources_pages_and_programmes(spark):
    once = Q.load_sources(spark.createDataFrame([], S.REQUIREMENT_SOURCE), config(spark))
    again = Q.load_sources(once, config(spark, "new"))
    ids = lambda df: sorted((r.program_code, r.source_id) for r in df.collect())
    assert ids(once) == ids(again) and {r.source_title for r in again.collect()} == {"new"}
    assert {r.catalog_year for r in once.collect()} == {"current"}
    raw = spark.createDataFrame([], S.REQUIREMENT_SOURCE_RAW)
    fetched = once.select(
        "source_id", F.when(F.col("program_code") == "A", "<p>x</p>").alias("raw_html"),
        F.lit(None).cast("string").alias("raw_text"), F.lit("{}").alias("raw_json"),
        F.when(F.col("program_code") == "C", "timeout").alias("parse_error"))
    stored = Q.load_raw_pages(Q.load_raw_pages(raw, fetched), fetched)
    assert sorted(r.parse_status for r in stored.collect()) == ["fetch_failed", "pending", "pending"]
    matched = Q.match_sources(config(spark), Q.sources_with_html(once, stored))
    assert [(r.program_code, r.raw_html) for r in matched.collect()] == [("A", "<p>x</p>")]
    programs = Q.program_rows(config(spark))
    assert programs.count() == 3 and {r.degree for r in programs.collect()} == {None}


def test_feature_order(spark):
    rows = spark.createDataFrame([(2, "A", 1, "x"), (1, "B", 9, "y"), (1, "B", 2, "z")],
                                 "term_numeric int, subject_id string, catalog_nbr int, class_nbr string")
    assert [r.class_nbr for r in P.feature_order(rows).collect()] == ["z", "y", "x"]


def test_professor_names_are_dealt_out_once(spark):
    links = spark.createDataFrame(
        [("1", 7, "a"), ("1", 7, "b"), ("1", 7, "a"), ("1", 7, "c"), ("2", None, "b"), (None, 7, "n"), ("1", 8, None), ("1", 9, "x")],
        "term_id string, course_id int, professor_id string")
    people = spark.createDataFrame(
        [("a", "Zoe"), ("b", "Bo"), ("c", "Zoe"), ("n", None), (None, "No")], "professor_id string, name string")
    names = W.term_professors(links, people)
    assert {tuple(r) for r in names.collect()} == {("1", 7, "Bo, Zoe"), ("2", None, "Bo"), (None, 7, "")}
    plan = names._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Aggregate(") == 2  # one partial, one final
