"""Programme requirements: sources, rules, course links, ledger and signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.functions.codes import sigmoid
from termscope.functions.text import course_codes
from termscope.operators.extract import has_html, requirement_items
from termscope.operators.upsert import dedupe, replace_slice, upsert, with_id
from termscope.session import spread

SOURCE_KEYS = ("program_type", "program_code", "catalog_year", "source_url")
SOURCE_UPDATES = ("school", "program_name", "source_title", "source_format", "confidence", "fetched_at")


def source_rows(config: DataFrame) -> DataFrame:
    """Source definitions with catalogue year and id filled in."""
    if "catalog_year" not in config.columns:
        config = config.withColumn("catalog_year", F.lit(D.CATALOG_YEAR))
    return with_id(config, "source_id", SOURCE_KEYS)


def load_sources(sources: DataFrame, config: DataFrame) -> DataFrame:
    """Upsert source definitions by their natural key."""
    return upsert(
        sources, source_rows(config), SOURCE_KEYS, set_cols=SOURCE_UPDATES, order_by=["fetched_at"]
    )


def program_rows(config: DataFrame) -> DataFrame:
    """One programme per code; the degree is not known."""
    last = dedupe(
        config.select("school", "program_type", "program_code", "program_name"),
        ["program_code"],
        ["program_name"],
    )
    return with_id(last, "program_id", ["program_code"]).withColumn("degree", F.lit(None).cast("string"))


def parsable_sources(config: DataFrame) -> DataFrame:
    """HTML sources that name a parser."""
    return config.filter(
        (F.col("source_format") == "html") & (F.coalesce("parser_name", F.lit("")) != "")
    )


def sources_with_html(sources: DataFrame, raw: DataFrame) -> DataFrame:
    """Stored HTML sources joined to their non-empty raw page."""
    stored = sources.filter(F.col("source_format") == "html")
    return stored.join(has_html(raw).select("source_id", "raw_html"), "source_id")


def match_sources(config: DataFrame, stored: DataFrame) -> DataFrame:
    """Configured parsable sources with the stored page of the same programme and address."""
    keys = ["program_code", "program_type", "source_url"]
    first = dedupe(stored.select(*keys, "source_id", "raw_html"), keys, ["source_id"], keep="first")
    return parsable_sources(config).join(first, keys)


def requirement_rules(
    pages: DataFrame,
    headings: Sequence[str] = D.GROUP_HEADINGS,
    html: str = "raw_html",
    code_pattern: str = D.COURSE_CODE,
) -> DataFrame:
    """One row per rule of each page (needs program_code), with its course codes."""
    return rules_from_items(requirement_items(pages, headings, html), code_pattern)


def rules_from_items(items: DataFrame, code_pattern: str = D.COURSE_CODE) -> DataFrame:
    """Codes, labels and types of extracted requirement items."""
    group = F.concat_ws("_", "program_code", F.lit("group"), F.col("heading_index").cast("string"))
    keep = [c for c in items.columns if c not in ("heading_index", "rule_index", "text")]
    rows = items.select(
        *keep,
        group.alias("group_code"),
        F.lit(D.GROUP_TYPE).alias("group_type"),
        F.concat_ws("_", group, F.lit("rule"), F.col("rule_index").cast("string")).alias("rule_code"),
        F.substring("text", 1, D.RULE_LABEL_CHARS).alias("rule_label"),
        F.col("text").alias("text_requirement"),
        course_codes(F.col("text"), code_pattern).alias("courses"),
    )
    kind = F.when(F.size("courses") > 0, "course_list").otherwise("text_rule")
    return rows.withColumn("rule_type", kind)


def with_rule_ids(rules: DataFrame) -> DataFrame:
    """Add program_id, group_id and rule_id from the natural keys."""
    ids = with_id(rules, "program_id", ["program_code"])
    ids = with_id(ids, "group_id", ["program_id", "group_code"])
    return with_id(ids, "rule_id", ["group_id", "rule_code"])


def group_rows(rules: DataFrame) -> DataFrame:
    """One row per requirement group, placed where its first rule is."""
    return rules.groupBy("group_id", "program_id", "group_code").agg(
        F.max("group_name").alias("group_name"),
        F.max("group_type").alias("group_type"),
        F.min("display_order").alias("display_order"),
    )


def rule_rows(rules: DataFrame) -> DataFrame:
    """One row per rule."""
    columns = (
        "rule_id", "group_id", "source_id", "rule_code", "rule_label", "rule_type",
        "text_requirement", "display_order",
    )
    return rules.select(*columns)


def link_courses(codes: DataFrame, course: DataFrame) -> DataFrame:
    """Add the smallest course_id with the code's subject and number, null if none."""
    first = course.groupBy("subject_id", "catalog_nbr").agg(F.min("course_id").alias("course_id"))
    return codes.join(first, ["subject_id", "catalog_nbr"], "left")


def requirement_courses(rules: DataFrame, course: DataFrame) -> DataFrame:
    """One row per course code of each rule."""
    codes = rules.select("rule_id", F.explode("courses").alias("c")).select("rule_id", "c.*")
    return link_courses(codes, course).select(
        "rule_id", "course_id", "subject_id", "catalog_nbr", F.lit(D.MATCH_TYPE).alias("match_type")
    )


def load_requirement_courses(stored: DataFrame, rules: DataFrame, course: DataFrame) -> DataFrame:
    """Replace the course rows of every rule in ``rules``, also of rules left without codes."""
    kept = stored.join(rules.select("rule_id").distinct(), "rule_id", "left_anti")
    return kept.unionByName(requirement_courses(rules, course))


def load_raw_pages(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Replace the raw page of every fetched source; the status tells whether it came."""
    came = F.col("parse_error").isNull()
    rows = fetched.withColumn("parse_status", F.when(came, "pending").otherwise("fetch_failed"))
    return replace_slice(stored, rows.select(*stored.columns), ["source_id"])


def run_ledger(sources: DataFrame, rules: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per source: run status, page status and groups, rules and courses written.

    ``errors`` has (source_id, error) for pages that failed to parse; without
    it, a source without rules simply wrote nothing.
    """
    written = rules.groupBy("source_id").agg(
        F.count_distinct("group_code").alias("groups_written"),
        F.count("*").alias("rules_written"),
        F.sum(F.size("courses")).cast("bigint").alias("courses_written"),
    )
    runs = sources.select("source_id").join(written, "source_id", "left")
    if errors is None:
        runs = runs.withColumn("parse_error", F.lit(None).cast("string"))
    else:
        failed = errors.groupBy("source_id").agg(F.max("error").alias("parse_error"))
        runs = runs.join(failed, "source_id", "left")
    good = F.col("parse_error").isNull()

    def count(c: str):
        return F.when(good, F.coalesce(c, F.lit(0))).alias(c)

    return runs.select(
        "source_id",
        F.when(good, "success").otherwise("failed").alias("run_status"),
        F.when(good, "parsed").otherwise("failed").alias("parse_status"),
        "parse_error",
        *[count(c) for c in ("groups_written", "rules_written", "courses_written")],
    )


def run_rows(ledger: DataFrame, parser_name: str, completed_at: Column) -> DataFrame:
    """Ledger lines as stored runs; the id tells the source, the parser and the time apart."""
    stamped = ledger.withColumns({"parser_name": F.lit(parser_name), "completed_at": completed_at})
    names = ["run_id", "source_id", "parser_name", "run_status", "groups_written", "rules_written", "courses_written", "completed_at"]
    counts = {c: F.col(c).cast("int") for c in names[4:7]}
    return with_id(stamped, "run_id", ["source_id", "parser_name", "completed_at"]).withColumns(counts).select(*names)


def open_runs(sources: DataFrame, parser_name: str, started_at: Column) -> DataFrame:
    """The rows that say ``running`` before a parser starts; ``run_rows`` of the same stamp replace them."""
    lines = sources.select("source_id", F.lit("running").alias("run_status")).withColumns(
        {c: F.lit(None).cast("int") for c in ("groups_written", "rules_written", "courses_written")})
    return run_rows(lines, parser_name, started_at).withColumn("completed_at", F.lit(None).cast("timestamp"))


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Attempted, succeeded and failed runs."""
    return ledger.agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("run_status") == "success").alias("successes"),
        F.count_if(F.col("run_status") == "failed").alias("failures"),
    )


def requirement_join(
    program: DataFrame, group: DataFrame, rule: DataFrame, courses: DataFrame, section: DataFrame | None = None
) -> DataFrame:
    """Programme, group, rule and course of every listed course, with its sections if given."""
    rows = (
        program.select("program_id", "program_code")
        .join(group.select("program_id", "group_id"), "program_id")
        .join(rule.select("group_id", "rule_id"), "group_id")
        .join(spread(courses.select("rule_id", "course_id"), "rule_id"), "rule_id")
        .filter(F.col("course_id").isNotNull())
    )
    if section is None:
        return rows
    return rows.join(section.select("course_id", "term_id", "class_nbr"), "course_id", "left")


def _program_counts(joined: DataFrame) -> DataFrame:
    """How many groups and rules of each programme mention each course."""
    # One pass per level on ever smaller distinct rows, instead of distinct counts that would multiply the
    # input. Both levels above the rules happen where the rows of a programme and course are dealt to.
    rules = joined.select("course_id", "program_id", "group_id", "rule_id").distinct()
    groups = spread(rules.drop("rule_id"), "program_id", "course_id").groupBy(
        "course_id", "program_id", "group_id").agg(F.count("*").alias("rules"))
    return groups.groupBy("course_id", "program_id").agg(F.count("*").alias("groups"), F.sum("rules").alias("rules"))


def _course_counts(programs: DataFrame) -> DataFrame:
    return programs.groupBy("course_id").agg(
        F.count("*").alias("required_by_major_count"),
        F.sum("groups").alias("requirement_group_count"),
        F.sum("rules").alias("requirement_rule_count"),
    )


def requirement_counts(joined: DataFrame) -> DataFrame:
    """How many programmes, groups and rules mention each course."""
    return _course_counts(_program_counts(joined))


def requirement_signals(joined: DataFrame, demand: DataFrame) -> DataFrame:
    """Add major_required and the three counts to (program_id, course_id) rows."""
    programs = _program_counts(joined)
    # Needs the counts, so that both uses read one shuffle and ``joined`` is computed once.
    listed = programs.select("program_id", "course_id", F.when(F.col("rules") > 0, 1).alias("major_required"))
    rows = demand.join(listed, ["program_id", "course_id"], "left").join(
        _course_counts(programs), "course_id", "left"
    )
    names = (
        "major_required", "required_by_major_count", "requirement_group_count", "requirement_rule_count",
    )
    return rows.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})


def demand_score(rows: DataFrame, baseline: float = 0.0) -> DataFrame:
    """Documented demand score and probability of a course for a programme.

    Needs major_required, required_by_major_count, historical_demand,
    fill_ratio, waitlist_ratio, course_forum_signal, difficulty_demand_relief;
    missing inputs count 0.
    """

    def known(c: str):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    required = known("major_required") + 0.25 * F.log1p(known("required_by_major_count"))
    with_required = rows.withColumn("major_requirement_demand", required)
    score = (
        F.lit(baseline)
        + F.col("major_requirement_demand")
        + known("historical_demand")
        + known("fill_ratio")
        + known("waitlist_ratio")
        + known("course_forum_signal")
        - known("difficulty_demand_relief")
    )
    scored = with_required.withColumn("demandibility_score", score)
    return scored.withColumn("demandibility_probability", sigmoid(F.col("demandibility_score")))
