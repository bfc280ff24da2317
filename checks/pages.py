"""Checks of page extraction and programme requirements."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as B
from checks.sql import SPACE, query
from checks.tidy import big, dbl, tidy
from termscope.operators import extract as X
from termscope.operators import requirements as Q

SITE = "https://site.example"
HREF = "^/[A-Za-z]+$"
CODE = r"\b([A-Z]{2,8})\s+(\d{4})\b"


def page_links(spark, sf_dir):
    return X.page_links(B.read(spark, sf_dir, "pages"), SITE, HREF, "html", ("page_id",))


def page_text(spark, sf_dir):
    return X.page_text(B.read(spark, sf_dir, "pages"), "html", "text").select("page_id", "text")


def requirement_rules(spark, sf_dir):
    pages = B.read(spark, sf_dir, "pages").withColumn("program_code", F.concat(F.lit("P"), "page_id"))
    rules = Q.requirement_rules(pages, ("h1",), "html", CODE).drop("url", "courses")
    return tidy(rules)


def listing(spark, sf_dir):
    """A listing page around every supplier, with a wrapper in every third."""
    key, name = F.col("s_suppkey"), F.col("s_name")

    def entry(n, who, rating):
        return F.concat(
            F.lit('<li><a href="/course/9/'), n.cast("string"), F.lit('">'), who, F.lit('</a><p id="rating">'),
            rating, F.lit('</p><p id="difficulty">'), (n % 5).cast("string"), F.lit("</p></li>"),
        )

    rating = F.when(key % 4 == 0, "—").otherwise(F.concat((key % 5).cast("string"), F.lit(".5")))
    first, second = entry(key, name, rating), entry(key + 1, F.concat(F.lit("Roe, "), name), F.lit("1.5"))
    body = F.concat(first, second)
    html = F.when(key % 3 == 0, F.concat(F.lit("<div>"), body, F.lit("</div>"))).otherwise(body)
    return B.read(spark, sf_dir, "supplier").select(key.alias("course_id"), html.alias("raw_html"))


def page_ratings(spark, sf_dir):
    return X.page_ratings(listing(spark, sf_dir), SITE)


def page_ratings_innermost(spark, sf_dir):
    return X.page_ratings(listing(spark, sf_dir), SITE, innermost=True)


def review_blocks(spark, sf_dir):
    """Every customer's comment page: two reviews in one section."""
    key = F.col("c_custkey")
    one = F.concat(F.lit("<div><b>Spring 2024</b><p>Updated 9/1/24</p><p>"), "c_name",
                   F.lit("</p>\n<p>good   "), "c_mktsegment", F.lit("</p></div>"))
    two = F.concat(F.lit("<div>Fall 2023<br>Updated 10/1/23<br>"), (key % 7).cast("string"),
                   F.when(key % 2 == 0, "<br>more").otherwise(""), F.lit("</div>"))
    pages = B.read(spark, sf_dir, "customer").select(
        key.alias("course_id"), F.concat(F.lit("<section>"), one, two, F.lit("</section>")).alias("raw_html")
    )
    rows = X.review_blocks(pages).select("course_id", "position", F.array_join("lines", "|").alias("lines"))
    return tidy(rows)


# Requirement items from line items: supplier = programme, order = group.
def items(spark, sf_dir):
    part = B.course(spark, sf_dir).select("course_id", "subject_id", "catalog_nbr")
    line = B.read(spark, sf_dir, "lineitem")
    text = F.concat(F.lit("take "), F.lower("subject_id"), F.lit("  "), F.col("catalog_nbr").cast("string"),
                    F.lit(" or ABCDEFGHI 1000, nope 99999, XX 1234"))
    plain = F.concat(F.lit("Any elective of "), F.repeat(F.col("l_returnflag"), 130))
    return line.join(part, F.col("l_partkey") == F.col("course_id")).select(
        F.col("l_suppkey").alias("source_id"), F.concat(F.lit("P"), "l_suppkey").alias("program_code"),
        F.col("l_orderkey").alias("heading_index"), F.col("l_linenumber").alias("rule_index"),
        F.col("l_linenumber").alias("display_order"), F.col("l_linestatus").alias("group_name"),
        F.when(F.col("l_quantity") > 5, text).otherwise(plain).alias("text"),
    )


def requirement_codes(spark, sf_dir):
    rules = Q.rules_from_items(items(spark, sf_dir), CODE)
    codes = rules.select("rule_code", "rule_type", "rule_label", F.explode_outer("courses").alias("c"))
    flat = codes.select("rule_code", "rule_type", "rule_label", "c.subject_id", "c.catalog_nbr")
    return tidy(Q.link_courses(flat, B.course(spark, sf_dir)))


def requirement_groups(spark, sf_dir):
    rules = Q.with_rule_ids(Q.rules_from_items(items(spark, sf_dir), CODE))
    return tidy(Q.group_rows(rules).drop("group_id", "program_id"))


def run_ledger(spark, sf_dir):
    rules = Q.rules_from_items(items(spark, sf_dir), CODE)
    supplier = B.read(spark, sf_dir, "supplier")
    sources = supplier.select(F.col("s_suppkey").alias("source_id"))
    errors = supplier.filter(F.col("s_acctbal") < 0).select(
        F.col("s_suppkey").alias("source_id"), F.lit("bad page").alias("error")
    )
    return tidy(Q.run_ledger(sources, rules, errors))


def _broken(spark, sf_dir):
    """All pages, every tenth with markup that no parser reads."""
    bad = F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("<![oops[x]]>"))).otherwise(F.col("html"))
    return B.read(spark, sf_dir, "pages").select(
        F.col("page_id").alias("source_id"), F.concat(F.lit("P"), "page_id").alias("program_code"), "url", bad.alias("raw_html"))


def ledger_from_pages(spark, sf_dir):
    pages = _broken(spark, sf_dir)
    rules = Q.requirement_rules(pages, ("h1",), "raw_html", CODE)
    ledger = Q.run_ledger(pages, rules, X.page_errors(pages))
    runs = Q.run_rows(ledger, "h1", F.timestamp_seconds(F.lit(1_700_000_000)))
    lines = runs.join(ledger.select("source_id", "parse_status", "parse_error"), "source_id")
    return tidy(lines.select(
        "run_id", "source_id", "parser_name", "run_status", "parse_status", "parse_error",
        F.col("completed_at").cast("string").alias("completed_at"), F.col("rules_written").isNull().alias("nothing_written")))


def requirement_ids(spark, sf_dir):
    rules = Q.with_rule_ids(Q.rules_from_items(items(spark, sf_dir), CODE))
    return tidy(rules.select("rule_code", "program_id", "group_id", "rule_id"))


def _joined(spark, sf_dir):
    line = B.read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("program_id"),
        F.concat_ws("-", "l_suppkey", "l_orderkey").alias("group_id"),
        F.concat_ws("-", "l_suppkey", "l_orderkey", "l_linenumber").alias("rule_id"),
        F.col("l_partkey").alias("course_id"),
    )
    program = B.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("program_id"), F.col("s_name").alias("program_code")
    )
    return line, Q.requirement_join(
        program, line.select("program_id", "group_id").distinct(),
        line.select("group_id", "rule_id").distinct(), line.select("rule_id", "course_id").distinct(),
    )


def requirement_signals(spark, sf_dir):
    line, joined = _joined(spark, sf_dir)
    demand = line.select("program_id", (F.col("course_id") + F.col("program_id") % 2).alias("course_id")).distinct()
    return tidy(Q.requirement_signals(joined, demand))


def demand_score(spark, sf_dir):
    line, joined = _joined(spark, sf_dir)
    c = F.col("course_id")
    demand = line.select("program_id", "course_id").distinct().withColumns({
        "historical_demand": F.when(c % 5 != 0, c % 13 / 10), "fill_ratio": c % 7 / 5,
        "waitlist_ratio": c % 3 / 4, "course_forum_signal": F.when(c % 4 != 0, c % 11 / 8),
        "difficulty_demand_relief": (c % 9 - 4) / 4,
    })
    return tidy(Q.demand_score(Q.requirement_signals(joined, demand), baseline=-1.0))


QUERIES = {
    "page_links": page_links,
    "page_text": page_text,
    "page_ratings": page_ratings,
    "page_ratings_innermost": page_ratings_innermost,
    "review_blocks": review_blocks,
    "requirement_rules": requirement_rules,
    "requirement_codes": requirement_codes,
    "requirement_groups": requirement_groups,
    "run_ledger": run_ledger,
    "ledger_from_pages": ledger_from_pages,
    "requirement_ids": requirement_ids,
    "requirement_signals": requirement_signals,
    "demand_score": demand_score,
}

_REQ = {
    "item": """
        SELECT l_suppkey AS source_id, 'P' || l_suppkey || '_group_' || l_orderkey AS group_code,
               'P' || l_suppkey || '_group_' || l_orderkey || '_rule_' || l_linenumber AS rule_code,
               l_linenumber AS display_order, l_linestatus AS group_name, l_quantity > 5 AS coded,
               subject_id, catalog_nbr,
               CASE WHEN l_quantity > 5 THEN 'take ' || lower(subject_id) || '  ' || catalog_nbr ||
                    ' or ABCDEFGHI 1000, nope 99999, XX 1234'
                    ELSE 'Any elective of ' || repeat(l_returnflag, 130) END AS text
        FROM lineitem JOIN course ON l_partkey = course_id""",
    "code": """
        SELECT rule_code, text, 'course_list' AS rule_type, upper(subject_id) AS subject_id, catalog_nbr
        FROM item WHERE coded
        UNION ALL SELECT rule_code, text, 'course_list', 'XX', 1234 FROM item WHERE coded
        UNION ALL SELECT rule_code, text, 'text_rule', NULL, NULL FROM item WHERE NOT coded""",
    "first_course": """
        SELECT subject_id, catalog_nbr, min(course_id) AS course_id FROM course GROUP BY 1, 2""",
    "line": """
        SELECT l_suppkey AS program_id, l_suppkey || '-' || l_orderkey AS group_id,
               l_suppkey || '-' || l_orderkey || '-' || l_linenumber AS rule_id,
               l_partkey AS course_id FROM lineitem""",
    "counts": """
        SELECT course_id, count(DISTINCT program_id) AS required_by_major_count,
               count(DISTINCT group_id) AS requirement_group_count,
               count(DISTINCT rule_id) AS requirement_rule_count FROM line GROUP BY 1""",
    "inputs": """
        SELECT program_id, c.course_id, 1 AS major_required, required_by_major_count,
               requirement_group_count, requirement_rule_count,
               CASE WHEN c.course_id % 5 <> 0 THEN (c.course_id % 13) / 10.0 END AS historical_demand,
               (c.course_id % 7) / 5.0 AS fill_ratio, (c.course_id % 3) / 4.0 AS waitlist_ratio,
               CASE WHEN c.course_id % 4 <> 0 THEN (c.course_id % 11) / 8.0 END AS course_forum_signal,
               (c.course_id % 9 - 4) / 4.0 AS difficulty_demand_relief
        FROM (SELECT DISTINCT program_id, course_id FROM line) d JOIN counts c USING (course_id)""",
    "scored": """
        SELECT *, major_required + 0.25 * ln(1.0 + required_by_major_count) AS major_requirement_demand
        FROM inputs""",
    "total": """
        SELECT *, -1.0 + major_requirement_demand + coalesce(historical_demand, 0) + fill_ratio +
               waitlist_ratio + coalesce(course_forum_signal, 0) - difficulty_demand_relief
               AS demandibility_score FROM scored""",
}
_PEOPLE = {
    "person": """
        SELECT s_suppkey AS course_id, s_suppkey % 3 = 0 AS wrapped, s_name AS professor_name, 1 AS place,
               CASE WHEN s_suppkey % 4 <> 0 THEN (s_suppkey % 5) || '.5' END AS rating,
               (s_suppkey % 5)::VARCHAR AS difficulty FROM supplier
        UNION ALL SELECT s_suppkey, s_suppkey % 3 = 0, s_name || ' Roe', 2, '1.5',
               ((s_suppkey + 1) % 5)::VARCHAR FROM supplier""",
    "entry": """
        SELECT course_id, p.professor_name, wrapped, place, CASE WHEN place = 1 THEN p.professor_name
               ELSE 'Roe, ' || replace(p.professor_name, ' Roe', '') END AS shown, rating, difficulty
        FROM person p""",
}
# The first entry that shows the name decides: "Roe, X" never shows "X Roe".
_RATINGS = """
    SELECT e.course_id, e.professor_name, f.rating, f.difficulty
    FROM entry e LEFT JOIN entry f ON f.course_id = e.course_id AND f.place = 1 AND e.place = 1"""

ORACLES = {
    "page_links": f"""
        SELECT page_id, trim(regexp_replace(m[2], '{SPACE}+', ' ', 'g')) AS professor_name,
               '{SITE}' || m[1] AS professor_page_url
        FROM (SELECT page_id, [regexp_extract(a, '^<a href="([^"]*)">([^<]*)', 1),
                               regexp_extract(a, '^<a href="([^"]*)">([^<]*)', 2)] AS m
              FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/[A-Za-z]+">[^<]*')) AS a
                    FROM pages))
        GROUP BY ALL""",
    "page_ratings": query(_RATINGS, **_PEOPLE),
    "page_ratings_innermost": query(_RATINGS, **_PEOPLE),
    "review_blocks": """
        SELECT c_custkey AS course_id, (row_number() OVER (PARTITION BY c_custkey ORDER BY place) - 1)
                   AS position, lines
        FROM (SELECT c_custkey, 0 AS place, 'Spring 2024|Updated 9/1/24|' || c_name || '|good ' || c_mktsegment
                     || '|Fall 2023|Updated 10/1/23|' || (c_custkey % 7) ||
                     CASE WHEN c_custkey % 2 = 0 THEN '|more' ELSE '' END AS lines FROM customer
              UNION ALL SELECT c_custkey, 1, 'Spring 2024|Updated 9/1/24|' || c_name || '|good ' ||
                     c_mktsegment FROM customer
              UNION ALL SELECT c_custkey, 2, 'Fall 2023|Updated 10/1/23|' || (c_custkey % 7) || '|more'
              FROM customer WHERE c_custkey % 2 = 0)""",
    "requirement_codes": query(f"""
        SELECT rule_code, rule_type, substr(text, 1, 120) AS rule_label, c.subject_id,
               {big("c.catalog_nbr").replace("AS c.", "AS ")}, f.course_id::BIGINT AS course_id
        FROM code c LEFT JOIN first_course f ON f.subject_id = c.subject_id
             AND f.catalog_nbr = c.catalog_nbr""", **_REQ),
    "requirement_groups": query("""
        SELECT group_code, max(group_name) AS group_name, 'course_block' AS group_type,
               min(display_order)::BIGINT AS display_order FROM item GROUP BY group_code""", **_REQ),
    "run_ledger": query("""
        SELECT s_suppkey AS source_id,
               CASE WHEN bad THEN 'failed' ELSE 'success' END AS run_status,
               CASE WHEN bad THEN 'failed' ELSE 'parsed' END AS parse_status,
               CASE WHEN bad THEN 'bad page' END AS parse_error,
               CASE WHEN NOT bad THEN coalesce(g, 0) END AS groups_written,
               CASE WHEN NOT bad THEN coalesce(r, 0) END AS rules_written,
               CASE WHEN NOT bad THEN coalesce(c, 0) END::BIGINT AS courses_written
        FROM (SELECT s_suppkey, s_acctbal < 0 AS bad FROM supplier)
        LEFT JOIN (SELECT source_id, count(DISTINCT group_code) AS g, count(*) AS r,
                          sum(CASE WHEN coded THEN 2 ELSE 0 END) AS c FROM item GROUP BY 1)
             ON source_id = s_suppkey""", **_REQ),
    "ledger_from_pages": """
        SELECT md5(len(page_id::VARCHAR)::VARCHAR || ':' || page_id || ',2:h1,19:2023-11-14 22:13:20') AS run_id,
               page_id AS source_id, 'h1' AS parser_name, CASE WHEN bad THEN 'failed' ELSE 'success' END AS run_status,
               CASE WHEN bad THEN 'failed' ELSE 'parsed' END AS parse_status,
               CASE WHEN bad THEN 'AssertionError: unknown status keyword ''oops'' in marked section' END AS parse_error,
               '2023-11-14 22:13:20' AS completed_at, bad AS nothing_written
        FROM (SELECT page_id, page_id % 10 = 0 AS bad FROM pages)""",
    "requirement_ids": query("""
        SELECT rule_code, program_id, group_id, md5('32:' || group_id || ',' || len(rule_code) || ':' || rule_code) AS rule_id
        FROM (SELECT *, md5('32:' || program_id || ',' || len(group_code) || ':' || group_code) AS group_id
              FROM (SELECT *, md5(len('P' || source_id) || ':P' || source_id) AS program_id FROM item))""", **_REQ),
    "requirement_signals": query("""
        SELECT d.program_id, d.course_id, CASE WHEN l.course_id IS NULL THEN 0 ELSE 1 END::BIGINT AS major_required,
               coalesce(required_by_major_count, 0) AS required_by_major_count,
               coalesce(requirement_group_count, 0)::BIGINT AS requirement_group_count,
               coalesce(requirement_rule_count, 0)::BIGINT AS requirement_rule_count
        FROM (SELECT DISTINCT program_id, course_id + program_id % 2 AS course_id FROM line) d
        LEFT JOIN (SELECT DISTINCT program_id, course_id FROM line) l
             ON l.program_id = d.program_id AND l.course_id = d.course_id
        LEFT JOIN counts c ON c.course_id = d.course_id""", **_REQ),
    "demand_score": query(f"""
        SELECT {big("program_id", "course_id", "major_required", "required_by_major_count",
                    "requirement_group_count", "requirement_rule_count")},
               {dbl("historical_demand", "fill_ratio", "waitlist_ratio", "course_forum_signal",
                    "difficulty_demand_relief", "major_requirement_demand", "demandibility_score")},
               round(1 / (1 + exp(-demandibility_score)), 6) AS demandibility_probability
        FROM total""", **_REQ),
}
