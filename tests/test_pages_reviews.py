"""Page extraction, review parsing, aspects and requirements."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from termscope import schemas as S
from termscope.operators import extract as X
from termscope.operators import requirements as Q
from termscope.operators import reviews as R
from termscope.plans import load
from termscope.sources import html as H

SITE = "https://site.example"
PAGE = """<html><body><div><ul>
<li><a href="/course/1/2">Doe,  Jane</a><p id="rating">4.5</p><p id="difficulty">—</p></li>
<li><h3>Bob Ray</h3><a href="/course/1/3/"><img src=x></a><p id=rating>2</p></li>
<li><a href="/course/1/2">Jane D.</a></li><li><a href="/x/1">No</a></li></ul></div>
<h2>Group &amp; A</h2><p>take cs 1110 first</p><ul><li>one <ul><li>CS 2000 nested</li></ul></li></ul>
<h2></h2><p>lost</p><h2>Empty</h2><h2>B</h2><p>para <b>two</b></p><p>{long}</p>
<div><h4>in</h4><ol><li>z</li></ol></div>
<noscript>hidden</noscript><script>var p = "<p>";</script></body></html>""".replace("{long}", "x" * 150)
REVIEWS = """<section><div>Spring 2024<br>Updated 9/1/24<br>Good prof<br>Great course<br>3.5<br>Show more</div>
<div><p>Fall 2023</p><p>Updated 10/1/23</p><p>Jane Doe</p><p>Only bad</p><p>4</p></div>
<div><p>Fall 2023</p><p>Updated 10/1/23</p><p>Jane Doe</p><p>Only bad</p><p>4</p></div>
<div>Fall 2023<br>Updated 1/1/23<br>short</div><div>x<br>y<br>Updated 1/1/23<br>no season</div></section>"""


def frame(spark, html):
    return spark.createDataFrame([(1, html), (2, ""), (3, None)], "course_id int, raw_html string")


def test_large_pages_are_parsed_once_and_in_time(spark):
    heads = "".join(f"<h2>g{k}</h2><ul><li>CS {1000 + k}</li></ul><p>t{k}</p>" for k in range(300))
    people = "".join(f'<li><a href="/course/9/{k}">Name {k}</a><p id="rating">4</p></li>' for k in range(300))
    pages = spark.createDataFrame([(1, "P", heads, people)], "course_id int, program_code string, raw_html string, listing string")
    items = X.requirement_items(pages.drop("listing"))
    ratings = X.page_ratings(pages.select("course_id", "listing"), "https://site.example", html="listing")
    started = time.monotonic()
    assert items.count() == 600 and ratings.count() == 300
    assert time.monotonic() - started < 60
    for df in (items, ratings):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1


def random_html(draw, n):
    tags = ["div", "li", "ul", "p", "h2", "h3", "a", "b", "section", "span", "br"]
    out = []
    for _ in range(n):
        tag = draw.choice(tags)
        out.append(draw.choice([f"<{tag}>", f"<{tag} id='rating'>", f"</{tag}>", "text ", "<br/>"]))
    return "".join(out)


def test_places_of_nodes_equal_their_definitions():
    draw = random.Random(6)
    for _ in range(200):
        page = H._outline(random_html(draw, 60) + "x")
        nodes = page["nodes"]
        for k, n in enumerate(nodes):
            below = [j for j, m in enumerate(nodes) if n["i"] < m["i"] < n["stop"]]
            assert n["at"] == k and list(range(k + 1, n["end"])) == below
            around = [j for j, m in enumerate(nodes) if m["tag"] in H.BOXES and m["i"] < n["i"] < m["stop"]]
            assert n["box"] == (around[-1] if around else -1)
            if n["tag"] in H.BOXES:
                assert n["head"] == next((j for j in below if nodes[j]["tag"] in ("h1", "h2", "h3", "h4")), -1)
            own = [j for j, m in enumerate(nodes) if m["parent"] == n["parent"]]
            assert page["siblings"][n["rank"] : n["rank_end"]] == [j for j in own if j >= k]


def large_page(n):
    """A page of about ``n`` nodes that all extractions find something in."""
    rows = "".join(
        f'<li><h3>Person {k}</h3><a href="/course/9/{k}"><img></a></li>' if k % 2 else
        f"<h2>g{k}</h2><ul><li>CS {k}</li></ul><p>t{k}</p>" for k in range(n // 4))
    reviews = "".join(f"<div>Spring 2024<br>Updated 9/1/24<br>Good {k}<br>3.5</div>" for k in range(n // 8))
    return f"<div><ul>{rows}</ul></div><section>{reviews}</section>"


def test_cost_grows_with_the_page(spark):
    """Twice the nodes cost about twice the time, not four times."""
    def seconds(n, run):
        page = spark.createDataFrame([(1, large_page(n))], "course_id int, raw_html string")
        best = 1e9
        for _ in range(3):
            started = time.monotonic()
            run(page).write.format("noop").mode("overwrite").save()
            best = min(best, time.monotonic() - started)
        return best

    for run in (lambda d: X.page_links(d, SITE), X.review_blocks, X.requirement_items):
        assert seconds(20_000, run) <= 2.2 * seconds(10_000, run) + 0.2


def test_link_order(spark):
    links = X.link_order(X.page_links(frame(spark, PAGE), SITE), "course_id")
    assert [r.professor_name for r in links.collect()] == ["Bob Ray", "Jane D."]
    rows = spark.createDataFrame([(1, "b", "2"), (1, "B", "1"), (0, "c", "0"), (1, "a", "3")], "course_id int, professor_name string, professor_page_url string")
    assert [tuple(r) for r in X.link_order(rows).collect()] == [(1, "a", "3"), (1, "B", "1"), (1, "b", "2"), (0, "c", "0")]


def test_links(spark):
    got = {(r.professor_name, r.professor_page_url) for r in X.page_links(frame(spark, PAGE), SITE).collect()}
    assert got == {("Jane D.", f"{SITE}/course/1/2"), ("Bob Ray", f"{SITE}/course/1/3/")}


def test_ratings(spark):
    read = lambda df: {r.professor_name: (r.rating, r.difficulty) for r in df.collect()}
    # The outer container shows every name, so its first figures go to all.
    assert read(X.page_ratings(frame(spark, PAGE), SITE)) == {"Jane D.": ("4.5", None), "Bob Ray": ("4.5", None)}
    assert read(X.page_ratings(frame(spark, PAGE), SITE, innermost=True)) == {
        "Jane D.": (None, None), "Bob Ray": ("2", None)}


def test_page_text(spark):
    text = X.page_text(frame(spark, PAGE)).first().raw_text.split("\n")
    assert "Group & A" in text and "hidden" not in text and not any("var p" in line for line in text)
    assert all(line == line.strip() and line for line in text)


def test_requirement_signals_deal_the_rules_once(spark):
    rng = random.Random(5)
    rows = {(rng.randrange(4), rng.randrange(9), rng.randrange(60), rng.choice([None, *range(7)])) for _ in range(300)}
    line = spark.createDataFrame(
        [(p, f"{p}-{g}", f"{p}-{g}-{r}", c) for p, g, r, c in rows for _ in range(2)],
        "program_id int, group_id string, rule_id string, course_id int").repartition(3)
    program = spark.createDataFrame([(p, f"P{p}") for p in range(3)], "program_id int, program_code string")
    joined = Q.requirement_join(program, line, line, line)
    demand = spark.createDataFrame([(p, c) for p in range(5) for c in (None, *range(9))], "program_id int, course_id int")
    out = Q.requirement_signals(joined, demand)
    got = {(r.program_id, r.course_id): tuple(r)[2:] for r in out.collect()}

    listed = [(p, f"{p}-{g}", f"{p}-{g}-{r}", c) for p, g, r, c in rows if p < 3 and c is not None]
    for (p, c), signals in got.items():
        mine = [x for x in listed if x[3] == c]
        counts = tuple(len({x[:n] for x in mine}) for n in (1, 2, 3))
        assert signals == (int(any(x[0] == p for x in mine)), *counts)
    assert len(got) == 50
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(program_id" in x and "REPARTITION_BY_NUM" in x]
    assert len(dealt) == 2 and sum("ReusedExchange" in x for x in plan.splitlines()) >= 1


def test_requirement_rules(spark):
    pages = frame(spark, PAGE).withColumn("program_code", F.lit("P")).withColumn("source_id", F.lit(5))
    rules = Q.requirement_rules(pages)
    got = [(r.display_order, r.rule_code, r.rule_type, r.text_requirement) for r in rules.orderBy("display_order").collect()]
    assert got == [
        (1, "P_group_1_rule_1", "text_rule", "2"),
        (2, "P_group_2_rule_1", "course_list", "take cs 1110 first"),
        (3, "P_group_2_rule_2", "course_list", "one CS 2000 nested"),
        (4, "P_group_2_rule_3", "course_list", "CS 2000 nested"),
        (5, "P_group_5_rule_1", "text_rule", "para two"),
        (6, "P_group_5_rule_2", "text_rule", "x" * 150),
        (7, "P_group_6_rule_1", "text_rule", "z"),
    ]
    assert len(rules.filter("display_order = 6").first().rule_label) == 120
    rules = Q.with_rule_ids(rules)
    groups = {r.group_code: r.display_order for r in Q.group_rows(rules).collect()}
    assert groups["P_group_2"] == 2 and groups["P_group_5"] == 5
    course = spark.createDataFrame([(9, "CS", 1110), (4, "CS", 1110)], "course_id int, subject_id string, catalog_nbr int")
    linked = Q.requirement_courses(rules, course)
    assert sorted((r.catalog_nbr, r.course_id) for r in linked.collect()) == [(1110, 4), (2000, None), (2000, None)]
    stored = Q.load_requirement_courses(linked, rules, course)
    assert stored.count() == 3
    ledger = Q.run_ledger(spark.createDataFrame([(5,), (6,), (7,)], "source_id int"), rules,
                          spark.createDataFrame([(7, "broken")], "source_id int, error string"))
    got = {r.source_id: (r.run_status, r.groups_written, r.rules_written, r.courses_written) for r in ledger.collect()}
    assert got == {5: ("success", 4, 7, 3), 6: ("success", 0, 0, 0), 7: ("failed", None, None, None)}
    assert tuple(Q.ledger_totals(ledger).first()) == (3, 2, 1)


def review_pages(spark):
    rows = [(1, "CS", "1110", "Doe, Jane", "/p/1", REVIEWS)]
    return spark.createDataFrame(rows, "course_id int, subject string, catalog_nbr string, professor_name string,"
                                       " professor_page_url string, raw_html string")


def test_review_rows(spark):
    people = spark.createDataFrame([(7, "Jane  Doe"), (8, "Bob"), (9, "Bob")], "professor_id bigint, name string")
    blocks = X.review_blocks(review_pages(spark))
    assert blocks.count() == 3  # the section, and two distinct reviews
    rows = R.review_rows(blocks, people)
    got = {r.full_review_text: r for r in rows.collect()}
    good, bad = got["Good prof Great course"], got["Only bad"]
    assert (good.review_term_label, good.updated_at, good.professor_review_text, good.course_review_text) == (
        "Spring 2024", "9/1/24", "Good prof", "Great course")
    assert (bad.course_review_text, bad.sentiment_label, bad.professor_id) == (None, "negative", 7)
    leaf = R.review_rows(X.review_blocks(review_pages(spark), leaf_only=True), people)
    assert leaf.count() == 2
    summary = R.summarize_reviews(leaf).first()
    assert (summary.review_count, summary.positive_review_count, summary.negative_review_count) == (2, 1, 1)
    assert summary.most_recent_review_at == "9/1/24" and str(summary.most_recent_review_date) == "2024-09-01"


def test_name_match_needs_one_professor(spark):
    people = spark.createDataFrame([(7, "Doe, Jane"), (8, "Bob"), (9, "bob ")], "professor_id bigint, name string")
    pages = spark.createDataFrame([("jane doe",), ("Bob",), ("Nobody",)], "professor_name string")
    got = {r.professor_name: r.professor_id for r in R.match_unique_name(pages, people).collect()}
    assert got == {"jane doe": 7, "Bob": None, "Nobody": None}


def test_aspects(spark):
    text = "The exams were hard. Homework weekly! Finally the professor was mean and unfair."
    reviews = spark.createDataFrame([("k1", 1, 7, "CS", "1", "Jane", text), ("k2", 1, 7, "CS", "1", "Jane", "Nothing.")],
                                    "review_key string, course_id int, professor_id bigint, subject string,"
                                    " catalog_nbr string, professor_name string, full_review_text string")
    rows = R.aspects(reviews)
    got = {r.aspect_name: (r.mention_count, r.exam_mentions, r.assignment_mentions, r.sentiment_label) for r in rows.collect()}
    assert got == {
        "difficulty": (1, 2, 0, "negative"), "workload": (1, 0, 1, "neutral"),
        "professor_personality": (1, 1, 0, "negative"), "assessments": (2, 3, 0, "negative"),
    }
    assert R.summarize_aspects(rows).count() == 4


def test_outlines_are_made_few_at_once(monkeypatch):
    pages = pa.array([PAGE, None, "", "<p>x</p>"] * 40)
    whole, sizes, made = [H._outline(p) for p in pages.to_pylist()], [], pa.array
    monkeypatch.setattr(H.pa, "array", lambda rows, *a, **k: sizes.append(len(rows)) or made(rows, *a, **k))
    assert H._outline_batch(pages).to_pylist() == whole
    assert H._outline_batch(pages[:0]).to_pylist() == []
    assert max(sizes) <= 32


def test_review_pages_of_one_file_are_read_in_many_tasks(spark, monkeypatch):
    seen, blocks = {}, X.review_blocks
    monkeypatch.setattr(load.X, "review_blocks", lambda pages: seen.update(tasks=pages.rdd.getNumPartitions()) or blocks(pages))
    rows = [(n, "CS", "1000", "Ann", f"/p/{n}", "<div>Fall 2023<br>Updated 10/1/23<br>fine<br>class</div>") for n in range(40)]
    pages = spark.createDataFrame(
        rows, "course_id int, subject string, catalog_nbr string, professor_name string, professor_page_url string, raw_html string")
    pages = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(0))).coalesce(1)
    tables = {"review": spark.createDataFrame([], S.REVIEW), "professor": spark.createDataFrame([("p", "Ann", "e")], S.PROFESSOR),
              "section_professor": spark.createDataFrame([], S.SECTION_PROFESSOR)}
    loaded = load.load_review_pages(tables, frame(spark, PAGE), pages, SITE, "1")
    assert seen["tasks"] > 1
    assert loaded.tables["review"].count() == 40
