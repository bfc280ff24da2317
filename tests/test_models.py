"""History, professor averages, metrics, fits and scoring against plain Python."""

import math
import re
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termscope.operators import features as P
from termscope.operators import history as H
from termscope.operators import metrics as X
from termscope.operators import model as M
from termscope.operators import scoring as G
from termscope.plans import evaluate as E


def section_rows(n=400, seed=1):
    """Sections where one course of one subject holds a third of all rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rnd.random() < 0.34
        course = 1 if hot else rnd.randrange(2, 40)
        cap = rnd.choice([0, None, 10, 20, 35])
        wait = rnd.choice([0, 0, 3, None])
        rows.append({
            "term_numeric": rnd.choice([1252, 1256, 1258, 1262]), "class_nbr": str(10000 + i), "course_id": course,
            "subject_id": "HOT" if hot else f"S{course % 3}", "course_level": None if course % 5 == 0 else course % 4 * 1000 + 1000,
            "capacity": cap, "current_waitlist": wait, "fill_ratio": None if not cap else rnd.randrange(30) / cap,
        })
    return rows


KINDS = ("term_numeric int, class_nbr string, course_id int, subject_id string, course_level int, capacity int,"
         " current_waitlist int, fill_ratio double")


def brute_history(rows):
    from hashlib import md5

    rows = sorted(rows, key=lambda r: (r["term_numeric"], md5(r["class_nbr"].encode()).hexdigest()))
    out = {}
    for i, r in enumerate(rows):
        before = rows[:i]
        course = [b for b in before if b["course_id"] == r["course_id"]]
        level = [b for b in before if (b["subject_id"], b["course_level"]) == (r["subject_id"], r["course_level"])]
        mean = lambda bs, c: (lambda v: sum(v) / len(v) if v else None)([b[c] for b in bs if b[c] is not None])
        last = course[-1] if course else {}
        out[r["class_nbr"]] = (
            last.get("fill_ratio"), last.get("current_waitlist"), last.get("capacity"), len(course),
            mean(course, "fill_ratio"), mean(course, "current_waitlist"), mean(course, "capacity"),
            mean(level, "fill_ratio"), mean(level, "current_waitlist"),
            sum(b["subject_id"] == r["subject_id"] for b in before),
        )
    return out


NAMES = ("prev_fill_ratio", "prev_waitlist", "prev_capacity", "prior_course_terms", "avg_fill_ratio_prior_course",
         "avg_waitlist_prior_course", "avg_capacity_prior_course", "avg_fill_ratio_prior_subject_level",
         "avg_waitlist_prior_subject_level", "prior_subject_offerings")


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_history_equals_brute_force_for_any_chunking(spark, digits):
    rows = section_rows()
    df = spark.createDataFrame([tuple(r.values()) for r in rows], KINDS)
    got = {r.class_nbr: tuple(r[n] for n in NAMES) for r in H.course_history(df, chunk_digits=digits).collect()}
    want = brute_history(rows)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values), key


def test_history_prior_terms_only(spark):
    rows = section_rows(120, 5)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], KINDS)
    for r in H.course_history(df, prior_terms_only=True).collect():
        earlier = [b for b in rows if b["term_numeric"] < r.term_numeric]
        assert r.prior_course_terms == sum(b["course_id"] == r.course_id for b in earlier)
        assert r.prior_subject_offerings == sum(b["subject_id"] == r.subject_id for b in earlier)


@pytest.mark.parametrize("prior_only", [False, True])
def test_new_terms_from_state_equal_the_full_run(spark, prior_only):
    df = spark.createDataFrame([tuple(r.values()) for r in section_rows()], KINDS)
    terms = sorted({r["term_numeric"] for r in section_rows()})
    full = {r.class_nbr: tuple(r[n] for n in NAMES) for r in H.course_history(df, prior_terms_only=prior_only).collect()}
    states = [H.history_state(df.where(F.col("term_numeric") == t)) for t in terms[:-1]]
    left, right = H.merge_states(H.merge_states(*states[:2]), *states[2:]), H.merge_states(states[0], H.merge_states(*states[1:]))
    new = df.where(F.col("term_numeric") == terms[-1])
    for state in (left, right):
        rows = H.course_history(new, prior_terms_only=prior_only, state=state).collect()
        assert rows and all(tuple(r[n] for n in NAMES) == pytest.approx(full[r.class_nbr]) for r in rows)


def test_hot_subjects_are_added_up_before_they_are_dealt(spark):
    df = spark.createDataFrame([tuple(r.values()) for r in section_rows()], KINDS)
    totals = H.chunk_totals(H._chunked(df, H.TIE, 2))
    plan = H._rolled_up(totals, ["subject_key"], ["s_rows"])._jdf.queryExecution().executedPlan().toString()
    by_key = plan.index("hashpartitioning(subject_key")
    assert "HashAggregate" in plan[by_key:].split("hashpartitioning(subject_key", 2)[1]
    assert plan.count("partial_sum") >= 2


def test_history_plan_has_no_python_and_moves_wide_rows_once(spark):
    df = spark.createDataFrame([tuple(r.values()) for r in section_rows(20)], KINDS)
    plan = H.course_history(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
    # The sections themselves are dealt once, by chunk; beside that narrow totals move, by key and chunk and by key.
    assert len(re.findall(r"Exchange hashpartitioning\(spot", plan)) == 1
    others = set(re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)#", plan))
    assert others <= {("course_id", "subject_key"), ("course_id", "spot"), ("subject_key", "level_key"), ("subject_key", "spot")}


@pytest.mark.parametrize("prior_only", [False, True])
def test_large_courses_are_cut_and_give_the_same(spark, prior_only):
    rows = section_rows()
    df = spark.createDataFrame([tuple(r.values()) for r in rows], KINDS).withColumn(
        "term_numeric", F.when(F.col("class_nbr") != "10007", F.col("term_numeric")))
    df = df.withColumn("course_id", F.when(F.col("course_id") % 9 != 0, F.col("course_id")))
    none, some = H.large_courses(df), H.large_courses(df, 8)
    assert (none.count, none.null) == (0, False) and some.null and 1 < some.count < df.select("course_id").distinct().count()
    plain, cut = (
        {r.class_nbr: tuple(r[n] for n in NAMES) for r in H.course_history(df, prior_terms_only=prior_only, large=x).collect()}
        for x in (none, some))
    assert plain.keys() == cut.keys() and all(cut[k] == pytest.approx(v) for k, v in plain.items())
    new, state = df.where("term_numeric = 1262"), H.history_state(df.where("term_numeric is null or term_numeric < 1262"))
    for r in H.course_history(new, prior_terms_only=prior_only, state=state, large=some).collect():
        assert tuple(r[n] for n in NAMES) == pytest.approx(plain[r.class_nbr])


def test_sections_of_small_courses_add_no_rows_per_chunk(spark):
    df = spark.createDataFrame([tuple(r.values()) for r in section_rows(20)], KINDS)
    plan = H.course_history(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(course_id#\d+, (subject_key|spot)", plan)
    assert not re.search(r"Exchange hashpartitioning\(spot#\d+.*\n.*\btie#", plan)


def test_prior_terms_meet_stored_totals_without_moving_sections(spark):
    df = spark.createDataFrame([tuple(r.values()) for r in section_rows(20)], KINDS)
    plan = H.course_history(df, prior_terms_only=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_a_wide_category_keeps_no_name_per_place(spark):
    n = M.NAMED_PLACES + 5
    df = spark.range(n).select(F.col("id").alias("x"), F.col("id").cast("string").alias("wide"), (F.col("id") % 2).alias("few"))
    encoded, _, sizes = M.encode(df, ["wide", "few"])
    assert sizes == [n + 1, 3]
    assert len(str(encoded.schema["wide_vector"].metadata)) < 200
    for r in encoded.where("x % 4001 = 0").collect():
        assert (r.wide_vector.size, list(r.wide_vector.indices), list(r.wide_vector.values)) == (n + 1, [int(r.wide_index)], [1.0])
        assert (r.few_vector.size, list(r.few_vector.indices)) == (3, [r.few])
    rows, features = M.model_inputs(df, ["few"], ["wide"], ["few"])
    assert features.count == n + 2 and {r.raw.size for r in rows.limit(50).collect()} == {n + 2}


def test_evaluations_store_no_unused_column(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(E, "materialize", lambda df: stored.append(df.columns) or df.collect() and df)
    rows = spark.createDataFrame([("1252", "t", "MWF", 1), ("1262", "t", "MWF", 0)], "term_id string, title string, meetings_days string, filled_binary int")
    with pytest.raises(ZeroDivisionError):  # the inputs are not what is tested
        E._prepared(rows, lambda df: 1 / 0, M.section_unused())
    assert stored[0] == ["term_id", "filled_binary"]


def test_professor_features_equal_the_joined_form(spark):
    links = spark.createDataFrame(
        [("t", 1, 7, 4.0, 2.0), ("t", 1, 8, None, 3.0), ("t", 2, 7, 1.0, None)],
        "term_id string, course_id int, professor_id bigint, rating double, difficulty double")
    reviews = spark.createDataFrame(
        [(1, 7, 0.5, 1.0, 4), (1, 7, -0.5, 2.0, 6), (1, 8, None, 0.5, 2)],
        "course_id int, professor_id bigint, avg_sentiment_score double, sentiment_demand_score double, review_count bigint")
    aspects = spark.createDataFrame(
        [(1, 7, a, s, m, e, p) for a, s, m, e, p in
         (("difficulty", 0.1, 3, 0, 0), ("workload", None, 2, 0, 0), ("assessments", 0.4, 5, 7, 9))],
        "course_id int, professor_id bigint, aspect_name string, avg_sentiment_score double, total_mentions bigint,"
        " exam_mentions bigint, project_mentions bigint")
    got = {r.course_id: r for r in P.professor_features(links, reviews, aspects).collect()}[1]
    # Link 7 fans out to 2 x 3 rows, link 8 stays one row.
    assert got.instructor_count == 2 and got.total_course_forum_reviews == 3 * (4 + 6) + 2
    assert got.avg_prof_rating == 4.0 and got.avg_prof_difficulty == pytest.approx((6 * 2 + 3) / 7)
    assert got.avg_course_forum_review_count == pytest.approx((3 * 4 + 3 * 6 + 2) / 7)
    assert (got.avg_difficulty_mentions, got.avg_exam_mentions, got.avg_workload_sentiment) == (3, 7, None)
    plain = {r.course_id: r for r in P.professor_features(links, reviews, aspects, dedupe_fanout=True).collect()}[1]
    assert plain.total_course_forum_reviews == 12 and plain.avg_prof_difficulty == 2.5


def scored(spark, n=500, seed=3):
    rnd = random.Random(seed)
    rows = [(int(rnd.random() < 0.4), rnd.randrange(60) / 60) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "y int, p double")


def test_roc_auc(spark):
    rows, df = scored(spark)
    y, p = (np.array(v) for v in zip(*rows))
    ranks = pd.Series(p).rank().to_numpy()
    pos, neg = (y == 1).sum(), (y == 0).sum()
    want = (ranks[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
    for chunks in (2, 7, 256):
        assert X.roc_auc(df, "y", "p", chunks).first()[0] == pytest.approx(want)
    assert math.isnan(X.roc_auc(df.filter("y = 1"), "y", "p").first()[0])


def test_thresholds_and_metrics(spark):
    rows, df = scored(spark)
    sweep = {r.threshold: r for r in X.threshold_sweep(df, "y", "p").collect()}
    for t in (0.3, 0.5, 0.7):  # 0.3, 0.5 and 0.7 are scores: they count as positive
        assert sweep[t].tp == sum(y == 1 and p >= t for y, p in rows)
        assert sweep[t].tn == sum(y == 0 and p < t for y, p in rows)
        one = X.classification_metrics(df, "y", "p", t).first()
        assert (one.accuracy, one.f1) == pytest.approx((sweep[t].accuracy, sweep[t].f1))
    best = max(sweep.values(), key=lambda r: (r.accuracy, r.f1, -r.threshold))
    assert X.select_threshold(df, "y", "p") == best.threshold
    empty = X.classification_metrics(df.filter("false"), "y", "p").first()
    assert math.isnan(empty.accuracy) and empty.precision == 0 and empty.f1 == 0


def test_medians(spark):
    rnd = random.Random(4)
    values = [None if rnd.random() < 0.1 else rnd.choice([1.5, 2.5, rnd.random()]) for _ in range(301)]
    df = spark.createDataFrame([(v, None) for v in values], "a double, b double")
    assert X.medians(df, ["a", "b"]) == {"a": pytest.approx(float(np.nanmedian([np.nan if v is None else v for v in values]))), "b": None}


def test_medians_of_any_shape_and_missed_fences(spark, monkeypatch):
    rnd = random.Random(5)
    shapes = {
        "even": [1.0, 2.0, 3.0, 10.0], "one": [7.5], "ties": [3.0] * 50 + [1.0, 9.0], "two": [0.0] * 20 + [1.0] * 20,
        "neg": [-rnd.random() for _ in range(101)], "wide": [rnd.choice([1e-300, 1e300, -1e300, 0.0]) for _ in range(60)], "none": []}
    n = max(map(len, shapes.values()))
    rows = [tuple(v[k] if k < len(v) else None for v in shapes.values()) for k in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in shapes)).repartition(3)
    want = {c: float(np.median(v)) if v else None for c, v in shapes.items()}
    assert X.medians(df, shapes) == want
    whole = X._fences(df, list(shapes))
    monkeypatch.setattr(X, "_fences", lambda *_: {c: (n, -5.5, -5.4) for c, (n, _, _) in whole.items()})
    assert X.medians(df, shapes) == want
    assert X.median(df.limit(0), "one") is None and X.medians(df, []) == {}


def test_split_scaler_dummies(spark):
    df = spark.createDataFrame(
        [("1", "a", 1.0, 5.0), ("1", None, 3.0, 5.0), ("2", "a", 9.0, 1.0), ("3", "b", 2.0, 7.0)],
        "term_id string, k string, x double, c double")
    train, test, first, last = M.term_split(df)
    assert (first, last, train.count(), test.count()) == ("1", "3", 2, 1)
    with pytest.raises(ValueError):
        M.term_split(df.filter("term_id = '1'"))
    scaler = X.fit_scaler(train, ["x", "c"])
    assert scaler == {"x": (2.0, 1.0), "c": (5.0, 1.0)}
    hot = M.one_hot(df, ["k"])
    assert [tuple(r) for r in hot.orderBy("term_id", "x").select("k_a", "k_b", "k_nan").collect()] == [
        (1, 0, 0), (0, 0, 1), (1, 0, 0), (0, 1, 0)]


def test_many_values_stay_sparse(spark):
    rows = [(k, f"v{k:05d}" if k % 7 else None, float(k % 3)) for k in range(6000)]
    df = spark.createDataFrame(rows, "n int, k string, x double")
    inputs, features = M.model_inputs(df, [], ["k"], [])
    scale = M.fit_scale(inputs)
    names = [r.feature for r in features.table.orderBy("place").collect()]
    assert names == ["n", "x", *(f"k_{v}" for _, v, _ in rows if v), "k_nan"] and features.count == len(names)
    got = M.scaled(inputs, scale).collect()
    assert all(len(r.features.indices) <= 3 for r in got)
    nulls = np.array([v is None for _, v, _ in rows], float)
    assert scale.mean[-1] == pytest.approx(nulls.mean()) and scale.deviation[-1] == pytest.approx(nulls.std())


def test_value_index_has_text_order_and_null_last(spark):
    values = ["b", "a", None, "10", "9", "ü", "", "a"] + ["hot"] * 500
    df = spark.createDataFrame([(v, n % 3) for n, v in enumerate(values)], "k string, n int").repartition(5)
    index = {(r.column, r.value): r.place for r in M.value_index(df, ["k", "n"]).collect()}
    order = sorted({v for v in values if v is not None})
    assert index == {(0, v): p for p, v in enumerate(order)} | {(0, None): len(order)} | {
        (1, v): p for p, v in enumerate(["0", "1", "2", None])}
    empty = M.value_index(df.limit(0), ["k"])
    assert [tuple(r) for r in empty.collect()] == [(0, None, 0)]


def test_rows_and_terms_are_observed_in_one_write(spark):
    df = spark.createDataFrame([("1", 1.0), ("2", 2.0), ("3", 3.0)], "term_id string, x double")
    sides = E._prepared(df, lambda rows: M.model_inputs(rows, ["term_id"], [], ["term_id"]))
    assert (sides.rows, sides.first, sides.last, sides.train.count(), sides.test.count()) == (3, "1", "3", 1, 1)
    with pytest.raises(ValueError):
        E._prepared(df.where("term_id = '1'"), lambda rows: M.model_inputs(rows, ["term_id"], [], ["term_id"]))


def test_fits_report_a_missing_optimum(spark):
    _, _, _, df = vectors(spark)
    with pytest.raises(RuntimeError):
        M.fit_fill_model(df, "y", max_iter=2)
    with pytest.raises(RuntimeError):
        M.fit_probability_model(df, "p", max_iter=1)


def vectors(spark, seed=0, n=300):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    p = 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] + 0.3 + rng.normal(scale=0.5, size=n))))
    y = (rng.random(n) < p).astype(float)
    rows = [(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, p, y)]
    return x, p, y, spark.createDataFrame(rows, ["features", "p", "y"])


def test_logistic_reaches_the_optimum(spark):
    x, _, y, df = vectors(spark)
    model = M.fit_fill_model(df, "y")
    w, b = np.zeros(3), 0.0
    for _ in range(20000):
        e = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - 0.1 * (x.T @ e / len(y) + 1e-4 * w), b - 0.1 * e.mean()
    assert list(model.coefficients) == pytest.approx(list(w), abs=1e-3)
    assert model.intercept == pytest.approx(b, abs=1e-3)


def test_ridge_matches_the_closed_form(spark):
    x, p, _, df = vectors(spark)
    model = M.fit_probability_model(df, "p")
    z = np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))
    a = np.c_[np.ones(len(x)), x]
    want = np.linalg.solve(a.T @ a + 25 * np.diag([0, 1, 1, 1]), a.T @ z)
    assert [model.intercept, *model.coefficients] == pytest.approx(list(want), abs=1e-6)
    names = spark.createDataFrame(list(enumerate("abc")), "place long, feature string")
    weights = M.top_weights(M.weight_table(model, M.Features(names, 3), bias=True), 2)
    assert weights.first().feature == "b" and weights.count() == 2


def pool_rows(spark):
    df = spark.createDataFrame(
        [("1262", "1", "CS", 1110, 1000, 30.0, 0.5, 0.1, None, 0.9, None, "9:30AM", 4.0, 3.0, 0.2, 1.0, 10.0),
         ("1262", "2", "HIST", 3010, None, None, None, None, 2, None, None, "2:00PM", None, None, None, None, None)],
        "term_id string, class_nbr string, subject_id string, catalog_nbr int, course_level int, capacity double,"
        " fill_ratio double, waitlist_ratio double, current_waitlist int, avg_fill_ratio_prior_course double,"
        " avg_fill_ratio_prior_subject_level double, meetings_start_time string, avg_prof_rating double,"
        " avg_prof_difficulty double, avg_course_forum_sentiment double, avg_course_forum_demand double,"
        " total_course_forum_reviews double").withColumn("avg_course_forum_review_count", F.lit(0.0))
    return G.prepare_pool(df)


def context_rows(spark):
    return spark.createDataFrame(
        [(1, "senior", "quantitative", 4, 12.0, 4000, 0.5, 0.0, 0.1), (2, "first_year", "humanities", 1, 78.0, 2000, 0.2, 0.0, 0.0)],
        "student_id bigint, class_standing string, interest_area string, priority_score int, enrollment_slot_hours double,"
        " max_course_level int, schedule_flexibility double, difficulty_tolerance double, planning_noise double")


def test_pool_and_grid(spark):
    pool = {r.class_nbr: r for r in pool_rows(spark).collect()}
    assert (pool["2"].course_level, pool["2"].historical_demand, pool["2"].fill_ratio, pool["2"].capacity) == (3000, 0.5, 0.5, 30.0)
    assert pool["1"].course_forum_signal == pytest.approx(1.0 + 0.15 * 0.2 + 0.03 * math.log(11))
    assert pool["2"].seat_pressure == pytest.approx(0.7) and pool["1"].is_morning_course
    for block, tiles in ((1, 1), (1, 5), (2000, 3)):
        grid = G.score_grid(G.context_grid(context_rows(spark), pool_rows(spark), block=block, section_blocks=tiles))
        rows = {(r.student_id, r.class_nbr): r for r in grid.collect()}
        assert len(rows) == 4
        a, b = rows[1, "1"], rows[2, "2"]
        demand = 0.7 + 0.3 + 0.1 * 0.5
        rivalry = 0.9 + 0.5 + 0.1 + 0.2 * pool["1"].course_forum_signal - 0.2 * 0.2
        score = 0.9 + 0.7 * 4 - 0.035 * 12 + 0.45 * demand - 1.1 * rivalry + 0.012 * 30 + 0.1
        assert a.got_in_probability == pytest.approx(1 / (1 + math.exp(-score)))
        assert b.level_ok == 0 and b.level_gap_penalty == 1.0 and b.interest_match == 1.0


def test_evaluation_reports(spark):
    rows = section_rows(300, 9)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], KINDS).withColumns({
        "term_id": F.col("term_numeric").cast("string"), "catalog_nbr": F.lit(1000), "title": F.lit("t"),
        "season": F.lit("fall"), "component": F.lit("LEC"), "filled_binary": (F.col("fill_ratio") > 0.5).cast("int"),
    }).fillna(0, ["filled_binary"])
    report = E.evaluate_fill_model(df)
    assert (report.rows, report.train_term, report.test_term, report.parameter) == (300, "1252", "1262", 0.4)
    assert report.predictions.count() == sum(r["term_numeric"] == 1262 for r in rows)
    names = {(r.side, r.metric) for r in report.metrics.collect()}
    assert ("test", "roc_auc") in names and len(names) == 20 and report.weights.count() <= 12


def test_model_queries_take_every_customer(spark):
    """One row per customer and section of an ordered course, with the status of the customer's own lines as outcome."""
    from checks import bindings as B
    from checks import models

    sf_dir = "/root/testdata/sf0.001"
    lines = B.read(spark, sf_dir, "lineitem").join(B.read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select("o_custkey", B.term_of(F.col("l_shipdate")), "l_partkey", "l_suppkey", "l_linestatus").collect()
    sections, status = {}, {}
    for customer, term, part, supplier, flag in lines:
        number = str(part * 1000 + supplier)
        sections.setdefault((term, part), set()).add(number)
        key = customer, term, number
        status[key] = max(status.get(key, 0), int(flag == "F"))
    want = {(c, t, n): status.get((c, t, n), 0) for c, t, p, *_ in lines for n in sections[t, p]}
    rows = models._labelled(spark, sf_dir).select("student_id", "term_id", "class_nbr", "got_in").collect()
    assert len(rows) == len(want) and {tuple(r[:3]): r.got_in for r in rows} == want
    assert len({c for c, *_ in want}) > 25
