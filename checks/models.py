"""Checks of metrics, model inputs, fits and demand scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as B
from checks.sql import query, term_of
from checks.tidy import big, dbl, tidy
from termscope import defaults as D
from termscope.operators import features as P
from termscope.operators import metrics as X
from termscope.operators import model as M
from termscope.operators import scoring as G
from termscope.plans import evaluate as E
from termscope.plans.enrollment import enrollment_features
from termscope.session import materialize, passing

AREAS = {"quantitative": ("ECONOMY", "PROMO"), "humanities": ("SMALL", "LARGE", "MEDIUM"), "none": ("X",)}


def scored(spark, sf_dir):
    """Every line item as a scored row, with many equal scores."""
    part = F.col("l_partkey")
    return B.read(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (part * 37 % 1000 / 1000 * 0.8 + F.col("l_discount")).alias("p"),
        (part * 37 % 997 / 997).alias("truth"),
    )


def class_metrics(spark, sf_dir):
    return tidy(X.metric_rows(X.classification_metrics(scored(spark, sf_dir), "y", "p")))


def roc_auc(spark, sf_dir):
    return tidy(X.roc_auc(scored(spark, sf_dir), "y", "p"))


def probability_metrics(spark, sf_dir):
    return tidy(X.probability_metrics(scored(spark, sf_dir), "truth", "p", "y"))


def threshold_sweep(spark, sf_dir):
    return tidy(X.threshold_sweep(scored(spark, sf_dir), "y", "p"))


def medians(spark, sf_dir):
    found = X.medians(B.read(spark, sf_dir, "lineitem"), ("l_quantity", "l_extendedprice", "l_tax"))
    return tidy(spark.createDataFrame([found], "l_quantity double, l_extendedprice double, l_tax double"))


SCALED = ("catalog_nbr", "capacity", "seats_taken", "fill_ratio", "meeting_day_count", "term_numeric")


def facts(spark, sf_dir):
    return P.section_facts(B.section(spark, sf_dir), B.course(spark, sf_dir))


def scaler(spark, sf_dir):
    train, _, _, _ = M.term_split(facts(spark, sf_dir))
    return tidy(X.scaler_table(train, SCALED))


def standardized(spark, sf_dir):
    train, test, _, _ = M.term_split(facts(spark, sf_dir))
    rows = X.apply_scaler(test, X.fit_scaler(train, SCALED))
    return tidy(rows.select("class_nbr", *SCALED))


def one_hot(spark, sf_dir):
    rows = M.drop_leaky(facts(spark, sf_dir).withColumn("id", F.concat_ws("-", "term_id", "class_nbr")))
    rows = rows.select("id", "season", "component", "course_level", "catalog_nbr", "has_lab")
    return tidy(M.one_hot(rows, ("season", "component", "course_level")))


def one_hot_wide(spark, sf_dir):
    """Every class number as a category of its own."""
    rows = facts(spark, sf_dir).select(F.when(F.col("capacity") % 9 != 0, F.col("class_nbr")).alias("class_nbr"))
    encoded, _, (names,) = M.encode(rows, ["class_nbr"])
    places = encoded.groupBy("class_nbr", F.col("class_nbr_index").cast("bigint").alias("place")).agg(
        F.count("*").alias("rows"))
    return tidy(places.withColumn("names", F.lit(names)))


def term_split(spark, sf_dir):
    train, test, _, _ = M.term_split(facts(spark, sf_dir))
    return tidy(M.term_bounds(facts(spark, sf_dir))).unionByName(
        tidy(train.unionByName(test).groupBy("term_id").count().select(
            F.col("term_id").alias("first_term"), F.col("count").cast("string").alias("last_term")))
    )


def _features(spark, sf_dir):
    return enrollment_features(B.tables(spark, sf_dir), dealt=B.dealt(spark, sf_dir))


def _fill_report(spark, sf_dir):
    return E.evaluate_fill_model(lambda: P.python_features(_features(spark, sf_dir)), terms=M.two_terms(B.section(spark, sf_dir)))


def fill_model_predictions(spark, sf_dir):
    report = _fill_report(spark, sf_dir)
    return report.predictions.orderBy(F.desc("predicted_fill_probability"))


def top_sections(spark, sf_dir):
    report = _fill_report(spark, sf_dir)
    return M.top_k(report.predictions, F.col("predicted_fill_probability"), D.TOP_SECTIONS)


def top_weights(spark, sf_dir):
    return _fill_report(spark, sf_dir).weights


def fill_model_metrics(spark, sf_dir):
    return _fill_report(spark, sf_dir).metrics


def contexts(spark, sf_dir):
    """One context per market segment and region, averaged over all its customers."""
    nation = B.read(spark, sf_dir, "nation")
    rows = B.read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    made = rows.groupBy("c_mktsegment", "n_regionkey").agg(
        F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast("decimal(20,2)")).alias("balance")
    )
    n, region = F.col("n"), F.col("n_regionkey")
    standing = F.element_at(F.array(*map(F.lit, ("senior", "junior", "sophomore", "first_year"))), (region % 4 + 1))
    area = F.element_at(F.array(*map(F.lit, AREAS)), (n % 3 + 1).cast("int"))
    number = F.array_position(F.array(*map(F.lit, sorted(SEGMENTS))), F.col("c_mktsegment"))
    return made.select(
        (region * 10 + number).cast("bigint").alias("student_id"), standing.alias("class_standing"),
        area.alias("interest_area"), (4 - region % 4).cast("int").alias("priority_score"),
        (n % 80).cast("double").alias("enrollment_slot_hours"),
        (F.lit(1000) + region * 1000).cast("int").alias("max_course_level"),
        (n % 10 / 10).alias("schedule_flexibility"), F.lit(0.0).alias("difficulty_tolerance"),
        (F.col("balance").cast("double") / n / 10000 - 0.5).alias("planning_noise"),
    )


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _pool(spark, sf_dir, columns=(), terms=()):
    """Every section, ready for scoring; ``columns`` names the features that are stored, all by default.

    ``terms`` keeps the sections of these terms alone; of the others only what the medians are made of is stored.
    """
    here = F.col("term_id").isin(*terms)
    with passing(spark):
        rows = _features(spark, sf_dir)
        rows = rows.select(*columns) if columns else rows
        if terms:
            read = ("term_id", *G.MEDIAN_COLUMNS)
            rows = rows.select(*[c if c in read else F.when(here, F.col(c)).alias(c) for c in rows.columns])
        stored = materialize(rows)
    pool = G.prepare_pool(stored)
    return pool.where(here) if terms else pool


# What prepare_pool and score_grid read; the reports per section name no other feature.
SCORE_INPUTS = (
    "term_id", "course_id", "class_nbr", "subject_id", "catalog_nbr", "course_level", "capacity", "current_waitlist",
    "fill_ratio", "waitlist_ratio", "meetings_start_time", "avg_prof_rating", "avg_prof_difficulty",
    "avg_course_forum_sentiment", "avg_course_forum_demand", "avg_course_forum_review_count", "total_course_forum_reviews",
    "avg_fill_ratio_prior_course", "avg_fill_ratio_prior_subject_level",
)


POOL = (
    "avg_prof_rating", "avg_prof_difficulty", "historical_demand", "fill_ratio", "waitlist_ratio",
    "capacity", "current_waitlist", "course_forum_signal", "seat_pressure",
)


def section_pool(spark, sf_dir):
    return tidy(_pool(spark, sf_dir, SCORE_INPUTS).select("term_id", "class_nbr", "course_level", "is_morning_course", *POOL))


def _grid(spark, sf_dir):
    return G.score_grid(G.context_grid(contexts(spark, sf_dir), _pool(spark, sf_dir, SCORE_INPUTS)), AREAS)


def demand_grid(spark, sf_dir):
    """The whole grid, reported per section over all contexts."""
    return tidy(_grid(spark, sf_dir).groupBy("term_id", "class_nbr").agg(
        F.count("*").alias("contexts"), F.sum("level_ok").alias("level_ok"),
        F.sum("interest_match").alias("matches"), F.avg("student_course_demand").alias("demand"),
        F.avg("registration_competitiveness").alias("competitiveness"),
        F.min("got_in_probability").alias("lowest"), F.avg("got_in_probability").alias("probability"),
        F.max("got_in_probability").alias("highest"),
    ))


def students(spark, sf_dir):
    """One context per customer."""
    n = F.col("c_custkey")
    area = F.element_at(F.array(*map(F.lit, AREAS)), (n % 3 + 1).cast("int"))
    return B.read(spark, sf_dir, "customer").select(
        n.alias("student_id"), F.lit("senior").alias("class_standing"), area.alias("interest_area"),
        (4 - n % 4).cast("int").alias("priority_score"), (n % 80).cast("double").alias("enrollment_slot_hours"),
        (F.lit(1000) + n % 5 * 1000).cast("int").alias("max_course_level"), (n % 10 / 10).alias("schedule_flexibility"),
        F.lit(0.0).alias("difficulty_tolerance"), (F.col("c_acctbal").cast("double") / 10000 - 0.5).alias("planning_noise"))


def _ordered(spark, sf_dir):
    """Order lines with their customer, course, section and term."""
    line = B.read(spark, sf_dir, "lineitem").join(B.read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    part = F.col("l_partkey")
    return line.select(
        F.col("o_custkey").alias("student_id"), B.term_of(F.col("l_shipdate")).alias("term_id"),
        part.cast("int").alias("course_id"), (part * 1000 + F.col("l_suppkey")).cast("string").alias("class_nbr"), "l_linestatus")


def _pairs(spark, sf_dir, ordered=None, columns=(), terms=()):
    """Every customer with the sections of each course ordered, in the term of the order line."""
    wanted = (ordered or _ordered(spark, sf_dir)).select("student_id", "term_id", "course_id")
    return G.score_grid(G.candidate_pairs(students(spark, sf_dir), _pool(spark, sf_dir, columns, terms), wanted), AREAS)


def demand_pairs(spark, sf_dir):
    """The candidate pairs, reported per section."""
    scores = _pairs(spark, sf_dir, columns=SCORE_INPUTS)
    return tidy(scores.groupBy("term_id", "class_nbr").agg(
        F.count("*").alias("contexts"), F.sum("level_ok").alias("level_ok"), F.sum("interest_match").alias("matches"),
        F.avg("student_course_demand").alias("demand"), F.avg("registration_competitiveness").alias("competitiveness"),
        F.avg("got_in_probability").alias("probability")))


def _labelled(spark, sf_dir, terms=()):
    """The candidate pairs with an outcome from the tables (the reference draws it at random).

    A customer got into a section when one of the order lines for it has status F.
    ``terms`` keeps the lines of these terms alone, before they meet the sections.
    """
    key = ["student_id", "term_id", "class_nbr"]
    ordered = _ordered(spark, sf_dir)
    if terms:
        ordered = ordered.where(F.col("term_id").isin(*terms))
    outcome = ordered.groupBy(key).agg(F.max((F.col("l_linestatus") == "F").cast("int")).alias("got_in"))
    return _pairs(spark, sf_dir, ordered, terms=terms).join(outcome, key, "left").withColumn("got_in", F.coalesce("got_in", F.lit(0)))


def _two_terms(spark, sf_dir):
    """The pairs of the terms that the models learn from and are applied to."""
    return _labelled(spark, sf_dir, M.two_terms(B.section(spark, sf_dir)))


def probability_model_predictions(spark, sf_dir):
    report = E.evaluate_probability_model(lambda: _two_terms(spark, sf_dir))
    return report.predictions.orderBy("student_id", "class_nbr")


def context_model_metrics(spark, sf_dir):
    return E.evaluate_context_model(lambda: _two_terms(spark, sf_dir)).metrics


QUERIES = {
    "class_metrics": class_metrics,
    "roc_auc": roc_auc,
    "probability_metrics": probability_metrics,
    "threshold_sweep": threshold_sweep,
    "medians": medians,
    "scaler": scaler,
    "standardized": standardized,
    "one_hot": one_hot,
    "one_hot_wide": one_hot_wide,
    "term_split": term_split,
    "section_pool": section_pool,
    "demand_grid": demand_grid,
    "demand_pairs": demand_pairs,
    "fill_model_predictions": fill_model_predictions,
    "fill_model_metrics": fill_model_metrics,
    "top_sections": top_sections,
    "top_weights": top_weights,
    "probability_model_predictions": probability_model_predictions,
    "context_model_metrics": context_model_metrics,
}

_SCORED = {
    "scored": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
               (l_partkey * 37 % 1000)::DOUBLE / 1000 * 0.8::DOUBLE + l_discount AS p,
               (l_partkey * 37 % 997)::DOUBLE / 997 AS truth FROM lineitem""",
    "ranked": """
        SELECT y, (min(r) OVER (PARTITION BY p) + max(r) OVER (PARTITION BY p)) / 2.0 AS rank
        FROM (SELECT y, p, row_number() OVER (ORDER BY p) AS r FROM scored)""",
    "cut": "SELECT i / 100.0::DOUBLE AS threshold FROM (SELECT unnest(range(30, 71)) AS i)",
    "swept": """
        SELECT threshold, count(*) FILTER (p >= threshold AND y = 1) AS tp,
               count(*) FILTER (p < threshold AND y = 0) AS tn,
               count(*) FILTER (p >= threshold AND y = 0) AS fp,
               count(*) FILTER (p < threshold AND y = 1) AS fn
        FROM cut JOIN scored ON true GROUP BY threshold""",
    "rated": """
        SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision,
               CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall,
               (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS accuracy FROM swept""",
    "marks": """
        SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                  ELSE 0 END AS f1 FROM rated""",
    "brier": "SELECT avg((p - y) * (p - y)) AS brier FROM scored",
}
_FACTS = {
    "bare": """
        SELECT s.*, s.term_id::INT AS term_numeric, c.* EXCLUDE (course_id),
               CASE WHEN capacity > 0 THEN seats_taken::DOUBLE / capacity END AS fill_ratio,
               CASE WHEN catalog_nbr < 5000 THEN catalog_nbr // 1000 * 1000 END AS course_level,
               coalesce(length(regexp_replace(meetings_days, '[^MTWRFSU]', '', 'g')), 0)
                   AS meeting_day_count,
               CASE right(s.term_id, 1) WHEN '2' THEN 'spring' WHEN '6' THEN 'summer'
                    WHEN '8' THEN 'fall' ELSE 'other' END AS season
        FROM section s JOIN course c ON c.course_id = s.course_id""",
    "stat": "SELECT " + ", ".join(
        f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS scale_{c}"
        for c in SCALED) + " FROM bare WHERE term_id = (SELECT min(term_id) FROM bare)",
}
_POOLED = {
    "middle": """
        SELECT median(avg_prof_rating) AS r, median(avg_prof_difficulty) AS d, median(capacity) AS c
        FROM feature_history""",
    "filled": """
        SELECT term_id, class_nbr, subject_id, coalesce(course_level, catalog_nbr // 1000 * 1000) AS course_level,
               contains(coalesce(meetings_start_time, ''), 'AM') AS is_morning_course,
               coalesce(avg_prof_rating, r) AS avg_prof_rating,
               coalesce(avg_prof_difficulty, d) AS avg_prof_difficulty,
               coalesce(avg_fill_ratio_prior_course, avg_fill_ratio_prior_subject_level, fill_ratio, 0.5)
                   AS historical_demand,
               fill_ratio AS known_fill, coalesce(waitlist_ratio, 0) AS waitlist_ratio,
               coalesce(capacity, c, 25)::DOUBLE AS capacity, coalesce(current_waitlist, 0)::DOUBLE
                   AS current_waitlist,
               greatest(coalesce(avg_course_forum_demand, 0), 0) + 0.15 * greatest(-1,
                   least(1, coalesce(avg_course_forum_sentiment, 0))) + 0.03 * ln(1.0 +
                   greatest(coalesce(total_course_forum_reviews, 0), 0)) AS course_forum_signal
        FROM feature_history JOIN middle ON true""",
    "pool": """
        SELECT *, coalesce(known_fill, historical_demand) AS fill_ratio,
               greatest(0, least(1.5, coalesce(known_fill, historical_demand)))
                   + 0.1 * greatest(current_waitlist, 0) AS seat_pressure FROM filled""",
    "context": f"""
        SELECT n_regionkey * 10 + list_position([{", ".join(f"'{s}'" for s in sorted(SEGMENTS))}],
                   c_mktsegment) AS student_id, n % 3 AS area, 4 - n_regionkey % 4 AS priority_score,
               (n % 80)::DOUBLE AS slot, 1000 + n_regionkey * 1000 AS max_level,
               (n % 10) / 10.0::DOUBLE AS flexibility, balance / n / 10000 - 0.5 AS noise
        FROM (SELECT c_mktsegment, n_regionkey, count(*) AS n,
                     sum(c_acctbal::DECIMAL(20, 2))::DOUBLE AS balance
              FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)""",
    "pair": f"""
        SELECT p.*, k.*, CASE WHEN course_level <= max_level THEN 1 ELSE 0 END AS level_ok,
               CASE WHEN {" OR ".join(
                   f"(area = {i} AND subject_id IN ({', '.join(repr(s) for s in v)}))"
                   for i, v in enumerate(AREAS.values()))} THEN 1 ELSE 0 END AS matched,
               least(greatest(course_level - max_level, 0) / 1000.0, 3) AS gap,
               CASE WHEN is_morning_course THEN flexibility ELSE 1 END AS time_fit,
               greatest(-1, least(1, (coalesce(avg_prof_difficulty, 2.5) - 2.5) / 2.5)) AS relief
        FROM pool p JOIN context k ON true""",
    "weighed": """
        SELECT *, 0.7 * matched + 0.3 * level_ok + 0.1 * time_fit - 0.2 * gap AS want,
               greatest(0, least(1.5, historical_demand)) + greatest(0, least(1.5, fill_ratio))
                   + greatest(0, least(1.5, waitlist_ratio))
                   + 0.2 * greatest(0, least(3, course_forum_signal)) - 0.2 * relief AS rivalry
        FROM pair""",
    "chance": """
        SELECT *, greatest(0.001, least(0.999, 1 / (1 + exp(-(0.9 + 0.7 * priority_score - 0.035 * slot
               + 0.45 * want - 1.1 * rivalry - 0.02 * greatest(current_waitlist, 0)
               + 0.012 * greatest(0, least(500, capacity)) + noise))))) AS probability FROM weighed""",
}
_PAIRED = {
    **_POOLED,
    "filled": _POOLED["filled"].replace("SELECT term_id, class_nbr,", "SELECT term_id, class_nbr, course_id,"),
    "context": """
        SELECT c_custkey AS student_id, c_custkey % 3 AS area, 4 - c_custkey % 4 AS priority_score,
               (c_custkey % 80)::DOUBLE AS slot, 1000 + c_custkey % 5 * 1000 AS max_level,
               (c_custkey % 10) / 10.0::DOUBLE AS flexibility, c_acctbal::DOUBLE / 10000 - 0.5 AS noise
        FROM customer""",
    "wanted": f"""
        SELECT DISTINCT o_custkey, {term_of("l_shipdate")} AS wanted_term, l_partkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "pair": _POOLED["pair"].replace("FROM pool p JOIN context k ON true", """FROM pool p
        JOIN wanted ON wanted_term = term_id AND l_partkey = course_id JOIN context k ON student_id = o_custkey"""),
}
_LEVELS = (1000, 2000, 3000, 4000)


def _flags(c: str, values) -> str:
    quoted = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    out = [f"CASE WHEN {c} = {q} THEN 1.0 ELSE 0.0 END::DOUBLE AS {c}_{v}" for q, v in zip(quoted, values)]
    return ", ".join([*out, f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS {c}_nan"])


ORACLES = {
    "class_metrics": query("""
        SELECT metric, round(value, 6) AS value FROM (UNPIVOT (SELECT accuracy::DOUBLE AS accuracy,
            precision::DOUBLE AS precision, recall::DOUBLE AS recall, f1::DOUBLE AS f1,
            brier::DOUBLE AS brier, tp::DOUBLE AS tp, tn::DOUBLE AS tn, fp::DOUBLE AS fp,
            fn::DOUBLE AS fn FROM marks JOIN brier ON true WHERE threshold = 0.4)
            ON COLUMNS(*) INTO NAME metric VALUE value)""", **_SCORED),
    "roc_auc": query("""
        SELECT round((sum(rank) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
               / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6)::DOUBLE AS roc_auc FROM ranked""", **_SCORED),
    "probability_metrics": query("""
        SELECT round(avg(abs(truth - p)), 6) AS mae_probability,
               round(sqrt(avg((truth - p) * (truth - p))), 6) AS rmse_probability,
               round(avg((p - y) * (p - y)), 6) AS brier_against_binary_outcome,
               round(corr(truth, p), 6) AS probability_correlation FROM scored""", **_SCORED),
    "threshold_sweep": query(f"""
        SELECT {dbl("threshold", "accuracy", "precision", "recall", "f1")}, tp, tn, fp, fn
        FROM marks""", **_SCORED),
    "medians": """
        SELECT round(median(l_quantity), 6) AS l_quantity, round(median(l_extendedprice), 6)
               AS l_extendedprice, round(median(l_tax), 6) AS l_tax FROM lineitem""",
    "scaler": query("SELECT " + dbl(*[f"{k}_{c}" for c in SCALED for k in ("mean", "scale")])
                    + " FROM stat", **_FACTS),
    "standardized": query("SELECT class_nbr, " + ", ".join(
        f"round(({c} - mean_{c}) / scale_{c}, 6) AS {c}" for c in SCALED)
        + " FROM bare JOIN stat ON term_id = (SELECT max(term_id) FROM bare)", **_FACTS),
    "one_hot": query(f"""
        SELECT term_id || '-' || class_nbr AS id, catalog_nbr::BIGINT AS catalog_nbr, has_lab,
               {_flags("season", ("fall", "spring", "summer"))},
               {_flags("component", ("DIS", "LAB", "LEC"))}, {_flags("course_level", _LEVELS)}
        FROM bare""", **_FACTS),
    "one_hot_wide": query("""
        SELECT c AS class_nbr, count(*) AS rows, (SELECT count(DISTINCT c) + 1 FROM shown) AS names,
               (SELECT count(DISTINCT c) FROM shown) * (c IS NULL)::BIGINT
               + (CASE WHEN c IS NULL THEN 0 ELSE dense_rank() OVER (ORDER BY c NULLS LAST) - 1 END) AS place
        FROM shown GROUP BY c""", **_FACTS, shown="""
        SELECT CASE WHEN capacity % 9 <> 0 THEN class_nbr END AS c FROM bare"""),
    "term_split": query("""
        SELECT min(term_id) AS first_term, max(term_id) AS last_term FROM section
        UNION ALL SELECT term_id, count(*)::VARCHAR FROM section
        WHERE term_id IN (SELECT min(term_id) FROM section UNION SELECT max(term_id) FROM section)
        GROUP BY term_id"""),
    "section_pool": query(f"""
        SELECT term_id, class_nbr, is_morning_course, course_level::BIGINT AS course_level, {dbl(*POOL)}
        FROM pool""", **_POOLED),
    "demand_grid": query("""
        SELECT term_id, class_nbr, count(*) AS contexts, sum(level_ok)::BIGINT AS level_ok,
               sum(matched)::DOUBLE AS matches, round(avg(want), 6)::DOUBLE AS demand,
               round(avg(rivalry), 6)::DOUBLE AS competitiveness, round(min(probability), 6) AS lowest,
               round(avg(probability), 6) AS probability, round(max(probability), 6) AS highest
        FROM chance GROUP BY 1, 2""", **_POOLED),
    "demand_pairs": query("""
        SELECT term_id, class_nbr, count(*) AS contexts, sum(level_ok)::BIGINT AS level_ok,
               sum(matched)::DOUBLE AS matches, round(avg(want), 6)::DOUBLE AS demand,
               round(avg(rivalry), 6)::DOUBLE AS competitiveness, round(avg(probability), 6) AS probability
        FROM chance GROUP BY 1, 2""", **_PAIRED),
}
