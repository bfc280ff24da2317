"""Column functions against hand-computed values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from termscope.functions import codes as C
from termscope.functions import text as T


def run(spark, values, kind, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_clean_and_names(spark):
    assert run(spark, [None, "  a  \n b ", ""], "string", T.clean_text) == ["", "a b", ""]
    names = ["Doe, Jane", "Doe , ", ", Jane", "Jane  Doe", "Doe, Jane, Jr", None]
    want = ["Jane Doe", "Doe ,", ", Jane", "Jane Doe", "Jane, Jr Doe", ""]
    assert run(spark, names, "string", T.normalize_name) == want
    assert run(spark, ["—", "4.5", None], "string", T.null_if) == [None, "4.5", None]


def test_sentiment_formula(spark):
    texts = [
        None, "", "123 !!", "great", "great but boring", "great good fun kind clear",
        "great good boring", "boring", "Well-organized! don't", "meaning",
    ]
    got = run(spark, texts, "string", T.sentiment)
    unit = math.log(2) / math.log(6)
    want = [None, None, 0.0, unit, 0.0, 1.0, math.log(4) / math.log(6) / 3, -unit,
            math.log(3) / math.log(6), 0.0]
    assert got == pytest.approx(want)


def test_labels_at_the_cutoffs(spark):
    got = run(spark, [0.2, -0.2, 0.19, None], "double", lambda c: T.sentiment_label(c, "unknown"))
    assert got == ["positive", "negative", "neutral", "unknown"]
    assert run(spark, [None], "double", T.sentiment_label) == [None]


def test_sentences_terms_codes(spark):
    assert run(spark, ["One.  Two! \n Three? four.five", None], "string", T.sentences) == [
        ["One.", "Two!", "Three?", "four.five"], []]
    count = lambda c: T.term_counts(c, [("exam", "exams", "final", "paper", "papers")])[0]
    assert run(spark, ["Exams", "finally", "papers", None], "string", count) == [2, 1, 2, 0]
    codes = run(spark, ["cs 1110 or MATH  2310, ABCDEF 1000 CS 12345"], "string", T.course_codes)[0]
    assert [(c.subject_id, c.catalog_nbr) for c in codes] == [("CS", 1110), ("MATH", 2310)]


def test_one_scan_counts_like_one_search_per_term(spark):
    draw = random.Random(11)
    terms = [["an", "ana", "na", "nan"], ["aa", "a", "b.c", "é", "an"], ["zz"]]
    texts = ["".join(draw.choice("an.bcéz ") for _ in range(draw.randrange(30))) for _ in range(300)] + ["", "ANANA"]
    found = run(spark, texts, "string", lambda c: F.array(*T.term_counts(c, terms)))
    assert [list(f) for f in found] == [[sum(t.lower().count(x) for x in group) for group in terms] for t in texts]
    every = [x for group in terms for x in group]
    starts = run(spark, texts, "string", lambda c: T.term_starts(c, every))
    for text, begins in zip(texts, starts, strict=True):
        want = [max((x for x in every if text.startswith(x, k)), key=len) for k in range(len(text)) if any(text.startswith(x, k) for x in every)]
        assert list(begins) == want
    for group in terms:
        got = run(spark, texts, "string", lambda c, g=group: F.exists(T.term_starts(c, every), lambda t: T.begins_with(t, g, every)))
        assert got == [any(x in t for x in group) for t in texts]


def test_clean_text_equals_the_plain_rule(spark):
    draw = random.Random(13)
    spaces = [chr(c) for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    texts = ["".join(draw.choice([*spaces, " ", " ", "a", ".", "!", "\u200b", "\x1b"]) for _ in range(draw.randrange(25))) for _ in range(400)]
    plain = F.trim  # the rule: every run of white space is one blank, none at the ends
    got = run(spark, texts, "string", T.clean_text)
    assert got == run(spark, texts, "string", lambda c: plain(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " ")))
    assert run(spark, [None], "string", T.clean_text) == [""]


def test_vocabulary_words_equal_filtered_tokens(spark):
    draw = random.Random(12)
    words = ["the", "then", "they're", "a", "an", "É", "x-y", "'tis"]
    texts = ["".join(draw.choice(["the", "n", "y", "'re", " ", "-", "A", "'tis", "é", "1"]) for _ in range(12)) for _ in range(300)] + ["", None]
    got = run(spark, texts, "string", lambda c: T.vocabulary_words(c, words))
    want = run(spark, texts, "string", lambda c: F.filter(T.tokens(c), lambda w: w.isin(*words)))
    assert got == want and run(spark, ["the"], "string", lambda c: T.vocabulary_words(c, [])) == [[]]


def test_codes(spark):
    assert run(spark, ["3", "3.0", "1 - 4", "", None], "string", C.digits_to_int) == [3, None, None, None, None]
    assert run(spark, ["1262", "1266", "1268", "1261"], "string", C.season) == ["spring", "summer", "fall", "other"]
    labels = run(spark, ["1262", "1261", "1263", "1264", "1268", "1266", "12x2", "126"], "string", C.term_label)
    assert labels == ["Spring 2026", "J-Term 2026", "Summer 2026", "Fall 2026", "Fall 2026",
                      "Unknown 2026", "12x2", "126"]
    assert run(spark, [999, 1000, 2999, 4999, 5000, None], "int", C.level_band) == [
        None, 1000, 2000, 4000, None, None]
    assert run(spark, ["999", "2150", "x", None], "string", C.level_floor) == [0, 2000, 0, 0]
    assert run(spark, ["MWF", "TR", "TBA", "mwf", None], "string", C.day_count) == [3, 2, 1, 0, 0]
    times = ["9:30AM", "12:05AM", "12:00PM", "14:30", "TBA", " ", "junk", "2:00 pm", None]
    assert run(spark, times, "string", C.clock_minutes) == [570, 5, 720, 870, None, None, None, 840, None]


def test_ratio_flag_seats(spark):
    rows = spark.createDataFrame(
        [(0, 10, 10, 0), (1, 5, 0, 0), (2, None, None, None), (3, 2, 10, 1), (4, 12, 10, 0)],
        "i int, seats int, cap int, wait int",
    ).orderBy("i")
    got = rows.select(
        C.safe_ratio(F.col("seats"), F.col("cap")), C.filled_flag(F.col("seats"), F.col("cap"), F.col("wait")),
        C.seats_open(F.col("cap"), F.col("seats")),
    ).collect()
    assert [tuple(r) for r in got] == [(1.0, 1, 0), (None, 1, 0), (None, 0, 0), (0.2, 1, 8), (1.2, 1, 0)]


def test_sigmoid_logit(spark):
    got = run(spark, [0.0, 100.0, -100.0], "double", C.sigmoid)
    assert got == pytest.approx([0.5, 1 / (1 + math.exp(-30)), 1 / (1 + math.exp(30))])
    assert run(spark, [0.0, 1.0], "double", C.logit) == pytest.approx(
        [math.log(1e-4 / (1 - 1e-4)), math.log((1 - 1e-4) / 1e-4)])
