"""Class pages, payload rows, upserts, streams and copies."""

from decimal import Decimal

from pyspark.sql import functions as F

from checks import bindings as B
from checks import loading as L
from termscope import schemas as S
from termscope.operators import features as P
from termscope.operators import ingest as I
from termscope.operators import upsert as U
from termscope.sources import classes as C
from termscope.sources import tables as T
from termscope.streaming import ingest as ST

ITEM = '{"class_nbr":%s,"crse_id":"7"}'


def pages(spark, bodies):
    rows = spark.createDataFrame([("1262", n, b) for n, b in enumerate(bodies)], "term string, page int, body string")
    return rows.withColumn("fetched_at", F.timestamp_seconds(F.lit(100) + F.col("page")))


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_envelopes(spark):
    c = [ITEM % n for n in range(1, 9)]
    bodies = [
        '{"results":[%s,%s]}' % (c[0], c[1]), "[%s,%s]" % (c[2], c[3]),
        '[{"classes":[%s,%s,%s]}]' % (c[4], c[5], c[6]), '{"results":{"classes":[%s]}}' % c[7],
        '{"results":null}', "[]", '[{"classes":null}]', "null", "not json",
        "[%s,%s,%s,%s]" % (ITEM % '""', ITEM % "0", ITEM % "null", '{"crse_id":1}'),
        ITEM % '"009"',
    ]
    found = C.unwrap_classes(pages(spark, bodies))
    per_page = {r.page: r["count"] for r in found.groupBy("page").count().collect()}
    assert per_page == {0: 2, 1: 2, 2: 3, 3: 1, 9: 4, 10: 1}
    raw = C.to_raw_rows(found)
    assert sorted(r.class_nbr for r in raw.collect()) == ["009"] + [str(n) for n in range(1, 9)]
    payload = raw.filter("class_nbr = '1'").first().payload
    assert payload == ('{"class_nbr":1,"crse_id":"7","fetched_at":"1970-01-01 00:01:40.000000+00:00",'
                       '"page":0,"term":"1262"}')


def test_last_page_wins_and_reload_is_idempotent(spark):
    raw = C.to_raw_rows(C.unwrap_classes(pages(spark, ["[%s]" % (ITEM % 5), "[%s]" % (ITEM % 5)])))
    empty = spark.createDataFrame([], S.RAW_CLASS)
    once = I.load_raw(empty, raw)
    assert [r.page_fetched for r in once.collect()] == [1]
    assert rows_of(I.load_raw(once, raw)) == rows_of(once)
    assert rows_of(I.load_raw(once, raw.filter("false"))) == rows_of(once)


def raw_docs(spark, docs):
    return spark.createDataFrame(
        [("1262", str(n), d, p, None) for n, (p, d) in enumerate(docs)], S.RAW_CLASS
    )


def test_payload_rows(spark):
    raw = raw_docs(spark, [
        (1, '{"crse_id":"012","descr":"A","units":"3","subject":"CS","catalog_nbr":"1110","component":"LEC",'
            '"class_capacity":9,"meetings":[{"days":"MWF","start_time":"9:30AM"}],'
            '"instructors":[{"name":"Ann","email":"a"},{"name":"-"},{"name":null,"email":"n"}]}'),
        (1, '{"crse_id":12,"descr":"B","units":"1 - 4","subject":"CS","catalog_nbr":1110,"component":"LAB",'
            '"meetings":[],"instructors":[]}'),
        (1, '{"crse_id":13,"units":"3.0","subject":"CS","catalog_nbr":2}'),
    ])
    courses = rows_of(I.course_rows(raw).select("course_id", "title", "credits", "has_lab", "class_nbr"), "class_nbr")
    assert courses == [(12, "A", Decimal("3.0"), False, "0"), (12, "B", None, True, "1"), (13, None, None, False, "2")]
    sections = rows_of(I.section_rows(raw).select("class_nbr", "capacity", "seats_taken", *I.MEETING_COLUMNS), "class_nbr")
    assert sections == [("0", 9, 0, "MWF", "9:30AM", "TBA"), ("1", 0, 0, "TBA", "TBA", "TBA"),
                        ("2", 0, 0, "TBA", "TBA", "TBA")]
    people = rows_of(I.instructor_rows(raw).select("course_id", "name", "email"))
    assert people == [(12, None, "n"), (12, "Ann", "a"), (13, None, None)]
    loaded = I.load_courses(spark.createDataFrame([], S.COURSE), raw).filter("course_id = 12").first()
    assert (loaded.title, loaded.component, loaded.has_lab, loaded.credits) == ("A", "LEC", True, Decimal("3.0"))


def test_payloads_are_built_in_every_task_of_a_shuffle(spark, tmp_path):
    spark.range(400).selectExpr(
        "IF(id % 11 = 0, NULL, id % 7) AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 3 AS double) AS l_quantity",
        "timestamp_seconds(1700000000 + id % 9 * 9000000) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    narrow, wide = B.section(spark, str(tmp_path)), B.section(spark, str(tmp_path), wide=True)
    assert wide.columns == narrow.columns
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, narrow.collect()))
    assert L.raw_classes(spark, str(tmp_path)).rdd.getNumPartitions() == 4


def test_section_reload_keeps_counts(spark):
    first = raw_docs(spark, [(1, '{"crse_id":1,"class_capacity":5,"enrollment_total":3,"meetings":[{"days":"MW"}]}')])
    again = raw_docs(spark, [(2, '{"crse_id":2,"class_capacity":8,"enrollment_total":9,"meetings":[{"days":"TR"}]}')])
    stored = I.load_sections(spark.createDataFrame([], S.SECTION), first)
    row = I.load_sections(stored, again).first()
    assert (row.course_id, row.capacity, row.seats_taken, row.meetings_days) == (2, 5, 3, "TR")


def test_professors_and_links(spark):
    people = spark.createDataFrame(
        [("Ann", "a", 1, "1262"), ("Ann", "b", 1, "1262"), ("Ann", "a", 1, "1262"), (None, None, 1, "1262")],
        "name string, email string, course_id int, term_id string",
    )
    professor = I.load_professors(spark.createDataFrame([], S.PROFESSOR), people)
    assert sorted(r.email for r in professor.collect()) == ["a", "b"]
    links = I.load_links(spark.createDataFrame([], S.SECTION_PROFESSOR), people, professor)
    assert links.count() == 2
    assert I.load_links(links, people, professor).count() == 2
    assert I.load_professors(professor, people).count() == 2


def test_replace_slice_and_ids(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (3, "y")], "k int, v string")
    assert rows_of(U.replace_slice(old, new, ["k"])) == [(1, "z"), (2, "c"), (3, "y")]
    many = spark.range(20000).withColumn("k", F.concat(F.lit("k"), "id"))
    assert U.with_id(many, "key", ["k"]).select("key").distinct().count() == 20000
    odd = [(None, "a"), ("a", None), ("", "a"), ("a", ""), (None, None), ("-", "a"), ("1:a", None), ("a,1:b", "c"), ("a", "b,1:c")]
    assert U.with_id(spark.createDataFrame(odd, "x string, y string"), "key", ["x", "y"]).select("key").distinct().count() == len(odd)


def test_apply_ratings_both_layouts(spark):
    new = spark.createDataFrame([(1, "7", "4.5", None)], "course_id int, professor_id string, rating string, difficulty string")
    links = spark.createDataFrame(
        [("1262", 1, "7", None, Decimal("2.00")), ("1258", 1, "7", None, None)], S.SECTION_PROFESSOR)
    got = rows_of(P.apply_ratings(links, new, "1262"), "term_id")
    assert got == [("1258", 1, "7", None, None), ("1262", 1, "7", Decimal("4.50"), Decimal("2.00"))]
    pages = spark.createDataFrame(
        [(1, "7", "2.0", "5.0", 1), (1, "7", "1.0", None, 2), (1, "7", "4.0", "1.0", 1)],
        "course_id int, professor_id string, rating string, difficulty string, fetched_at int")
    last = {r.term_id: (r.rating, r.difficulty) for r in P.apply_ratings(links, pages, "1262").collect()}
    assert last["1262"] == (Decimal("1.00"), Decimal("2.00"))
    last = {r.term_id: (r.rating, r.difficulty) for r in P.apply_ratings(links, pages.drop("fetched_at"), "1262").collect()}
    assert last["1262"] == (Decimal("4.00"), Decimal("1.00"))
    old = spark.createDataFrame([("1262", "n1", "7", None, None), ("1262", "n2", "7", None, None)], S.SECTION_PROFESSOR_LEGACY)
    section = spark.createDataFrame([("1262", "n1", 1), ("1262", "n2", 2)], "term_id string, class_nbr string, course_id int")
    got = rows_of(P.apply_ratings(old, new, "1262", section).select("class_nbr", "rating"))
    assert got == [("n1", Decimal("4.50")), ("n2", None)]


def test_files_and_stream(spark, tmp_path):
    land, target, marks = tmp_path / "land", str(tmp_path / "raw"), str(tmp_path / "marks")
    (land / "term=1262").mkdir(parents=True)
    (land / "term=1262" / "page=1.json").write_text('{"results":[%s]}' % (ITEM % 1))
    pages_read = C.read_pages(spark, str(land))
    assert [(r.term, r.page) for r in pages_read.collect()] == [("1262", 1)]
    ST.stream_ingest(spark, str(land), target, marks)
    (land / "term=1262" / "page=2.json").write_text("[%s,%s]" % (ITEM % 1, ITEM % 2))
    ST.stream_ingest(spark, str(land), target, marks)
    ST.stream_ingest(spark, str(land), target, marks)
    rows = ST.current_rows(spark, target)
    assert rows_of(rows.select("class_nbr", "page_fetched")) == [("1", 2), ("2", 2)]
    ST.compact(spark, target, str(tmp_path / "small"))
    assert rows_of(ST.current_rows(spark, str(tmp_path / "small")).select("class_nbr")) == [("1",), ("2",)]


def test_copy_flags(spark, tmp_path):
    source = {"course": spark.createDataFrame([(1, 1, None), (2, 0, 1)], "course_id int, has_lab int, has_discussion int")}
    T.copy_tables(source.get, lambda df, n: U.full_refresh(df, f"{tmp_path}/{n}"), ["course"])
    got = rows_of(spark.read.parquet(f"{tmp_path}/course"))
    assert got == [(1, True, False), (2, False, True)]
    T.write_csv(source["course"], f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["course_id", "has_lab", "has_discussion"]
