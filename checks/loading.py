"""Checks of class ingestion, upserts, streams and copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as B
from checks.sql import query
from checks.tidy import big, dbl, tidy
from termscope import schemas as S
from termscope.operators import features as P
from termscope.operators import ingest as I
from termscope.operators import upsert as U
from termscope.session import scratch_dir
from termscope.sources import classes as C
from termscope.sources import published
from termscope.sources import tables as T
from termscope.sources.keyed import KeyedTable
from termscope.streaming import ingest as ST


def _concat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def pages(spark, sf_dir):
    """Every event as a class, four to a page, in the envelope shapes there are."""
    e = F.col("event_id")
    number = F.when(e % 13 == 0, '""').when(e % 17 == 0, "0").otherwise(
        F.when(e % 2 == 0, e.cast("string")).otherwise(_concat('"', e, '"'))
    )
    doc = F.when(e % 19 == 0, _concat('{"crse_id":', F.col("user_id"), "}")).otherwise(
        _concat('{"class_nbr":', number, ',"crse_id":', F.col("user_id"), ',"kind":"', F.col("event_type"), '"}')
    )
    page = (e / 4).cast("long")
    listed = (
        B.read(spark, sf_dir, "events")
        .groupBy(page.alias("page"))
        .agg(F.array_join(F.array_sort(F.collect_list(doc)), ",").alias("docs"))
    )
    docs, kind = F.col("docs"), F.col("page") % 6
    body = (
        F.when(kind == 0, _concat('{"results":[', docs, "]}"))
        .when(kind == 1, _concat("[", docs, "]"))
        .when(kind == 2, _concat('[{"classes":[', docs, "]}]"))
        .when(kind == 3, _concat('{"results":{"classes":[', docs, "]}}"))
        .when(kind == 4, _concat('{"results":[{"classes":[', docs, "]}]}"))
        .otherwise(_concat('{"results":null,"unused":[', docs, "]}"))
    )
    return listed.select(
        F.lit("1262").alias("term"), F.col("page").cast("int").alias("page"), body.alias("body"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page")).alias("fetched_at"),
    )


def unwrap_classes(spark, sf_dir):
    rows = C.unwrap_classes(pages(spark, sf_dir))
    return tidy(rows.select(
        "term", "page", F.variant_get("class", "$.crse_id", "bigint").alias("crse_id"),
        F.variant_get("class", "$.class_nbr", "string").alias("class_nbr"),
    ))


def rejected_pages(spark, sf_dir):
    """Every tenth page cut short, every thirtieth gone."""
    page = F.col("page")
    body = F.when(page % 30 == 0, F.lit(None).cast("string")).when(page % 10 == 0, F.substring("body", 1, 9)).otherwise(F.col("body"))
    cut = pages(spark, sf_dir).withColumn("body", body)
    read = C.unwrap_classes(cut).groupBy("page").agg(F.count("*").alias("classes"))
    return tidy(C.rejected_pages(cut).select("page", "error").join(read, "page", "full"))


def raw_rows(spark, sf_dir):
    return tidy(C.to_raw_rows(C.unwrap_classes(pages(spark, sf_dir))).drop("fetched_at"))


_MEETINGS = "array<struct<days:string,start_time:string,end_time:string>>"


def raw_classes(spark, sf_dir):
    """A payload for every section, with the optional parts present or not."""
    course, nbr = F.col("course_id"), F.col("class_nbr")
    n = course + F.col("capacity")
    meeting = F.struct(
        F.col("meetings_days").alias("days"), F.col("meetings_start_time").alias("start_time"),
        F.col("meetings_end_time").alias("end_time"),
    )
    person = F.struct(
        F.element_at(F.array(*map(F.lit, ("Ann Lee", "To Be Announced", "-", "Bo Ek", None))),
                     (n % 5 + 1).cast("int")).alias("name"),
        F.concat(course.cast("string"), F.lit("@example.org")).alias("email"),
    )
    other = F.struct(F.lit("Cy Ob").alias("name"), F.lit("cy@example.org").alias("email"))
    payload = F.to_json(F.struct(
        course.alias("crse_id"), F.concat(F.lit("Course "), course.cast("string")).alias("descr"),
        F.element_at(F.array(*map(F.lit, ("3", "3.0", "1 - 4", None))), (n % 4 + 1).cast("int")).alias("units"),
        F.lit("SUBJ").alias("subject"), (n % 5000).cast("string").alias("catalog_nbr"),
        F.element_at(F.array(*map(F.lit, ("LEC", "DIS", "LAB", None))), (F.col("seats_taken") % 4 + 1)).alias("component"),
        nbr.alias("class_nbr"), F.col("capacity").alias("class_capacity"),
        F.col("seats_taken").alias("enrollment_total"),
        F.when(n % 3 == 0, F.lit(None)).otherwise(F.lit(10)).alias("wait_cap"),
        F.col("enrollment_status").alias("enrl_stat"),
        F.when(n % 7 == 0, F.lit(None)).when(n % 7 == 1, F.array().cast(_MEETINGS)).otherwise(F.array(meeting)).alias("meetings"),
        F.when(n % 6 == 0, F.lit(None)).when(n % 6 == 1, F.array(person, other)).otherwise(F.array(person)).alias("instructors"),
    ))
    return B.section(spark, sf_dir, wide=True).select(
        "term_id", "class_nbr", payload.alias("payload"), (n % 9).alias("page_fetched"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
    )


def course_rows(spark, sf_dir):
    return tidy(I.course_rows(raw_classes(spark, sf_dir)))


def section_rows(spark, sf_dir):
    return tidy(I.section_rows(raw_classes(spark, sf_dir)))


def instructor_rows(spark, sf_dir):
    return tidy(I.instructor_rows(raw_classes(spark, sf_dir)))


def load_courses(spark, sf_dir):
    nothing = spark.createDataFrame([], S.COURSE)
    return tidy(I.load_courses(nothing, raw_classes(spark, sf_dir)))


# Upserts: customers are the stored rows, orders the updates.  Two of three
# orders hit a stored key, the others bring new keys.
def stored(spark, sf_dir):
    return B.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("title"),
        F.col("c_acctbal").alias("amount"), (F.col("c_nationkey") % 2 == 0).alias("flag"),
        F.col("c_mktsegment").alias("status"),
    )


def updates(spark, sf_dir):
    o = F.col("o_orderkey")
    return B.read(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + o % 3 * 10_000_000).alias("key"),
        F.concat(F.lit("order "), o.cast("string")).alias("title"),
        F.when(o % 4 != 0, F.col("o_totalprice")).alias("amount"),
        (F.col("o_orderstatus") == "F").alias("flag"), F.col("o_orderpriority").alias("status"),
        o.alias("seq"),
    )


def _upsert(**options):
    def run(spark, sf_dir):
        return tidy(U.upsert(stored(spark, sf_dir), updates(spark, sf_dir), ["key"], order_by=["seq"], **options))

    return run


def insert_missing(spark, sf_dir):
    rows = updates(spark, sf_dir)
    return tidy(U.insert_missing(stored(spark, sf_dir), rows, ["key"], ["seq"]).drop("seq"))


def replace_slice(spark, sf_dir):
    lines = B.read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("parent"), F.col("l_partkey").alias("item"), "l_quantity"
    )
    fresh = B.read(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 5000).select(
        F.col("s_suppkey").alias("parent"), (-F.col("s_suppkey")).alias("item"),
        F.col("s_acctbal").alias("l_quantity"),
    )
    return tidy(U.replace_slice(lines, fresh, ["parent"]))


def _page_figures(spark, sf_dir):
    key = F.col("l_partkey")
    return B.read(spark, sf_dir, "lineitem").select(
        key.cast("int").alias("course_id"), F.col("l_suppkey").alias("professor_id"),
        F.when(key % 4 == 0, "—").otherwise((key % 5).cast("string")).alias("rating"),
        F.when(key % 3 != 0, "2.25").alias("difficulty"),
    ).distinct().withColumn("rating", F.nullif("rating", F.lit("—")))


def _apply(legacy):
    def run(spark, sf_dir):
        links = B.section_professor(spark, sf_dir, legacy)
        return tidy(P.apply_ratings(links, _page_figures(spark, sf_dir), "1068", B.section(spark, sf_dir)))

    return run


_EVENT = "term_id string, class_nbr string, payload string, page_fetched int, fetched_at timestamp"


def _event_rows(df):
    return df.select(
        F.col("event_type").alias("term_id"), F.col("user_id").cast("string").alias("class_nbr"),
        F.col("event_id").cast("string").alias("payload"), F.lit(1).alias("page_fetched"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )


def stream_ingest(spark, sf_dir):
    """Events as a file stream, taken in twice: the second call finds nothing new."""
    schema = B.read(spark, sf_dir, "events").schema
    target, marks = scratch_dir(spark), scratch_dir(spark)
    for _ in range(2):
        source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        ST.stream_ingest(spark, source, target, marks, to_rows=_event_rows)
    rows = ST.current_rows(spark, target, _EVENT)
    return tidy(rows.select("term_id", "class_nbr", "payload"))


_KEYED = "key long, title string, amount double, flag boolean, status string"


def upsert_bucketed(spark, sf_dir):
    """The upsert on a table in buckets: only the buckets that the orders touch are read and written."""
    table = KeyedTable(spark, scratch_dir(spark), _KEYED, ["key"], buckets=32)
    table.create(stored(spark, sf_dir))
    table.upsert(updates(spark, sf_dir), order_by=["seq"])
    return tidy(table.rows())


def insert_bucketed(spark, sf_dir):
    table = KeyedTable(spark, scratch_dir(spark), _KEYED, ["key"], buckets=32)
    table.create(stored(spark, sf_dir))
    table.insert_missing(updates(spark, sf_dir), order_by=["seq"])
    return tidy(table.rows())


def stream_folded(spark, sf_dir):
    """Events landed in twelve files, streamed a file a batch, folded twice, then put into a table in buckets."""
    land, target, marks = (scratch_dir(spark) for _ in range(3))
    events = B.read(spark, sf_dir, "events")
    events.withColumn("file", F.col("event_id") % 12).write.partitionBy("file").parquet(land)
    table = KeyedTable(spark, scratch_dir(spark), _EVENT, list(ST.KEYS), buckets=16)
    for _ in range(2):
        files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(land)
        ST.stream_ingest(spark, files, target, marks, to_rows=_event_rows)
        ST.fold(spark, target, _EVENT, fanout=4)
    ST.absorb(spark, target, table, _EVENT)
    return tidy(table.rows().select("term_id", "class_nbr", "payload"))


def refresh_whole(spark, sf_dir):
    """Parts and labels refreshed twice as one set, the labels read from the current set."""
    path, parents = scratch_dir(spark), {"labels": ("part",), "part": ()}
    for _ in range(2):
        published.refresh(spark, path, lambda name: B.read(spark, sf_dir, name), parents, {"labels": ("quality", "toxic")})
    part = published.current(spark, path, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.lit(None).cast("boolean").alias("quality"))
    labels = published.current(spark, path, "labels").select(F.lit("label"), "doc_id", "quality")
    return tidy(part.unionAll(labels))


def copy_coerce(spark, sf_dir):
    """Labels copied through Parquet with flags to booleans, then through CSV."""
    out = scratch_dir(spark)
    T.copy_tables(
        lambda name: B.read(spark, sf_dir, name),
        lambda df, name: U.full_refresh(df, f"{out}/{name}"),
        ("part", "labels"), {"labels": ("quality", "toxic", "absent")},
    )
    T.write_csv(spark.read.parquet(f"{out}/labels"), f"{out}/csv")
    return spark.read.schema("doc_id bigint, quality boolean, toxic boolean").option("header", True).csv(f"{out}/csv")


QUERIES = {
    "unwrap_classes": unwrap_classes,
    "raw_rows": raw_rows,
    "rejected_pages": rejected_pages,
    "course_rows": course_rows,
    "section_rows": section_rows,
    "instructor_rows": instructor_rows,
    "load_courses": load_courses,
    "upsert_latest": _upsert(),
    "upsert_or_merge": _upsert(policies={"flag": U.OR}, default=U.KEEP),
    "upsert_partial": _upsert(set_cols=["status"]),
    "upsert_present": _upsert(policies={"amount": U.PRESENT}),
    "insert_missing": insert_missing,
    "replace_slice": replace_slice,
    "apply_ratings": _apply(False),
    "apply_ratings_legacy": _apply(True),
    "stream_ingest": stream_ingest,
    "copy_coerce": copy_coerce,
    "upsert_bucketed": upsert_bucketed,
    "insert_bucketed": insert_bucketed,
    "stream_folded": stream_folded,
    "refresh_whole": refresh_whole,
}

_CLASSES = {
    "landed": """
        SELECT event_id AS e, event_id // 4 AS page, user_id, event_type,
               CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ''
                    WHEN event_id % 17 = 0 THEN '0' ELSE event_id::VARCHAR END AS class_nbr
        FROM events WHERE (event_id // 4) % 6 <> 5""",
    "doc": """
        SELECT *, course_id + capacity AS n FROM section""",
    "course_doc": """
        SELECT course_id, 'Course ' || course_id AS title,
               CASE WHEN n % 4 = 0 THEN 3.0 END AS credits, 'SUBJ' AS subject_id,
               n % 5000 AS catalog_nbr, coalesce(component = 'DIS', false) AS has_discussion,
               coalesce(component = 'LAB', false) AS has_lab, component,
               n % 9 AS page_fetched, class_nbr, term_id
        FROM (SELECT *, ['LEC', 'DIS', 'LAB', NULL][seats_taken % 4 + 1] AS component FROM doc)""",
    "people": """
        SELECT ['Ann Lee', 'To Be Announced', '-', 'Bo Ek', NULL][n % 5 + 1] AS name,
               course_id || '@example.org' AS email, course_id, term_id FROM doc WHERE n % 6 <> 0
        UNION ALL SELECT 'Cy Ob', 'cy@example.org', course_id, term_id FROM doc WHERE n % 6 = 1
        UNION ALL SELECT NULL, NULL, course_id, term_id FROM doc WHERE n % 6 = 0""",
}
_UPSERT = {
    "old": """
        SELECT c_custkey AS key, c_name AS title, c_acctbal AS amount, c_nationkey % 2 = 0 AS flag,
               c_mktsegment AS status FROM customer""",
    "new": """
        SELECT o_custkey + o_orderkey % 3 * 10000000 AS key, 'order ' || o_orderkey AS title,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS amount,
               o_orderstatus = 'F' AS flag, o_orderpriority AS status, o_orderkey AS seq FROM orders""",
    "folded": """
        SELECT key, arg_min(title, seq) AS first_title, arg_max(title, seq) AS last_title,
               arg_min(struct_pack(v := amount), seq).v AS first_amount,
               arg_max(struct_pack(v := amount), seq).v AS last_amount,
               arg_max(amount, seq) FILTER (amount IS NOT NULL) AS known_amount,
               arg_min(flag, seq) AS first_flag, arg_max(flag, seq) AS last_flag, bool_or(flag) AS any_flag,
               arg_min(status, seq) AS first_status, arg_max(status, seq) AS last_status
        FROM new GROUP BY key""",
}


def _merged(title: str, amount: str, flag: str, status: str) -> str:
    return query(f"""
        SELECT coalesce(o.key, f.key) AS key, {title} AS title, round({amount}, 6) AS amount,
               {flag} AS flag, {status} AS status
        FROM old o FULL OUTER JOIN folded f ON o.key = f.key""", **_UPSERT)


def _kept(c: str) -> str:
    return f"CASE WHEN o.key IS NOT NULL THEN o.{c} ELSE f.first_{c} END"


def _set(c: str) -> str:
    return f"CASE WHEN f.key IS NOT NULL THEN f.last_{c} ELSE o.{c} END"


_FIGURES = """
    SELECT DISTINCT l_partkey AS course_id, l_suppkey AS professor_id,
           CASE WHEN l_partkey % 4 <> 0 THEN (l_partkey % 5)::DOUBLE END AS new_rating,
           CASE WHEN l_partkey % 3 <> 0 THEN 2.25 END AS new_difficulty FROM lineitem"""
_RATED = """
    CASE WHEN l.term_id = '1068' THEN coalesce(new_rating, rating) ELSE rating END::DOUBLE AS rating,
    CASE WHEN l.term_id = '1068' THEN coalesce(new_difficulty, difficulty) ELSE difficulty END::DOUBLE
        AS difficulty"""

ORACLES = {
    "unwrap_classes": query(
        "SELECT '1262' AS term, page, user_id AS crse_id, class_nbr FROM landed", **_CLASSES),
    "rejected_pages": query("""
        SELECT coalesce(p.page, l.page) AS page, p.error, l.classes
        FROM (SELECT DISTINCT event_id // 4 AS page,
                     CASE WHEN event_id // 4 % 30 = 0 THEN 'no body' ELSE 'no JSON in 9 characters' END AS error
              FROM events WHERE event_id // 4 % 10 = 0) p
        FULL JOIN (SELECT page, count(*) AS classes FROM landed WHERE page % 10 <> 0 GROUP BY page) l ON l.page = p.page""",
        **_CLASSES),
    "raw_rows": query("""
        SELECT '1262' AS term_id, class_nbr, page AS page_fetched,
               '{"class_nbr":' || CASE WHEN e % 2 = 0 THEN class_nbr ELSE '"' || class_nbr || '"' END
               || ',"crse_id":' || user_id || ',"kind":"' || event_type || '","fetched_at":"' ||
               strftime(make_timestamp((1700000000 + page) * 1000000), '%Y-%m-%d %H:%M:%S') ||
               '.000000+00:00","page":' || page || ',"term":"1262"}' AS payload
        FROM landed WHERE class_nbr NOT IN ('', '0')""", **_CLASSES),
    "course_rows": query(f"""
        SELECT {big("course_id", "catalog_nbr", "page_fetched")}, {dbl("credits")}, title, subject_id,
               has_discussion, has_lab, component, class_nbr, term_id FROM course_doc""", **_CLASSES),
    "section_rows": query(f"""
        SELECT {big("course_id", "capacity", "seats_taken")}, class_nbr, term_id, enrollment_status,
               CASE WHEN n % 3 = 0 THEN 0 ELSE 10 END::BIGINT AS waitlist_size,
               0::BIGINT AS current_waitlist,
               CASE WHEN n % 7 > 1 THEN coalesce(meetings_days, 'TBA') ELSE 'TBA' END AS meetings_days,
               CASE WHEN n % 7 > 1 THEN meetings_start_time ELSE 'TBA' END AS meetings_start_time,
               CASE WHEN n % 7 > 1 THEN meetings_end_time ELSE 'TBA' END AS meetings_end_time,
               (n % 9)::BIGINT AS page_fetched FROM doc""", **_CLASSES),
    "instructor_rows": query("""
        SELECT name, email, course_id::BIGINT AS course_id, term_id FROM people
        WHERE name IS NULL OR name NOT IN ('To Be Announced', '-')""", **_CLASSES),
    "load_courses": query(f"""
        SELECT course_id::BIGINT AS course_id, first.title, round(first.credits::DOUBLE, 6) AS credits,
               first.subject_id, first.catalog_nbr::BIGINT AS catalog_nbr, has_discussion, has_lab,
               first.component
        FROM (SELECT course_id, bool_or(has_discussion) AS has_discussion, bool_or(has_lab) AS has_lab,
                     arg_min(struct_pack(title, credits, subject_id, catalog_nbr, component),
                             (term_id, page_fetched, class_nbr)) AS first
              FROM course_doc GROUP BY course_id)""", **_CLASSES),
    "upsert_latest": _merged(_set("title"), _set("amount"), _set("flag"), _set("status")),
    "upsert_or_merge": _merged(
        _kept("title"), _kept("amount"),
        "CASE WHEN o.key IS NULL THEN any_flag WHEN f.key IS NULL THEN o.flag ELSE o.flag OR any_flag END",
        _kept("status")),
    "upsert_partial": _merged(_kept("title"), _kept("amount"), _kept("flag"), _set("status")),
    "upsert_present": _merged(_set("title"), "coalesce(f.known_amount, o.amount)", _set("flag"), _set("status")),
    "insert_missing": query("""
        SELECT key, title, round(amount, 6) AS amount, flag, status FROM old
        UNION ALL SELECT key, first_title, round(first_amount, 6), first_flag, first_status FROM folded
        WHERE key NOT IN (SELECT key FROM old)""", **_UPSERT),
    "replace_slice": """
        SELECT l_suppkey AS parent, l_partkey AS item, round(l_quantity, 6) AS l_quantity FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
        UNION ALL SELECT s_suppkey, -s_suppkey, round(s_acctbal, 6) FROM supplier WHERE s_acctbal > 5000""",
    "apply_ratings": query(f"""
        SELECT l.term_id, l.course_id::BIGINT AS course_id, l.professor_id, {_RATED}
        FROM section_professor l LEFT JOIN figures USING (course_id, professor_id)""", figures=_FIGURES),
    "apply_ratings_legacy": query(f"""
        SELECT l.term_id, l.class_nbr, l.professor_id, {_RATED}
        FROM section_professor_legacy l JOIN section s USING (term_id, class_nbr)
        LEFT JOIN figures f ON f.course_id = s.course_id AND f.professor_id = l.professor_id""",
        figures=_FIGURES),
    "stream_ingest": """
        SELECT event_type AS term_id, user_id::VARCHAR AS class_nbr,
               arg_max(event_id, ts)::VARCHAR AS payload FROM events GROUP BY event_type, user_id""",
    "copy_coerce": "SELECT doc_id, quality = 1 AS quality, toxic = 1 AS toxic FROM labels",
    "refresh_whole": """
        SELECT 'part' AS kind, p_partkey AS id, NULL::BOOLEAN AS quality FROM part
        UNION ALL SELECT 'label', doc_id, quality = 1 FROM labels""",
}
ORACLES |= {"upsert_bucketed": ORACLES["upsert_latest"], "insert_bucketed": ORACLES["insert_missing"], "stream_folded": ORACLES["stream_ingest"]}
