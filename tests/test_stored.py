"""Tables in buckets, folded stream batches, and refreshes that are whole or not there."""

from graphlib import CycleError
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from termscope.operators import upsert as U
from termscope.sources import published as P
from termscope.sources import terms as T
from termscope.sources.keyed import KeyedTable
from termscope.streaming import ingest as ST

SCHEMA = "k long, v string, n int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


@pytest.fixture()
def table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=16)
    table.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("n")))
    return table


def batch(spark, *keys, v="new"):
    return spark.createDataFrame([(k, v, 2) for k in keys], SCHEMA)


def test_an_update_reads_and_writes_only_its_buckets(spark, table, tmp_path):
    updates = batch(spark, 5, 5, 77, 5000)
    want = rows_of(U.upsert(table.rows(), updates, ["k"], policies={"n": U.KEEP}))
    before, touched = files(table.path), table.touched(updates)
    assert 1 <= len(touched) <= 3
    other = [f for f in before if not any(f"bucket_of_16={b}/" in f for b in touched)]
    contents = {f: Path(f).read_bytes() for f in other}
    for f in other:
        Path(f).write_bytes(b"unreadable")  # a read of any other bucket would fail
    assert table.upsert(updates, policies={"n": U.KEEP}) == touched
    for f, data in contents.items():
        assert Path(f).read_bytes() == b"unreadable"
        Path(f).write_bytes(data)
    assert rows_of(table.rows()) == want
    after = files(table.path)
    assert all(any(f"bucket_of_16={b}/" in f for b in touched) for f in set(after) ^ set(before))


def test_operations_equal_those_on_whole_tables(spark, table):
    updates = batch(spark, *range(990, 1010))
    want = rows_of(U.insert_missing(table.rows(), updates, ["k"]))
    table.insert_missing(updates)
    assert rows_of(table.rows()) == want
    slices = spark.createDataFrame([(3, "a", 1), (3, "b", 2), (2000, "c", 3)], SCHEMA)
    want = rows_of(U.replace_slice(table.rows(), slices, ["k"]))
    table.replace_slice(slices)
    assert rows_of(table.rows()) == want
    again = rows_of(table.rows())
    table.upsert(batch(spark))
    table.insert_missing(updates)
    assert rows_of(table.rows()) == again
    none = spark.createDataFrame([(None, "null key", 1)], SCHEMA)
    table.insert_missing(none)
    assert table.rows().where("k is null").count() == 1


def test_layouts_are_not_mixed(spark, table):
    with pytest.raises(ValueError, match="not laid out"):
        KeyedTable(spark, table.path, SCHEMA, ["k"], buckets=8).rows()
    with pytest.raises(ValueError, match="must be among the keys"):
        table.upsert(batch(spark, 1), keys=["v"])
    with pytest.raises(ValueError, match="not empty"):
        table.create(batch(spark, 1))
    empty = KeyedTable(spark, table.path + "2", SCHEMA, ["k"])
    assert empty.rows().count() == 0
    empty.upsert(batch(spark, 1, 1))
    assert rows_of(empty.rows()) == [(1, "new", 2)]


def test_a_hot_parent_has_several_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "hot"), SCHEMA, ["k"], buckets=4)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(40_000).select(F.lit(1).cast("long").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("n"))
        table.create(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(files(table.path)) > 1 and table.rows().count() == 40_000


EVENT = "term_id string, class_nbr string, payload string, page_fetched int, fetched_at timestamp"


def landed(spark, target, number, rows):
    made = spark.createDataFrame([("1", k, p, 1) for k, p in rows], "term_id string, class_nbr string, payload string, page_fetched int")
    made.withColumn("fetched_at", F.timestamp_seconds(F.lit(0))).write.parquet(f"{target}/tier=0/batch={number}")


def test_folding_keeps_rows_and_few_batches(spark, tmp_path):
    target = str(tmp_path / "s")
    for n in range(11):
        landed(spark, target, n, [("a", f"a{n}"), (f"k{n % 4}", f"p{n}")])
    want = rows_of(ST.current_rows(spark, target, EVENT).select("class_nbr", "payload"))
    assert ST.fold(spark, target, EVENT, fanout=3) == 4
    assert ST.batches(spark, target) == {0: [9, 10], 2: [8]}
    assert rows_of(ST.current_rows(spark, target, EVENT).select("class_nbr", "payload")) == want
    landed(spark, target, 11, [("a", "latest")])
    ST.fold(spark, target, EVENT, fanout=3)
    assert ("a", "latest") in rows_of(ST.current_rows(spark, target, EVENT).select("class_nbr", "payload"))


def test_a_fold_that_was_cut_off_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "s")
    for n in range(3):
        landed(spark, target, n, [("a", f"a{n}"), (f"k{n}", "x")])
    want = rows_of(ST.current_rows(spark, target, EVENT).select("class_nbr", "payload"))
    with monkeypatch.context() as cut:
        cut.setattr(ST.folders, "remove", lambda *_: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            ST.fold(spark, target, EVENT, fanout=3)
    assert rows_of(ST.current_rows(spark, target, EVENT).select("class_nbr", "payload")) == want
    assert ST.fold(spark, target, EVENT, fanout=3) == 1 and ST.batches(spark, target) == {1: [2]}
    assert rows_of(ST.current_rows(spark, target, EVENT).select("class_nbr", "payload")) == want


def test_batches_go_into_a_keyed_table(spark, tmp_path):
    target, table = str(tmp_path / "s"), KeyedTable(spark, str(tmp_path / "t"), EVENT, list(ST.KEYS), buckets=8)
    landed(spark, target, 0, [("a", "a0"), ("b", "b0")])
    ST.absorb(spark, target, table, EVENT)
    landed(spark, target, 1, [("a", "a1")])
    assert len(ST.absorb(spark, target, table, EVENT)) == 1
    assert ST.batches(spark, target) == {} and ST.absorb(spark, target, table, EVENT) == []
    assert rows_of(table.rows().select("class_nbr", "payload")) == [("a", "a1"), ("b", "b0")]


def test_parents_come_first_and_cycles_raise():
    order = P.parents_first(P.PARENTS)
    assert all(order.index(p) < order.index(t) for t, ps in P.PARENTS.items() for p in ps)
    assert order == P.parents_first(dict(reversed(P.PARENTS.items())))
    with pytest.raises(CycleError):
        P.parents_first({"a": ["b"], "b": ["a"]})


def test_a_refresh_is_whole_or_not_there(spark, tmp_path):
    path, parents = str(tmp_path / "p"), {"course": (), "section": ("course",)}

    def source(v, broken=False):
        def read(name):
            if broken and name == "section":
                raise OSError("source went away")
            return spark.createDataFrame([(v, 1)], "v string, has_lab int")
        return read

    def seen():
        return {t: tuple(P.current(spark, path, t).first()) for t in parents}

    with pytest.raises(ValueError, match="no complete set"):
        P.current(spark, path, "course")
    P.refresh(spark, path, source("one"), parents)
    assert seen() == {"course": ("one", True), "section": ("one", 1)}
    with pytest.raises(OSError):
        P.refresh(spark, path, source("two", broken=True), parents)
    assert seen() == {"course": ("one", True), "section": ("one", 1)}
    reading = P.current(spark, path, "course")
    P.refresh(spark, path, source("three"), parents)
    assert seen()["section"] == ("three", 1) and reading.first().v == "one"
    assert len(list((tmp_path / "p" / "sets").iterdir())) == 2


def test_a_term_is_read_from_its_folder(spark, tmp_path):
    path, schema = str(tmp_path / "section"), "n int, term_id string"
    rows = [(k, str(1250 + 2 * (k % 5))) for k in range(100)]
    T.store_by_term(spark.createDataFrame(rows, schema), path)
    for f in Path(path).rglob("*.parquet"):
        if "term_id=1254" not in str(f) and "term_id=1256" not in str(f):
            f.write_bytes(b"unreadable")  # a read of any other term would fail
    assert T.two_stored_terms(spark, path) == ("1250", "1258")
    some = T.read_terms(spark, path, schema, ["1254", "1256"])
    assert rows_of(some) == sorted(((k, t) for k, t in rows if t in ("1254", "1256")), key=str)
    board = some.where(F.col("term_id") == "1254").groupBy("term_id").count()
    assert rows_of(board) == [("1254", 20)]
    T.store_by_term(spark.createDataFrame([(1, "1250"), (7, "1250")], schema), path)
    assert rows_of(T.read_terms(spark, path, schema, ["1250"])) == [(1, "1250"), (7, "1250")]
    assert T.stored_terms(spark, path) == ["1250", "1252", "1254", "1256", "1258"]
    with pytest.raises(ValueError):
        T.two_stored_terms(spark, str(tmp_path / "nothing"))
