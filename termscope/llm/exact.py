"""Exact dedup by deterministic block naming, in DataFrame functions only.

Every text is cut into fixed-size blocks.  A block's integer name is a bucket
(a 64-bit hash) and the block's place among the sorted distinct blocks of that
bucket, so two different blocks never share a name.  Adjacent names are then
named as pairs, level by level, until each document has one name.  Together
with the text's length that name is its identity.

Only a bucket that really holds two blocks needs the sorted place; a job per
level finds those buckets by comparing the blocks themselves, and every other
block has place 0.  The blocks cross the network once, combined on the map
side; levels above carry integers only.

Defined results: a null text counts as empty, empty texts are equal to each
other, a null id is smaller than any other, and of rows that agree in id and
text exactly one is kept.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope.session import materialize

BLOCK_CHARS = 4096
_NO_NAME = "named_struct('b', 0L, 'r', -1)"  # right half of the last pair of an odd row


def hash_bucket(value: Column) -> Column:
    """64-bit bucket of a block or of a pair of names."""
    return F.xxhash64(value)


def _collided(rows: DataFrame, bucket: Callable[[Column], Column]) -> DataFrame:
    """Buckets that hold several of the rows' ``values``: (bucket, places), places sorted."""
    each = rows.select(F.explode("values").alias("v"))
    return (
        each.groupBy(bucket(F.col("v")).alias("bucket"))
        .agg(F.array_sort(F.collect_set("v")).alias("places"))
        .where(F.size("places") > 1)
    )


def _with_places(rows: DataFrame, collided: DataFrame, bucket: Callable[[Column], Column]) -> DataFrame:
    """(uid, names) for rows some of whose values share a bucket with another value."""
    each = rows.select("uid", F.posexplode_outer("values").alias("pos", "v"))
    placed = each.withColumn("bucket", bucket(F.col("v"))).join(collided, "bucket", "left")
    name = F.struct(
        "pos", F.col("bucket").alias("b"),
        F.coalesce(F.array_position("places", F.col("v")).cast("int") - 1, F.lit(0)).alias("r"),
    )
    lists = placed.groupBy("uid").agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), name))).alias("n"))
    return lists.select("uid", F.transform("n", lambda x: F.struct(x.b.alias("b"), x.r.alias("r"))).alias("names"))


def _name(rows: DataFrame, bucket: Callable[[Column], Column], again: Callable[[], DataFrame]) -> DataFrame:
    """Replace each row's ``values`` by ``names``.

    ``again`` gives the same rows from a stored table, for the rare case that
    places have to be joined by row.
    """
    collided = materialize(_collided(rows, bucket))
    if collided.isEmpty():
        first = F.transform("values", lambda v: F.struct(bucket(v).alias("b"), F.lit(0).alias("r")))
        return rows.withColumn("names", first).drop("values")
    rows = again()
    return rows.drop("values").join(_with_places(rows, collided, bucket), "uid")


def identities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    block_chars: int = BLOCK_CHARS, bucket: Callable[[Column], Column] = hash_bucket,
) -> DataFrame:
    """(uid, id, n_chars, sha256, name struct<b, r>) for every row; equal texts have equal (n_chars, name)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), text.alias("text"))
    cut = rows.select(
        "uid", "id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("sha256"),
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)).alias("values"),
    )
    named = materialize(_name(cut, bucket, lambda: materialize(cut)))
    while True:
        longest = named.agg(F.max(F.size("names"))).first()[0] or 0
        if longest <= 1:
            break
        pair = "transform(sequence(0, size(names) - 1, 2), i -> struct(names[i] as l, coalesce(get(names, i + 1), {}) as r))"
        pairs = named.select(
            "uid", "id", "n_chars", "sha256", F.col("names").alias("done"),
            F.when(F.size("names") > 1, F.expr(pair.format(_NO_NAME))).alias("values"),
        )
        higher = _name(pairs, bucket, lambda: pairs)
        kept = F.when(F.size("done") > 1, F.col("names")).otherwise(F.col("done"))
        named = materialize(higher.select("uid", "id", "n_chars", "sha256", kept.alias("names")))
    name = F.coalesce(F.get("names", F.lit(0)), F.expr(_NO_NAME))
    return named.select("uid", "id", "n_chars", "sha256", name.alias("name"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    block_chars: int = BLOCK_CHARS, bucket: Callable[[Column], Column] = hash_bucket,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id is kept.
    """
    rows = identities(docs, id_col, text_col, block_chars, bucket)
    key = [F.col("n_chars"), F.col("name.b").alias("b"), F.col("name.r").alias("r")]
    rows = rows.select("uid", "id", "sha256", *key)
    groups = rows.groupBy("n_chars", "b", "r").agg(
        F.max(F.struct("id", "uid")).alias("top"), F.count("*").alias("group_size"))
    return rows.join(groups, ["n_chars", "b", "r"]).select(
        F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("top.uid")).alias("kept"), F.col("sha256").alias("text_sha256"),
    )
