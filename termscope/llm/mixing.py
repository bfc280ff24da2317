"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources share a word budget by weight.  A source whose share exceeds
``max_epochs`` times its size is clamped there, and the excess is dealt out
again by weight, round after round, until none is above.  Every document is
then taken ``whole`` times, and a seeded part of them once more: documents
stand in the order of a seeded hash, and those are taken whose middle lies
before the part that is still missing, so a source misses its target by half a
document at most.

Running sums go over (source, hash chunk), so a source with a third of all
rows is spread over ``16 ** chunk_digits`` chunks; raise the digits with the data.

Defined results: a null text has size 0, a null source is a source of its own
and stands last, rows that agree in id and text are drawn separately, an empty
table gives no rows, long texts are counted whole.  Extra columns are carried along; a name
that the operator adds (in any case) replaces an old column of that name, and helper columns
take names that no column has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscope.llm.columns import fresh
from termscope.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
ADDED = ("size", "source_size", "target", "repeats", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sizes: DataFrame) -> DataFrame:
    """Add ``rank``, the source's place by code point from 0, nulls last, without one task for all sources."""
    order = [F.col("source").isNull(), F.col("source")]
    dealt = materialize(sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # one row per task
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.withColumn("place", place).join(parts, "part").select(
        "source", "source_size", (F.col("before") + F.col("place") - 1).alias("rank"))


def water_filled(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """Add ``target`` to (source, source_size); a few sums per round reach the driver."""
    cycle = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = materialize(_ranked(sizes).select(
        "source", "source_size", cycle.cast("long").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap")))
    total, free = table.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = total = total or 0
    free = free or 1

    def above() -> Column:
        return F.col("weight") * F.lit(budget) / F.lit(float(free)) > F.col("cap")

    while True:
        clamped, left = table.agg(
            F.sum(F.when(above(), F.col("cap")).otherwise(0)), F.sum(F.when(above(), 0).otherwise(F.col("weight")))).first()
        step = (total - (clamped or 0), left or 0)
        if step == (budget, free) or not step[1]:
            break
        budget, free = step
    share = F.col("weight") * F.lit(budget) / F.lit(float(free))
    return table.select("source", "source_size", F.when(above(), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mixed(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix",
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chunk_digits: int = 3,
) -> DataFrame:
    """The documents with size, source_size, target, repeats (0 to ``max_epochs``) and taken (size x repeats)."""
    names = [c for c in docs.columns if c.lower() not in ADDED]
    source, size, draw, chunk, start, inner, whole, of_source, of_chunk, total, target = (
        fresh([*docs.columns, *ADDED], n) for n in (
            "_source", "_size", "_draw", "_chunk", "_start", "_inner", "_whole", "_of_source", "_of_chunk", "_total", "_target"))
    seeded = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in names], F.col(source_col).alias(source), word_count(F.col(text_col)).alias(size),
        seeded.alias(draw)).withColumn(chunk, F.substring(draw, 1, chunk_digits))
    chunks = materialize(rows.groupBy(source, chunk).agg(F.sum(size).alias("chunk_size")))
    sizes = chunks.groupBy(F.col(source).alias("source")).agg(F.sum("chunk_size").alias("source_size"))
    targets = water_filled(sizes, weights, max_epochs)

    earlier = Window.partitionBy(source).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select(
        F.col(source).alias(of_source), F.col(chunk).alias(of_chunk), F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias(start))
    starts = starts.join(targets, F.col(of_source).eqNullSafe(F.col("source"))).select(
        of_source, of_chunk, start, F.col("source_size").alias(total), F.col("target").alias(target))

    within = Window.partitionBy(source, chunk).orderBy(draw, size).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn(inner, F.coalesce(F.sum(size).over(within), F.lit(0)))
    joined = placed.join(starts, F.col(source).eqNullSafe(F.col(of_source)) & (F.col(chunk) == F.col(of_chunk)))
    filled = F.floor(F.col(target) / F.col(total))
    joined = joined.withColumn(whole, F.when(F.col(total) > 0, filled).otherwise(0).cast("long"))
    missing = F.col(target) - F.col(whole) * F.col(total)
    once_more = F.col(start) + F.col(inner) + F.col(size) / 2 < missing
    repeats = F.col(whole) + once_more.cast("long")
    return joined.select(
        *[F.col(f"`{c}`") for c in names], F.col(size).alias("size"), F.col(total).alias("source_size"),
        F.col(target).alias("target"), repeats.alias("repeats"), (F.col(size) * repeats).alias("taken"))


def repeated(mix: DataFrame) -> DataFrame:
    """The mixed corpus itself: each document as often as it is taken, with the documents' own columns."""
    copy = fresh(mix.columns, "_copy")
    each = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return mix.where("repeats > 0").withColumn(copy, each).drop(copy, *ADDED)


def mixed_corpus(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with all of the documents' columns, also those named like what ``mixed`` adds."""
    aside = {c: fresh(docs.columns, f"_{c}_of_docs") for c in docs.columns if c.lower() in ADDED}
    out = repeated(mixed(docs.withColumnsRenamed(aside), **options))
    return out.withColumnsRenamed({b: a for a, b in aside.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])
