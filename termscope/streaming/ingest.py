"""Incremental, idempotent ingestion of landed class pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termscope import schemas as S
from termscope.operators.upsert import dedupe
from termscope.sources import folders
from termscope.sources.classes import from_files, rejected_pages, to_raw_rows, unwrap_classes
from termscope.sources.keyed import KeyedTable

KEYS = ("term_id", "class_nbr")
NEWEST = ("fetched_at", "page_fetched")


def raw_rows_of(pages: DataFrame) -> DataFrame:
    """Response pages to raw class rows."""
    return to_raw_rows(unwrap_classes(pages))


def stream_ingest(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    checkpoint: str,
    to_rows: Callable[[DataFrame], DataFrame] = raw_rows_of,
    keys=KEYS,
    newest=NEWEST,
    files_per_batch: int = 1000,
    rejects: str | None = None,
) -> None:
    """Take in everything that landed since the last call, then stop.

    A batch writes only its own latest row per key, as ``tier=0/batch=N`` below
    ``target``.  Its cost does not depend on what is stored, and a batch that
    is run again after a failure overwrites itself.  ``current_rows`` merges
    on read; ``fold`` keeps the batches that it merges few.  Pages that cannot be read are
    written below ``rejects`` in the same way; without that folder they fail
    the batch instead of getting lost.
    """
    if isinstance(source, str):
        files = (
            spark.readStream.format("text")
            .option("wholetext", True)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", files_per_batch)
            .load(source)
        )
        source = from_files(files)

    def write(batch: DataFrame, number: int) -> None:
        if to_rows is raw_rows_of:
            unread = rejected_pages(batch)
            if rejects:
                unread.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
            elif not unread.isEmpty():
                raise ValueError(f"batch {number} holds pages without JSON, e.g. {unread.first()}; pass a folder for rejects")
        latest = dedupe(to_rows(batch), keys, newest, keep="last")
        latest.write.mode("overwrite").parquet(f"{target}/tier=0/batch={number}")

    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_rows(
    spark: SparkSession, target: str, schema: str = S.RAW_CLASS, keys=KEYS, newest=NEWEST
) -> DataFrame:
    """Latest row per key over all batches; a later batch wins equal times."""
    stored = spark.read.schema(f"{schema}, tier int, batch bigint").parquet(target)
    return dedupe(stored.drop("tier"), keys, [*newest, "batch"], keep="last").drop("batch")


def batches(spark: SparkSession, target: str) -> dict[int, list[int]]:
    """Stored batch numbers by tier, in order."""
    tiers = [int(n.split("=")[1]) for n in folders.names(spark, target) if n.startswith("tier=")]
    found = {t: [n for n in folders.names(spark, f"{target}/tier={t}") if n.startswith("batch=")] for t in tiers}
    return {t: sorted(int(n.split("=")[1]) for n in names) for t, names in found.items() if names}


def fold(
    spark: SparkSession, target: str, schema: str = S.RAW_CLASS, keys=KEYS, newest=NEWEST, fanout: int = 8
) -> int:
    """Merge the oldest ``fanout`` batches of a tier into one of the next, as long as a tier has so many.

    A row is rewritten once per tier, so the work per batch grows with the
    logarithm of the batches, as does the number of folders that a read merges.
    A merged batch carries the last number it holds, hence equal times are decided
    as before.  Rows are deleted only after the merged batch is complete, and rows
    found twice in between merge to the same, so a fold that is cut off can be run again.
    Call it between two runs of the stream; returns the number of merges.
    """
    merges, tier = 0, 0
    while True:
        stored = batches(spark, target)
        if tier > max(stored, default=-1):
            return merges
        own = stored.get(tier, [])
        while len(own) >= fanout:
            some, own = own[:fanout], own[fanout:]
            paths = [f"{target}/tier={tier}/batch={n}" for n in some]
            rows = spark.read.option("basePath", target).schema(f"{schema}, tier int, batch bigint").parquet(*paths)
            merged = dedupe(rows.drop("tier"), keys, [*newest, "batch"], keep="last").drop("batch")
            merged.write.mode("overwrite").parquet(f"{target}/tier={tier + 1}/batch={some[-1]}")
            for path in paths:
                folders.remove(spark, path)
            merges += 1
        tier += 1


def compact(spark: SparkSession, target: str, into: str, schema: str = S.RAW_CLASS, keys=KEYS, newest=NEWEST) -> None:
    """Write the current rows as the single batch of a new target folder."""
    rows = current_rows(spark, target, schema, keys, newest)
    rows.write.mode("overwrite").parquet(f"{into}/tier=0/batch=-1")


def absorb(spark: SparkSession, target: str, table: KeyedTable, schema: str = S.RAW_CLASS, newest=NEWEST) -> list[int]:
    """Upsert the current rows of the batches into a keyed table and drop the batches; returns the buckets written.

    Only the buckets of keys that came in are read and written.  Batches go when the
    table holds their rows; a call that was cut off before can be repeated.
    Later times win in the stream; what it brings replaces what the table has.
    """
    stored = batches(spark, target)
    if not stored:
        return []
    touched = table.upsert(current_rows(spark, target, schema, table.keys, newest))
    for tier, numbers in stored.items():
        for n in numbers:
            folders.remove(spark, f"{target}/tier={tier}/batch={n}")
    return touched
