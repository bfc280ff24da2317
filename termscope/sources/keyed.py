"""Keyed tables stored by hash bucket, so that a batch reads and writes only the buckets it touches.

A table is a folder of Parquet files partitioned by ``bucket_of_<n>``, the hash of
its bucket columns modulo n.  An operation finds the buckets of its batch (at most n
numbers), reads those through partition pruning, merges them with the batch as in
``operators.upsert``, and replaces just these partitions (dynamic partition overwrite:
new files are written aside and put in place when all tasks are done).  A join that
needs equal keys needs equal buckets, so the result is that of the whole table.

Files of a bucket are balanced by size before they are written: a parent key with very many
rows gives its bucket several files, and small buckets share a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.operators import upsert as U
from termscope.session import materialize
from termscope.sources import folders


@dataclass(frozen=True)
class KeyedTable:
    """A table below ``path``; ``keys`` are its bucket columns and must be among the keys of every operation.

    ``buckets`` is fixed when the table is made.  Choose it so that a bucket holds a
    few files; it bounds what a batch of one key rewrites to 1/buckets of the table.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: Sequence[str]
    buckets: int = field(default=64)

    @property
    def _bucket(self) -> str:
        return f"bucket_of_{self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def stored(self) -> DataFrame:
        """All rows with their bucket."""
        names = folders.names(self.spark, self.path)
        other = [n for n in names if n.startswith("bucket_of_") and not n.startswith(f"{self._bucket}=")]
        if other:
            raise ValueError(f"{self.path} is not laid out in {self.buckets} buckets: {other[0]}")
        if not any(n.startswith(f"{self._bucket}=") for n in names):
            return self.spark.createDataFrame([], f"{self.schema}, {self._bucket} int")
        return self.spark.read.schema(f"{self.schema}, {self._bucket} int").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.stored().drop(self._bucket)

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch: at most ``buckets`` numbers."""
        found = batch.select(self.bucket().alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    def within(self, touched: Sequence[int]) -> DataFrame:
        """Rows of some buckets; the scan leaves out the folders of all others."""
        return self.stored().where(F.col(self._bucket).isin(list(touched))).drop(self._bucket)

    def _replace(self, rows: DataFrame) -> None:
        placed = rows.withColumn(self._bucket, self.bucket()).hint("rebalance", self._bucket)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self._bucket).parquet(self.path)

    def create(self, rows: DataFrame) -> None:
        """Load ``rows`` into an empty table, one row per key as the caller gives them."""
        if folders.names(self.spark, self.path):
            raise ValueError(f"{self.path} is not empty")
        self._replace(rows)

    def _needs(self, keys: Sequence[str]) -> None:
        if not set(self.keys) <= set(keys):
            raise ValueError(f"buckets are by {list(self.keys)}, which must be among the keys {list(keys)}")

    def upsert(self, updates: DataFrame, keys: Sequence[str] | None = None, **options) -> list[int]:
        """``operators.upsert.upsert`` on the buckets of ``updates``; returns these buckets."""
        keys = keys or self.keys
        self._needs(keys)
        updates = materialize(updates)  # read for the buckets and for the merge
        touched = self.touched(updates)
        if touched:
            self._replace(U.upsert(self.within(touched), updates, keys, **options))
        return touched

    def insert_missing(self, rows: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[str | Column] = ()) -> list[int]:
        """Add rows whose key is new; an existing row is left as it is."""
        keys = keys or self.keys
        self._needs(keys)
        rows = materialize(rows)
        touched = self.touched(rows)
        if touched:
            columns = self.rows().columns
            self._replace(U.insert_missing(self.within(touched), rows, keys, order_by).select(*columns))
        return touched

    def replace_slice(self, rows: DataFrame, keys: Sequence[str] | None = None) -> list[int]:
        """Replace all rows of the parent keys found in ``rows`` by ``rows``."""
        keys = keys or self.keys
        self._needs(keys)
        rows = materialize(rows)
        touched = self.touched(rows)
        if touched:
            self._replace(U.replace_slice(self.within(touched), rows.select(*self.rows().columns), keys))
        return touched
