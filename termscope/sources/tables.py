"""Stored tables: balanced reads, table copy and CSV export."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPY_ORDER = (
    "course", "section", "professor", "section_professor", "raw_class",
    "listing_page", "professor_page", "review", "review_summary",
)
FLAG_COLUMNS = {"course": ("has_discussion", "has_lab")}


def coerce_flags(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """0/1 or null flags to booleans; null is false; absent columns are skipped."""
    present = {c: F.coalesce(F.col(c).cast("int"), F.lit(0)) != 0 for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def copy_tables(
    reader: Callable[[str], DataFrame],
    writer: Callable[[DataFrame, str], None],
    names: Iterable[str] = COPY_ORDER,
    flags: Mapping[str, Iterable[str]] = FLAG_COLUMNS,
) -> None:
    """Copy tables in dependency order; ``writer`` empties the target first.

    ``reader`` may read Parquet or JDBC, e.g. ``lambda n: spark.read.jdbc(url, n)``.
    """
    for name in names:
        writer(coerce_flags(reader(name), flags.get(name, ())), name)


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV files with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
