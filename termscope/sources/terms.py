"""Tables stored by term, so that a query of one term reads one folder and the terms are known without a scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.operators.model import two_different
from termscope.sources import folders


def store_by_term(df: DataFrame, path: str, term: str = "term_id") -> None:
    """Write ``df`` in one folder per term; stored terms that it has are replaced, others stay.

    Files are balanced by size, so a large term has several and small ones share a task.
    """
    df.hint("rebalance", term).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(term).parquet(path)


def stored_terms(spark: SparkSession, path: str, term: str = "term_id") -> list[str]:
    """Terms in text order, from the folders' names; rows without term are not counted."""
    values = [n.removeprefix(f"{term}=") for n in folders.names(spark, path) if n.startswith(f"{term}=")]
    return sorted(v for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def two_stored_terms(spark: SparkSession, path: str, term: str = "term_id") -> tuple[str, str]:
    """First and last term without reading data; an error when there is only one."""
    terms = stored_terms(spark, path, term)
    return two_different(*((terms[0], terms[-1]) if terms else (None, None)))


def read_terms(spark: SparkSession, path: str, schema: str, terms: Iterable[str] | None = None, term: str = "term_id") -> DataFrame:
    """Rows of some terms (of all, without ``terms``), read from their folders alone; ``schema`` includes the term as text."""
    rows = spark.read.schema(schema).parquet(path)
    return rows if terms is None else rows.where(F.col(term).isin(*terms))
