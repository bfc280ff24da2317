"""A set of tables that is refreshed as a whole or not at all.

Every refresh writes its tables into a folder of its own and, when all are complete,
puts that folder's name into the one-line file ``current`` in a single step.  Readers
follow the file, so they see all of the old tables or all of the new ones, also
where a refresh breaks off between two tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from termscope.sources import folders
from termscope.sources.tables import FLAG_COLUMNS, coerce_flags

#: The tables whose keys a table refers to.
PARENTS = {
    "course": (), "professor": (), "listing_page": (), "raw_class": (),
    "section": ("course",), "section_professor": ("course", "professor"), "professor_page": ("listing_page",),
    "review": ("professor_page",), "review_summary": ("review",),
}


def parents_first(parents: Mapping[str, Iterable[str]]) -> list[str]:
    """Tables in an order in which parents precede their children, by name where that is open; a cycle raises."""
    order, sorter = [], TopologicalSorter({t: sorted(p) for t, p in sorted(parents.items())})
    sorter.prepare()
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        order += ready
        sorter.done(*ready)
    return order


def refresh(
    spark: SparkSession,
    path: str,
    reader: Callable[[str], DataFrame],
    parents: Mapping[str, Iterable[str]] = PARENTS,
    flags: Mapping[str, Iterable[str]] = FLAG_COLUMNS,
    keep: int = 1,
) -> str:
    """Write all tables that ``reader`` gives, parents first, then make them the current set; returns its name.

    ``keep`` older sets stay for readers that began before; sets of refreshes that
    broke off are removed with the others.
    """
    name = uuid.uuid4().hex
    for table in parents_first(parents):
        coerce_flags(reader(table), flags.get(table, ())).write.parquet(f"{path}/sets/{name}/{table}")
    before = _history(spark, path)
    folders.put_line(spark, f"{path}/current", "\n".join([name, *before][: keep + 1]))
    for old in set(folders.names(spark, f"{path}/sets")) - set(_history(spark, path)):
        folders.remove(spark, f"{path}/sets/{old}")
    return name


def _history(spark: SparkSession, path: str) -> list[str]:
    return (folders.read_line(spark, f"{path}/current") or "").split()


def current(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of the current set."""
    names = _history(spark, path)
    if not names:
        raise ValueError(f"{path} has no complete set of tables")
    return spark.read.parquet(f"{path}/sets/{names[0]}/{table}")
