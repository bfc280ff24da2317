"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from termscope.sources import folders

_WHOLE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # ``side_by_side`` turns it off.
    _WHOLE_KEYS: "true",
    # Pages are long, and a batch is held several times over, by the JVM and by the worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}
_SHARED = "spark.checkpoint.dir"  # set when the cluster starts; a running session cannot change it
_OWN = "spark.termscope.scratch"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and return the session."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def side_by_side(spark: SparkSession) -> SparkSession:
    """Let rows that are dealt by some of a join's keys meet where they are; only for keys that no great part of the rows shares."""
    spark.conf.set(_WHOLE_KEYS, "false")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name under the cluster's shared folder ``spark.checkpoint.dir``.

    Where that is unset ``spark.termscope.scratch`` counts, and where both are
    it raises: a folder of one machine would lose rows.
    """
    root = spark.conf.get(_SHARED, None) or spark.conf.get(_OWN, None)
    if not root:
        raise ValueError(f"set {_SHARED} to a folder that the driver and all executors share, or pass a path")
    return f"{root.rstrip('/')}/termscope-{uuid.uuid4().hex}"


def local_scratch(spark: SparkSession) -> SparkSession:
    """Give a one-process session (tests, the bench) a scratch folder, if it has none.

    On a cluster nothing is set, so that ``scratch_dir`` raises.
    """
    unset = not spark.conf.get(_SHARED, None) and not spark.conf.get(_OWN, None)
    if unset and spark.sparkContext.master.split("[")[0] == "local":
        spark.conf.set(_OWN, tempfile.mkdtemp(prefix="termscope-"))
    return spark


def spread(df, *keys: str):
    """The rows dealt evenly (or by ``keys``) over as many tasks as a shuffle has.

    Short rows of a small file are one task, however much work each row is; and a shuffle that Spark plans
    itself is merged into a few tasks of 64 MB on the wire, however much wider the rows become in memory.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


_SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession):
    """The shuffles of what runs inside the block are removed as soon as its result is there."""
    before = spark.conf.get(_SWEEP, None)
    spark.conf.set(_SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SWEEP) if before is None else spark.conf.set(_SWEEP, before)


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)  # scratch tables to be removed


@contextmanager
def passing(spark: SparkSession):
    """Scratch tables that are written inside the block are removed when it ends, all but the last, which they were written for.

    Nothing that is used later may still have to be made from the others.
    """
    made: list[str] = []
    outer = _passing.set(made)
    last = None
    try:
        yield
        last = made.pop() if made else None
    finally:
        _passing.reset(outer)
        for path in made:
            folders.remove(spark, path)
        if last and outer.old_value not in (None, outer.MISSING):
            outer.old_value.append(last)


def materialize(df, path: str | None = None):
    """Write ``df`` as Parquet in the shared folder and read it back.

    The shuffles that made the rows are removed as soon as the rows are stored.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_dir(spark)
        if (made := _passing.get()) is not None:
            made.append(path)
    with swept(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
