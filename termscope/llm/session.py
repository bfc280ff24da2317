"""The session as the operators' queries and stages use it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from termscope.session import local_scratch, tune

#: Rows of one Arrow batch.  Documents are long, and a batch is held several times over, by the JVM and by the worker.
BATCH_ROWS = 500


def prepared(spark: SparkSession) -> SparkSession:
    local_scratch(tune(spark)).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark
