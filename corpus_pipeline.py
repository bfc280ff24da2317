"""The training-data pipeline: reject toxic texts, keep one of each near-duplicate class, reject benchmark leaks, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes a
stage's rows as Parquet in the shared scratch folder and reads them again as the next
stage's documents.  All stages but the last return the columns of ``documents``.

Rows that agree in id and text leave the near-duplicate stage as one row.  The
mixing stage repeats documents of sources that are below their share.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termscope.llm import decontaminate, mixing, near, tokens, toxicity
from termscope.llm.session import prepared
from termscope.session import materialize, scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.5  # score from which a document is rejected


def _stage(step: Stage) -> Stage:
    @wraps(step)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return step(prepared(spark), docs, sf_dir)

    return call


@_stage
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model, TOXIC_FROM)


@_stage
def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_per_class(docs, threshold=0.8)


@_stage
def reject_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_corpus(docs, weights=(5, 2, 1), max_epochs=3)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    tokens.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokens.read_tokens(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_each_class),
    ("decontamination", reject_leaks),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: The first stage is a trained model, which SQL does not state; tests/llm compares ``run`` with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token rows of the corpus below ``sf_dir``: doc_id, start, n_tokens, tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prepared(spark)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
