"""Model metrics, thresholds, scaling statistics and exact medians."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscope import defaults as D
from termscope.session import materialize

THRESHOLDS = tuple(i / 100 for i in range(30, 71))
BLANK_THRESHOLD = 0.50


def _ratio(a: Column, b: Column, empty: float) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(empty))


def _scores(tp: Column, tn: Column, fp: Column, fn: Column) -> list[Column]:
    """accuracy, precision, recall and f1 from the four counts."""
    precision, recall = _ratio(tp, tp + fp, 0.0), _ratio(tp, tp + fn, 0.0)
    both = precision + recall
    return [
        _ratio(tp + tn, tp + tn + fp + fn, math.nan).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(both > 0, 2 * precision * recall / both).otherwise(0.0).alias("f1"),
    ]


def classification_metrics(df: DataFrame, y: str, p: str, threshold: float = D.FILL_THRESHOLD) -> DataFrame:
    """One row: accuracy, precision, recall, f1, brier and the four counts."""
    hit, true = F.col(p) >= threshold, F.col(y) == 1
    counts = df.agg(
        F.count_if(hit & true).alias("tp"),
        F.count_if(~hit & ~true).alias("tn"),
        F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & true).alias("fn"),
        F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return counts.select(*_scores(tp, tn, fp, fn), "brier", "tp", "tn", "fp", "fn")


def running_total(df: DataFrame, value: str, amount: str, chunks: int) -> DataFrame:
    """Add ``below``: the sum of ``amount`` over rows with a smaller ``value``.

    Values must be distinct.  They are cut at quantiles into chunks, so the
    running total is a window per chunk plus a carried total, never one sort
    of all rows in one task.
    """
    cuts = df.approxQuantile(value, [i / chunks for i in range(1, chunks)], 0.25 / chunks)
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    binned = Bucketizer(splits=splits, inputCol=value, outputCol="chunk").transform(df)
    # At most ``chunks`` rows reach this window.
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = binned.groupBy("chunk").agg(F.sum(amount).alias("sum")).select(
        "chunk", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("carry")
    )
    inside = Window.partitionBy("chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("carry") + F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return binned.join(carried, "chunk").select(*df.columns, below.alias("below"))


def roc_auc(df: DataFrame, y: str, p: str, chunks: int = 256) -> DataFrame:
    """One row ``roc_auc``: ties share their rank; NaN when a class is missing.

    Equal scores are added up first, then each meets the lower-scored negatives.
    """
    scores = df.groupBy(F.col(p).cast("double").alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    # Read for the cuts, for the chunks' totals and for the ranks.
    ranked = running_total(materialize(scores), "score", "neg", chunks)
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.when(pairs > 0, wins / pairs).otherwise(F.lit(math.nan)).alias("roc_auc"))


def probability_metrics(df: DataFrame, truth: str, predicted: str, observed: str) -> DataFrame:
    """One row: mean absolute and root mean square error, Brier score, correlation."""
    error = F.col(truth) - F.col(predicted)
    return df.agg(
        F.avg(F.abs(error)).alias("mae_probability"),
        F.sqrt(F.avg(F.pow(error, 2))).alias("rmse_probability"),
        F.avg(F.pow(F.col(predicted) - F.col(observed), 2)).alias("brier_against_binary_outcome"),
        F.corr(truth, predicted).alias("probability_correlation"),
    )


def threshold_sweep(df: DataFrame, y: str, p: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Metrics for every threshold, from one pass over the rows.

    Each row falls between two thresholds; only the counts per gap are kept,
    and a threshold's counts are those of the gaps on its two sides.
    """
    splits = [-math.inf, *thresholds, math.inf]
    binned = Bucketizer(splits=splits, inputCol=p, outputCol="gap").transform(
        df.select(F.col(p).cast("double").alias(p), F.col(y).alias(y))
    )
    gaps = binned.groupBy("gap").agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(float(n + 1), t) for n, t in enumerate(thresholds)] + [(0.0, None)], "gap double, threshold double"
    )
    # As many rows as thresholds reach these windows.
    up = Window.orderBy("gap").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    down = Window.orderBy("gap").rowsBetween(Window.unboundedPreceding, -1)
    full = grid.join(gaps, "gap", "left").fillna(0, ["pos", "neg"])
    counts = full.select(
        "threshold",
        F.sum("pos").over(up).alias("tp"),
        F.sum("neg").over(up).alias("fp"),
        F.sum("pos").over(down).alias("fn"),
        F.sum("neg").over(down).alias("tn"),
    ).filter(F.col("threshold").isNotNull())
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return counts.select("threshold", *_scores(tp, tn, fp, fn), "tp", "tn", "fp", "fn")


def select_threshold(df: DataFrame, y: str, p: str, thresholds: Sequence[float] = THRESHOLDS) -> float:
    """Threshold with the best (accuracy, f1); the smallest wins ties."""
    sweep = threshold_sweep(df, y, p, thresholds).filter(~F.isnan("accuracy"))
    best = sweep.orderBy(F.desc("accuracy"), F.desc("f1"), "threshold").first()
    return best["threshold"] if best else BLANK_THRESHOLD


def metric_rows(df: DataFrame) -> DataFrame:
    """A one-row metric table turned into (metric, value) rows."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
    return wide.unpivot([], wide.columns, "metric", "value")


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a zero deviation becomes 1."""
    row = scaler_table(df, columns).first()
    return {c: (row[f"mean_{c}"], row[f"scale_{c}"]) for c in columns}


def scaler_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The scaler as one row of mean_* and scale_* columns."""
    values = {c: F.col(f"`{c}`").cast("double") for c in columns}
    stats = df.agg(
        *[F.avg(v).alias(f"mean_{c}") for c, v in values.items()],
        *[F.stddev_pop(v).alias(f"scale_{c}") for c, v in values.items()],
    )
    fixed = {
        f"scale_{c}": F.when(F.col(f"`scale_{c}`") == 0, 1.0).otherwise(F.col(f"`scale_{c}`"))
        for c in columns
    }
    return stats.withColumns(fixed)


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Standardise columns with the statistics of the training rows."""
    return df.withColumns(
        {c: (F.col(f"`{c}`").cast("double") - F.lit(mean)) / F.lit(scale) for c, (mean, scale) in scaler.items()}
    )


ACCURACY = 10_000  # of the approximate quantiles that fence the median in


def _fences(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """Per column with values: how many, and two values between which the median lies, by one aggregate for all."""
    edge = 3 / ACCURACY
    found = df.agg(*[
        F.struct(F.count(f"`{c}`"), F.percentile_approx(F.col(f"`{c}`").cast("double"), [0.5 - edge, 0.5 + edge], ACCURACY)).alias(f"c{k}")
        for k, c in enumerate(columns)]).first()
    return {c: (n, *fences) for c, (n, fences) in zip(columns, found, strict=True) if n}


def _counts_between(df: DataFrame, fences: dict[str, tuple[int, float, float]]) -> DataFrame:
    """(column, v, n): equal values between the fences, and as a null value all that are below."""
    def kept(k: int, c: str, low: float, high: float) -> Column:
        v = F.col(f"`{c}`").cast("double")
        return F.when(v <= high, F.struct(F.lit(k).alias("column"), F.when(v >= low, v).alias("v")))

    each = F.array_compact(F.array(*[kept(k, c, low, high) for k, (c, (_, low, high)) in enumerate(fences.items())]))
    return df.select(F.explode(each).alias("x")).groupBy("x.column", "x.v").agg(F.count("*").alias("n"))


def _at_ranks(counts: DataFrame, ranks: Sequence[tuple[int, int]]) -> dict[int, tuple[float | None, float | None]]:
    """Per column the values at two ranks, from 0; ranges of (column, v) with what earlier ranges hold, so no task sorts a column."""
    dealt = materialize(counts.repartitionByRange("column", "v").withColumn("chunk", F.spark_partition_id()))
    # As many rows as there are ranges and columns.
    earlier = Window.partitionBy("column").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("column", "chunk").agg(F.sum("n").alias("n")).select(
        "column", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("column", "chunk").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = dealt.join(before, ["column", "chunk"]).withColumn("below", below)

    def at(which: int) -> Column:
        rank = F.element_at(F.array(*[F.lit(r[which]) for r in ranks]), F.col("column") + 1)
        return F.max(F.when((F.col("below") <= rank) & (F.col("below") + F.col("n") > rank), F.col("v")))

    rows = placed.groupBy("column").agg(at(0).alias("low"), at(1).alias("high")).collect()  # a row per column
    return {r["column"]: (r["low"], r["high"]) for r in rows}


def medians(df: DataFrame, columns: Iterable[str]) -> dict[str, float | None]:
    """Exact median of every column, nulls left out; None for a column without values.

    The rows are read twice for all columns together: once for fences around the
    medians, once to count the values between them.  What is sorted are these values
    alone, some thousandths of all, each once.  Fences that should miss a median are
    noticed by its rank, and that column is counted whole.
    """
    columns = list(columns)
    out = dict.fromkeys(columns)
    fences = _fences(df, columns) if columns else {}
    while fences:
        ranks = [((n - 1) // 2, n // 2) for n, _, _ in fences.values()]
        found = _at_ranks(_counts_between(df, fences), ranks)
        missed = {}
        for k, (c, (n, low, high)) in enumerate(fences.items()):
            middle = found.get(k, (None, None))
            if None in middle and (low, high) != (-math.inf, math.inf):
                missed[c] = (n, -math.inf, math.inf)
            elif None not in middle:
                out[c] = sum(middle) / 2
        fences = missed
    return out


def median(df: DataFrame, column: str) -> float | None:
    """Exact median of one column."""
    return medians(df, [column])[column]
