"""LM scoring by cross-entropy difference of two matched n-gram models.

The target model is counted over the documents of a given list of ids, the
background model over all documents.  Both are byte 5-gram models with the same
smoothing (order 5 backs off to order 3, order 3 to the uniform) and the same
vocabulary, the 256 byte values.  A document's score is the mean over its bytes
of background loss minus target loss: the higher, the more like the target.

Counts cover every text.  A block of documents sends each distinct n-gram once
with its two counts; a window over the n-gram adds the blocks up, and each
block gets back just its own n-grams' totals to score with.  No task and not the
driver holds a whole model, and a frequent n-gram has one row per block.

Defined results: a null text counts as empty; an empty text has no tokens,
losses 0 and score 0; rows without id are never part of the target; repeated rows count as
often as they occur; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termscope.llm.blocks import block_count, in_blocks, texts

VOCABULARY = 256
_SLICE = 1 << 21
#: (shift, bytes) that cut each counted n-gram out of a packed 5-gram: the 5-gram, its context, the trigram, its context
_PARTS = ((0, 5), (8, 4), (0, 3), (8, 2))


def packed(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """5-grams of all bytes of the documents, each packed into an integer, and where documents begin (with the end).

    Every document starts with a context of zero bytes.
    """
    sizes = np.array([len(d) for d in data], np.int64)
    chars = np.frombuffer(b"".join(b"\0\0\0\0" + d for d in data), np.uint8)
    grams = np.zeros(max(len(chars) - 4, 0), np.int64)
    for k in range(5):
        grams = grams << 8 | chars[k : k + len(grams)]
    at = np.concatenate([[0], np.cumsum(sizes)])
    inner = np.arange(at[-1]) + np.repeat(np.arange(len(data)) * 4, sizes)  # skips grams that end in a pad
    return grams[inner], at


def parts(grams: np.ndarray, k: int) -> np.ndarray:
    """Key of part k of packed 5-grams; keys of different parts differ."""
    shift, size = _PARTS[k]
    return (grams >> shift) & ((1 << 8 * size) - 1) | k << 48


def _slices(rows) -> list:
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[-1])
        if size >= _SLICE:
            yield some
            some, size = [], 0
    if some:
        yield some


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    rank = np.argsort(keys, kind="stable")
    keys = keys[rank]
    new = np.flatnonzero(np.r_[True, np.diff(keys) != 0]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], *(np.add.reduceat(c[rank], new) if len(new) else c for c in counts)


_COUNTS = pa.schema([("block", pa.int32()), ("gram", pa.int64()), ("background", pa.int64()), ("target", pa.int64())])
_SCORES = pa.schema([
    ("id", pa.int64()), ("n_tokens", pa.int64()), ("loss_target", pa.float64()), ("loss_background", pa.float64()),
    ("score", pa.float64())])


def _count(docs: pa.Table, targets: pa.Table) -> pa.Table:
    chosen = set(targets.column("target_id").to_pylist())
    found = []
    rows = ((i in chosen and i is not None, t.encode()) for i, t in zip(docs.column("id").to_pylist(), texts(docs), strict=True))
    for some in _slices(rows):
        for is_target in (False, True):
            keys, n = np.unique(packed([t for flag, t in some if flag == is_target])[0], return_counts=True)
            found.append((keys, n, n * is_target))
    if not found:
        return _COUNTS.empty_table()
    grams, n, m = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
    tables = [_summed(parts(grams, k), n, m) for k in range(len(_PARTS))]
    keys, n, m = (np.concatenate(x) for x in zip(*tables, strict=True))
    block = np.full(len(keys), docs.column("block")[0].as_py() if len(keys) else 0, np.int32)
    return pa.Table.from_arrays([pa.array(block), pa.array(keys), pa.array(n), pa.array(m)], schema=_COUNTS)


def losses(counts: list[np.ndarray], strength: float) -> np.ndarray:
    """-log p of 5-grams from the counts of 5-gram, its context, trigram and its context."""
    five, context, three, context_3 = counts
    p3 = (three + strength / VOCABULARY) / (context_3 + strength)
    return -np.log((five + strength * p3) / (context + strength))


def _score(strength: float):
    def run(docs: pa.Table, model: pa.Table) -> pa.Table:
        keys, background, target = (model.column(c).to_numpy() for c in ("gram", "background", "target"))
        rank = np.argsort(keys)
        keys, background, target = keys[rank], background[rank], target[rank]
        known = keys[: np.searchsorted(keys, 1 << 48)]  # the 5-grams
        at = [np.searchsorted(keys, parts(known, k)) for k in range(len(_PARTS))]
        loss_b = losses([background[a].astype(float) for a in at], strength)
        loss_t = losses([target[a].astype(float) for a in at], strength)
        out = []
        rows = ((i, t.encode()) for i, t in zip(docs.column("id").to_pylist(), texts(docs), strict=True))
        for some in _slices(rows):
            grams, ends = packed([t for _, t in some])
            place = np.searchsorted(known, grams)
            for (id_, _), a, b in zip(some, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                own = place[a:b]
                t, g = (float(x[own].mean()) if b > a else 0.0 for x in (loss_t, loss_b))
                out.append((id_, b - a, t, g, g - t))
        columns = zip(*out, strict=True) if out else [[]] * len(_SCORES)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCORES, strict=True)], schema=_SCORES)
    return run


def cross_entropy_difference(
    docs: DataFrame, targets: DataFrame, strength: float = 4.0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_tokens (bytes), loss_target, loss_background (nats a token), score."""
    n = block_count(docs, text_col)
    rows = in_blocks(docs, n, id_col, text_col)
    ids = targets.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    # The blocks that hold a target, found on narrow rows: an id may have rows in several.
    ids = rows.select("block", "id").distinct().join(ids, "id").select(F.col("block").alias("of_block"), F.col("id").alias("target_id"))
    counts = rows.groupBy("block").cogroup(ids.groupBy("of_block")).applyInArrow(
        _count, "block int, gram long, background long, target long")
    same = Window.partitionBy("gram")
    totals = counts.select(
        "block", "gram", F.sum("background").over(same).alias("background"), F.sum("target").over(same).alias("target"))
    return rows.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _score(strength), "id long, n_tokens long, loss_target double, loss_background double, score double",
    ).withColumnRenamed("id", id_col)
