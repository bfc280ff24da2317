"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets verify them.

* A document is the set of its runs of five words (64-bit hashes; lower case).
  Documents with the same set are copies and go on as one representative.
* ``banding`` picks rows and bands of the MinHash signature so that a pair at
  the threshold is found with the wanted recall.  Representatives are shuffled
  on band hashes; each shared bucket ties its members to one of them, and
  connected components of these ties hold all candidates.
* A component is cut into blocks by hash, bounded in documents and in n-grams.
  Every pair of blocks is one small group of rows: it counts the common
  n-grams of its documents exactly and returns a link count and a root per
  document, not the pairs.  A component with a third of all rows becomes many
  such groups on all executors; no pair of texts is left out.
* ``similar_pairs`` returns the linked pairs of representatives themselves.

Defined results: a text with fewer than five words has one n-gram, the whole;
a text without words, or null, links to nothing; rows that agree in id and text are
copies of each other; a null id is never the name of a class if the
class has another; long texts are read whole, and hot n-grams are not joined on; an empty table gives
no rows; extra columns are carried along by ``one_per_class``, whose helper columns take free names, and not read otherwise.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.columns import fresh
from termscope.llm.graph import components
from termscope.llm.words import WORD, hashes, mixed
from termscope.session import materialize

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Banding:
    bands: int
    rows: int


def banding(threshold: float = 0.8, recall: float = 0.999, max_hashes: int = 128) -> Banding:
    """Most rows per band, so fewest false candidates, that reach ``recall`` at ``threshold`` within ``max_hashes``."""
    best = Banding(max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows > max_hashes:
            break
        best = Banding(bands, rows)
    return best


def shingles(text: str, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words."""
    h = hashes(WORD.findall(text.lower()))
    if not len(h):
        return h
    n = min(width, len(h))
    runs = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        runs = (runs + h[k : len(h) - n + 1 + k]) * _ODD
        runs ^= runs >> np.uint64(32)
    return np.unique(mixed(runs))


def signature(grams: np.ndarray, shape: Banding, chunk: int = 4096) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature; bands never share a hash by position."""
    seeds = mixed(np.arange(1, 2 * shape.bands * shape.rows + 1, dtype=np.uint64) * _ODD)
    mul, add = (seeds[0::2] | np.uint64(1))[:, None], seeds[1::2][:, None]
    least = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(grams), chunk):
        least = np.minimum(least, (grams[k : k + chunk] * mul + add).min(axis=1))
    out = np.arange(shape.bands, dtype=np.uint64)
    for column in least.reshape(shape.bands, shape.rows).T:
        out = mixed((out + column) * _ODD)
    return out.view(np.int64)


def _sketched(docs: DataFrame, width: int, shape: Banding) -> DataFrame:
    """(id, th, key, n, bands) of (id, th, text); key is a 128-bit hash of the n-gram set, null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, bands = [], [], []
            for text in batch.column(2):
                grams = shingles(text.as_py(), width)
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                sizes.append(len(grams))
                bands.append(signature(grams, shape) if len(grams) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["id", "th", "key", "n", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, th long, key binary, n long, bands array<long>")


def _with_sets(rows: DataFrame, width: int) -> DataFrame:
    """Replace ``text`` (last column) by ``grams``, the packed n-gram set."""
    kept = rows.columns[:-1]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 256):  # sets are larger than texts
                some = batch.slice(part, 256)
                sets = pa.array([shingles(t.as_py(), width).tobytes() for t in some.column(len(kept))], pa.binary())
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], sets], names=[*kept, "grams"])

    return rows.mapInArrow(run, f"{schema}, grams binary")


def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None, columns: int = 4096) -> np.ndarray:
    """Numbers of common n-grams of all sets on the left with all on the right (with each other if None)."""
    sets = left + (right or [])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[inverse]
    use = shared[inverse]
    column, owner = column[use], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right) if right is not None else len(left)), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, total, columns):
        a, b = np.searchsorted(column, [start, start + columns])
        table = np.zeros((len(sets), min(columns, total - start)), np.float32)
        table[owner[a:b], column[a:b] - start] = 1
        out += table[: len(left)] @ (table[len(left) :] if right is not None else table).T
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least place reachable from each place of a symmetric table."""
    label = np.arange(len(linked))
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked)))
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _verify(threshold: float, pairs: bool):
    """Rows (key, root, links) or, for ``pairs``, (a, b, jaccard) of each group (comp, lo, hi)."""
    def group(lo: int, hi: int, rows: list[tuple[int, bytes, int, bytes]]) -> list[tuple]:
        rows = sorted({(block, key): (block, key, copies, np.frombuffer(grams, np.uint64))
                       for block, key, copies, grams in rows}.values(), key=lambda r: r[:2])
        left = [r for r in rows if r[0] == lo]
        right = None if lo == hi else [r for r in rows if r[0] == hi]
        if not left or right == []:
            return []
        count = common_counts([r[3] for r in left], None if right is None else [r[3] for r in right])
        other = left if right is None else right
        n, m = (np.array([len(r[3]) for r in side], np.float64) for side in (left, other))
        union = n[:, None] + m[None, :] - count
        linked = count >= threshold * union - 1e-9
        if right is None:
            np.fill_diagonal(linked, False)
        if pairs:
            hits = np.argwhere(np.triu(linked) if right is None else linked)
            return [(*sorted((left[i][1], other[j][1])), float(count[i, j] / union[i, j])) for i, j in hits.tolist()]
        weight, weight_m = (np.array([r[2] for r in side], np.int64) for side in (left, other))
        links = [(linked @ weight_m)] if right is None else [linked @ weight_m, linked.T @ weight]
        all_rows = left if right is None else left + right
        table = linked
        if right is not None:
            table = np.zeros((len(all_rows), len(all_rows)), bool)
            table[: len(left), len(left) :] = linked
            table[len(left) :, : len(left)] = linked.T
        root = _roots(table)
        return [(r[1], all_rows[root[k]][1], int(x)) for k, (r, x) in enumerate(zip(all_rows, np.concatenate(links), strict=True)) if x]

    names, kinds = (("a", "b", "jaccard"), (pa.binary(), pa.binary(), pa.float64())) if pairs else (
        ("key", "root", "links"), (pa.binary(), pa.binary(), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        current, rows, found = None, [], []
        for batch in batches:
            for comp, lo, hi, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (comp, lo, hi) != current:
                    if rows:
                        found += group(current[1], current[2], rows)
                    current, rows = (comp, lo, hi), []
                rows.append(tuple(row))
            if len(found) >= 10_000:
                yield emit(found)
                found = []
        if rows:
            found += group(current[1], current[2], rows)
        yield emit(found)

    return run, ", ".join(f"{n} {k}" for n, k in zip(names, ("binary", "binary", "double" if pairs else "long"), strict=True))


@dataclass(frozen=True)
class Join:
    """Tables of one join: all rows (id, th, key), representatives (key, copies, first), verified rows."""

    rows: DataFrame
    representatives: DataFrame
    verified: DataFrame


def jaccard_join(
    docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.999, id_col: str = "doc_id",
    text_col: str = "text", block_docs: int = 512, block_grams: int = 1 << 16, pairs: bool = False,
) -> Join:
    """Sketch, band, verify; ``verified`` has (key, root, links) rows, or (a, b, jaccard) for ``pairs``."""
    shape = banding(threshold, recall)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("th"), "text")
    rows = materialize(_sketched(texts, width, shape))
    first = F.min(F.struct(F.col("id").isNull().alias("null_id"), F.col("id"), F.col("th"))).alias("first")
    reps = materialize(rows.where("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), first, F.max("n").alias("n"), F.any_value("bands").alias("bands")))

    banded = reps.select("key", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("key").alias("least"), F.count("*").alias("members")).where("members > 1")
    ties = banded.join(buckets, "band").where("key != least").select(F.col("key").alias("a"), F.col("least").alias("b"))
    candidates = components(ties).join(reps.select(F.col("key").alias("node"), "copies", "first", "n"), "node")
    sizes = candidates.groupBy("component").agg(F.count("*").alias("d"), F.sum("n").alias("g"))
    blocks = F.greatest(F.ceil(F.col("d") / block_docs), F.ceil(F.col("g") / block_grams)).cast("int")
    members = candidates.join(sizes.select("component", blocks.alias("blocks")), "component").select(
        F.col("component").alias("comp"), F.col("node").alias("key"), "copies", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.col("first.id").alias("of_id"), F.col("first.th").alias("of_th"))
    of_member = texts["id"].eqNullSafe(members["of_id"]) & (texts["th"] == members["of_th"])
    sets = _with_sets(members.join(texts, of_member).select("comp", "key", "copies", "blocks", "block", "text"), width)
    met = sets.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    met = met.select("comp", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "key", "copies", "grams")
    dealt = met.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi")
    run, schema = _verify(threshold, pairs)
    return Join(rows, reps, materialize(dealt.mapInArrow(run, schema)))


def similar_pairs(docs: DataFrame, threshold: float = 0.8, **options) -> DataFrame:
    """(a, b, jaccard): linked representatives, named by the least id that has their n-gram set."""
    join = jaccard_join(docs, threshold, pairs=True, **options)
    ids = join.representatives.select("key", "first.id")
    a, b = ids.select(F.col("key").alias("a"), F.col("id").alias("id_a")), ids.select(F.col("key").alias("b"), F.col("id").alias("id_b"))
    return join.verified.join(a, "a").join(b, "b").select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "jaccard")


def near_classes(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, class_id (least id of the class), n_links, copies, class_size, kept, th.

    n_links counts the other documents at or over the threshold, copies
    included.  A class is a connected group of links.  Of each class the row with the
    least id is kept.
    """
    join = jaccard_join(docs, threshold, id_col=id_col, **options)
    links = join.verified.groupBy("key").agg(F.sum("links").alias("links"))
    classes = components(join.verified.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = join.representatives.select("key", "copies", "first").join(
        classes.select(F.col("node").alias("key"), "component"), "key", "left").join(links, "key", "left").select(
        "key", "copies", "first", F.coalesce("component", "key").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    named = materialize(named)
    tops = named.groupBy("component").agg(F.min("first").alias("top"), F.sum("copies").alias("class_size"))
    named = named.join(tops, "component").select("key", "copies", "links", "top", "class_size")
    return join.rows.select("id", "th", "key").join(named, "key", "left").select(
        F.col("id").alias(id_col), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("key").isNull() | (F.col("id").eqNullSafe(F.col("top.id")) & (F.col("th") == F.col("top.th")))).alias("kept"),
        "th")


def one_per_class(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, one of each class, with their own columns; rows that agree in id and text count as one."""
    th, kept_id, kept_th = (fresh(docs.columns, c) for c in ("_th", "_kept_id", "_kept_th"))
    found = near_classes(docs, threshold, id_col=id_col, text_col=text_col, **options).where("kept").select(
        F.col(id_col).alias(kept_id), F.col("th").alias(kept_th)).distinct()
    hashed = docs.withColumn(th, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(th) == F.col(kept_th))
    return hashed.join(found, same, "left_semi").dropDuplicates([id_col, th]).drop(th)
