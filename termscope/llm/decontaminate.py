"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

Every document is compared with every benchmark item that shares a seed, a run
of ``min_match`` equal words.  Tiling marks the longest unmarked match of a
pair first, then the next, until no match of ``min_match`` words is left; tiles
never overlap in the document or in the item, so passages whose parts are
reordered are still covered.  An item whose words are covered to ``threshold``
or more taints the document.

Items shorter than a seed are matched whole.  The seed index of the items is a
sorted table of Karp-Rabin hashes.  It travels to the tasks in blocks of
``block_words`` words: a benchmark within one block, the usual case, is read in one pass
over the documents, and a larger one in several passes, so that no task or broadcast
holds more than a block.  Documents never cross the network.

Defined results: a null text counts as empty and is clean, items without words
are never found, repeated items and documents are compared one by one; long texts are read
whole; empty tables give clean documents or no rows; extra columns are carried along, and
helper columns take free names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.columns import fresh
from termscope.llm.words import WORD, hashes

_BASE = np.uint64(0x100000001B3)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word, in order, lower case."""
    return hashes(WORD.findall(text.lower()))


def rolling(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` words, modulo 2**64."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - length + 1, np.uint64)
    for k in range(length):
        out = out * _BASE + words[k : len(words) - length + 1 + k]
    return out ^ (out >> np.uint64(32))


@dataclass
class Items:
    """A block of benchmark items and the index of their seeds."""

    ids: list[int]
    words: list[np.ndarray]
    seed: int

    def __post_init__(self) -> None:
        lengths = [min(self.seed, len(w)) for w in self.words]
        self.index = {}
        for n in sorted(set(lengths) - {0}):
            runs = [rolling(w, n) if m == n else np.zeros(0, np.uint64) for w, m in zip(self.words, lengths, strict=True)]
            hashes = np.concatenate(runs)
            item = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
            at = np.concatenate([np.arange(len(r)) for r in runs])
            order = np.argsort(hashes, kind="stable")
            self.index[n] = (hashes[order], item[order], at[order])

    def seeds(self, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in the document, place in the item) of all shared runs of ``n`` words."""
        hashes, item, at = self.index[n]
        runs = rolling(doc, n)
        a = np.searchsorted(hashes, runs)
        hit = np.flatnonzero(hashes[np.minimum(a, len(hashes) - 1)] == runs) if len(hashes) else a[:0]
        a, b = a[hit], np.searchsorted(hashes, runs[hit], "right")
        count = b - a
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
        return item[k], np.repeat(hit, count), at[k]


def tiles(doc: np.ndarray, item: np.ndarray, p: np.ndarray, q: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the document, place in the item, words) grown from the seeds at (p, q)."""
    line = np.lexsort((p, p - q))
    p, q = p[line], q[line]
    new = np.r_[True, (np.diff(p - q) != 0) | (np.diff(p) != 1)]
    start = np.flatnonzero(new)
    size = np.diff(np.r_[start, len(p)]) + seed - 1
    free_p, free_q = {}, np.ones(len(item), bool)
    matches = [(int(n), int(a), int(b)) for n, a, b in zip(size, p[start], q[start], strict=True)
               if (doc[a : a + n] == item[b : b + n]).all()]
    out = []
    while matches:
        longest = max(m[0] for m in matches)
        rest = []
        for n, a, b in sorted(matches, key=lambda m: m[1:]):
            if n < longest:
                rest.append((n, a, b))
                continue
            open_run = [free_q[b + k] and a + k not in free_p for k in range(n)]
            if all(open_run):
                out.append((a, b, n))
                free_q[b : b + n] = False
                free_p.update(dict.fromkeys(range(a, a + n)))
                continue
            k = 0  # what earlier tiles left of the match competes again at its own length
            while k < n:
                end = k
                while end < n and open_run[end]:
                    end += 1
                if end - k >= seed:
                    rest.append((end - k, a + k, b + k))
                k = max(end, k) + 1
        matches = rest
    return out


def covered(doc: np.ndarray, items: Items) -> list[tuple[int, int, int, int]]:
    """(item, words covered, tiles, first place in the document) of every item that shares a seed."""
    out = []
    for n in items.index:
        item, p, q = items.seeds(doc, n)
        order = np.argsort(item, kind="stable")
        item, p, q = item[order], p[order], q[order]
        cuts = np.flatnonzero(np.diff(item)) + 1
        for k, a, b in zip(item[np.r_[0, cuts]] if len(item) else [], np.split(p, cuts), np.split(q, cuts), strict=False):
            found = tiles(doc, items.words[k], a, b, n)
            if found:
                out.append((int(k), sum(t[2] for t in found), len(found), min(t[0] for t in found)))
    return out


_ITEM = "array<struct<item_id: long, covered: int, words: int, tiles: int, first_word: int>>"
_ARROW_ITEM = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("covered", pa.int32()), ("words", pa.int32()), ("tiles", pa.int32()), ("first_word", pa.int32())]))


def _pass(docs: DataFrame, items: Items, share: float, column: str) -> DataFrame:
    """Add ``column``: the items of one block that the last column, the text, covers to ``share`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most a block of words
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lists = []
            for text in batch.column(len(kept) - 1):
                doc = word_hashes(text.as_py())
                lists.append([
                    {"item_id": own.ids[k], "covered": n, "words": len(own.words[k]), "tiles": t, "first_word": first}
                    for k, n, t, first in covered(doc, own) if n >= share * len(own.words[k]) - 1e-9])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, _ARROW_ITEM)], names=[*kept, column])

    from pyspark.sql.types import StructType, _parse_datatype_string

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(column, _parse_datatype_string(_ITEM)))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, seed: int, block_words: int) -> Iterator[Items]:
    """The benchmark in blocks of at most ``block_words`` words (a longer item is a block of its own)."""
    ids, words, size = [], [], 0
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    for row in rows.toLocalIterator():
        item = word_hashes(row["t"])
        if ids and size + len(item) > block_words:
            yield Items(ids, words, seed)
            ids, words, size = [], [], 0
        ids.append(row["i"])
        words.append(item)
        size += len(item)
    if ids:
        yield Items(ids, words, seed)


def coverage(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, min_match: int = 5, block_words: int = 1 << 21,
    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    leaks_col: str = "leaks",
) -> DataFrame:
    """The documents with ``leaks_col``: items covered to ``threshold`` or more, with words covered, tiles and first place."""
    kept = [c for c in docs.columns if c != leaks_col]
    text = fresh(docs.columns, "_leak_text")
    own = [F.col(f"`{c}`") for c in kept]
    rows = docs.select(*own, F.coalesce(F.col(text_col), F.lit("")).alias(text))
    found = []
    for block in _blocks(benchmark, item_id_col, item_text_col, min_match, block_words):
        name = fresh([*docs.columns, text], f"_leaks_{len(found)}")
        # the text stays last for the next block
        rows = _pass(rows, block, threshold, name).select(*own, *found, name, text)
        found.append(name)
    leaks = reduce(F.concat, [F.col(c) for c in found]) if found else F.array().cast(_ITEM)
    return rows.select(*own, leaks.alias(leaks_col))


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns."""
    name = fresh(docs.columns, "leaks")
    return coverage(docs, benchmark, threshold, leaks_col=name, **options).where(F.size(name) == 0).drop(name)
