"""Ranked lexical search by MaxScore with pair bounds.

The index holds documents in blocks of bounded size, as the input splits deal them:
a posting list per block and term, a term's number of documents over the corpus, and,
for term pairs of a workload of queries, the pair's intersection list per block with its
joint maximum impact and its ``depth``-th best joint impact.

A block answers a query with terms in order of weight, paired from the light end:

* a pair adds at most the greater of its joint maximum and the two terms' own maxima,
  which is less than the sum of the two maxima that MaxScore adds without pairs
* a document is worth a look while the bounds left reach the threshold; then no new one
  is taken up, and those met so far are bounded one by one: the joint maximum counts only
  where the pair's intersection list holds the document
* the survivors' remaining terms are looked up, pair by pair, with the bounds checked in between

The threshold is a score that ``depth`` documents reach: the best of the pairs' depth-th
joint impacts, of what the block has found, and of what earlier blocks found.  Blocks are
searched in bands, each about 16 times the next: the first bands' results bound all
later ones, so that a query's rows stay few at any number of blocks.  Bounds only skip
work; results are exact.

A term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))), N documents with a term, df
of them with this one; with n of L terms in the document, m = 50 + (50 n N) div L, and its
score sums w (10^9 tf div (1000 tf + 20 m)) over the query's distinct terms.

Defined results: a null or empty text has no terms and is never found; queries without
known terms have no rows; equal scores rank by document id, nulls last; repeated rows are documents
of their own; query rows that agree in id are one query with the terms of all; empty tables give no
rows; long texts are read in pieces cut between terms; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termscope.llm.urls import lower_ascii
from termscope.session import materialize, scratch_dir

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_CHARS = 4 << 20
BLOCK_DOCS = 1 << 16
QUERIES = 2048  # of one block of queries
_BANDS = 8
_TERM, _GAP = re.compile(TERM), re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_PIECE = 1 << 20


class Numbers(dict):
    """Numbers of terms in order of appearance; a word in any case of A-Z has its term's number."""

    def __init__(self):
        super().__init__()
        self.terms: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        number = self[word] = self.terms.setdefault(word.translate(_LOWER), len(self.terms))
        return number

    def of(self, text: str) -> np.ndarray:
        words = [_TERM.findall(piece) for piece in pieces(text)]
        return np.concatenate([np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in words])


def pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > 2 * _PIECE:
        gap = _GAP.search(text, start + _PIECE)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:]


def _band(block: int) -> int:
    """0 for 15 of 16 blocks, 1 for 15 of 16 of the others, and so on."""
    mixed = (block * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 24
    return next(k for k in range(_BANDS + 1) if k == _BANDS or mixed >> 4 * k & 15)


_ROWS = pa.schema([
    ("kind", pa.string()), ("band", pa.int32()), ("block", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("n_terms", pa.int64()),
    ("term", pa.string()), ("df", pa.int64()), ("docs", pa.binary()), ("tfs", pa.binary())])
_DDL = ("kind string, band int, block long, place int, id long, n_terms long, term string, df long, docs binary, tfs binary")


def _batch(n: int, **columns) -> pa.RecordBatch:
    full = [columns[f.name] if isinstance(columns.get(f.name), pa.Array)
            else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ROWS]
    return pa.RecordBatch.from_arrays(full, schema=_ROWS)


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Stretches of an array as binaries."""
    if values.nbytes > np.iinfo(np.int32).max:
        raise ValueError("a block's postings exceed 2 GB")
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _postings(block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, chars, ids, found, numbers = TaskContext.get().partitionId() << 32, 0, [], [], Numbers()

        def closed() -> Iterator[pa.RecordBatch]:
            band = _band(block)
            sizes = np.array([len(f) for f in found], np.int64)
            yield _batch(len(ids), kind=["doc"] * len(ids), band=[band] * len(ids), block=[block] * len(ids),
                         place=np.arange(len(ids)), id=ids, n_terms=sizes)
            keys, tfs = np.unique(
                np.concatenate(found) * BLOCK_DOCS + np.repeat(np.arange(len(ids)), sizes), return_counts=True)
            term = keys // BLOCK_DOCS
            starts = np.r_[np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else [], len(term)].astype(np.int64)
            n = len(starts) - 1  # every number has a term, so terms stand in order of number
            yield _batch(n, kind=["term"] * n, band=[band] * n, block=[block] * n, term=list(numbers.terms),
                         df=np.diff(starts), docs=_lists((keys % BLOCK_DOCS).astype("<u2"), starts), tfs=_lists(tfs.astype("<u4"), starts))

        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if ids and (chars + len(text) > block_chars or len(ids) == BLOCK_DOCS):
                    yield from closed()
                    block, chars, ids, found, numbers = block + 1, 0, [], [], Numbers()
                ids.append(id_.as_py())
                found.append(numbers.of(text))
                chars += len(text)
        if ids:
            yield from closed()
    return run


@dataclass(frozen=True)
class Index:
    """Written tables of a corpus; ``depth`` is the most hits a query can ask for."""

    spark: SparkSession
    path: str
    depth: int
    n_docs: int = field(default=0)
    n_terms: int = field(default=0)

    def _rows(self, kind: str) -> DataFrame:
        return self.spark.read.schema(_DDL).parquet(f"{self.path}/rows").where(F.col("kind") == kind)

    def documents(self) -> DataFrame:
        """band, block, place, id, n_terms"""
        return self._rows("doc").select("band", "block", "place", "id", "n_terms")

    def postings(self) -> DataFrame:
        """band, block, term, df (in the block), docs (16-bit places), tfs (32-bit)"""
        return self._rows("term").select("band", "block", "term", "df", "docs", "tfs")

    def terms(self) -> DataFrame:
        """term, df, weight"""
        weight = F.floor(1000 * F.log((2.0 * self.n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
        return self.spark.read.schema("term string, df long").parquet(f"{self.path}/terms").withColumn("weight", weight)


def build(
    docs: DataFrame, depth: int = 50, path: str | None = None, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text",
) -> Index:
    """Index all rows of ``docs`` below ``path``."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows.mapInArrow(_postings(block_chars), _DDL).write.mode("overwrite").partitionBy("kind", "band").parquet(f"{path}/rows")
    index = Index(spark, path, depth)
    index.postings().groupBy("term").agg(F.sum("df").alias("df")).write.mode("overwrite").parquet(f"{path}/terms")
    n_docs, n_terms = index.documents().where("n_terms > 0").agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    return Index(spark, path, depth, n_docs, n_terms)


def query_terms(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(part, item, term, weight): the known terms of every query, queries dealt into parts of about ``QUERIES``."""
    words = F.array_distinct(F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(TERM), F.lit(0)))
    asked = items.select(F.col(id_col).cast("long").alias("item"), F.explode(words).alias("term")).distinct()
    asked = materialize(asked.join(index.terms().drop("df"), "term"))
    n = asked.select("item").distinct().count()
    part = F.pmod(F.xxhash64("item"), F.lit(max(1, math.ceil(n / QUERIES)))).cast("int")
    return asked.select(part.alias("part"), "item", "term", "weight")


def workload_pairs(asked: DataFrame) -> DataFrame:
    """(part, a, b): every query's terms in pairs, lightest first."""
    order = Window.partitionBy("part", "item").orderBy("weight", "term")
    place = F.row_number().over(order) - 1
    numbered = asked.select("part", "item", "term", place.alias("place"))
    pair = numbered.groupBy("part", "item", F.floor(F.col("place") / 2).alias("pair")).agg(
        F.min_by("term", "place").alias("a"), F.max_by("term", "place").alias("b"))
    return pair.where("a != b").select("part", "a", "b").distinct()


def impacts(tfs: np.ndarray, lengths: np.ndarray, weight: int) -> np.ndarray:
    return weight * (1_000_000_000 * tfs // (1000 * tfs + 20 * lengths))


class Block:
    """Posting lists of one block for the terms of some queries, as (places, impacts)."""

    def __init__(self, docs: pa.Table, rows: list[dict], n_docs: int, n_terms: int):
        place = docs.column("place").to_numpy()
        self.ids = np.empty(len(place), object)
        self.ids[place] = docs.column("id").to_pylist()
        n = np.empty(len(place), np.int64)
        n[place] = docs.column("n_terms").to_numpy()
        m = 50 + 50 * n * n_docs // n_terms
        self.lists, self.weights = {}, {}
        for row in rows:
            places = np.frombuffer(row["docs"], "<u2").astype(np.int64)
            tfs = np.frombuffer(row["tfs"], "<u4").astype(np.int64)
            self.lists[row["term"]] = places, impacts(tfs, m[places], row["weight"])
            self.weights[row["term"]] = row["weight"]

    def pair(self, a: str, b: str, depth: int) -> tuple[np.ndarray, int, int]:
        """Intersection of two terms, the joint maximum and the depth-th best joint impact (0 if there are fewer)."""
        (x, left), (y, right) = self.lists[a], self.lists[b]
        both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        joint = left[i] + right[j]
        kth = int(np.partition(joint, len(joint) - depth)[len(joint) - depth]) if len(joint) >= depth else 0
        return both, int(joint.max(initial=0)), kth


@dataclass
class Unit:
    """A term or a pair of terms, with the most it adds to a score."""

    lists: list[tuple[np.ndarray, np.ndarray]]
    bound: int  # for any document
    apart: int  # for a document that holds at most one of the terms
    both: np.ndarray | None = None


def units(block: Block, terms: list[str], pairs: dict) -> tuple[list[Unit], int]:
    """The query's units, heaviest first, and a score that enough documents are known to reach."""
    terms = sorted(terms, key=lambda t: (block.weights[t], t))
    out, floor = [], 0
    k = 0
    while k < len(terms):
        known = pairs.get((terms[k], terms[k + 1])) if k + 1 < len(terms) else None
        some = [block.lists[t] for t in terms[k : k + (2 if known else 1)]]
        apart = max(int(i.max(initial=0)) for _, i in some)
        both, joint, kth = known or (None, 0, 0)
        floor = max(floor, kth)
        out.append(Unit(some, max(joint, apart), apart, both))
        k += len(some)
    return out[::-1], floor


def _kth(scores: np.ndarray, depth: int) -> int:
    return int(np.partition(scores, len(scores) - depth)[len(scores) - depth]) if len(scores) >= depth else 0


def hits(block: Block, terms: list[str], pairs: dict, depth: int, threshold: int = 0) -> tuple[list[int], list[int], int]:
    """Places and scores of the block's best documents, and how many of them were scored in full.

    All of the best ``depth`` that reach ``threshold`` are among them.
    """
    order, floor = units(block, terms, pairs)
    threshold = max(threshold, floor, 1)
    rest = np.r_[np.cumsum([u.bound for u in order][::-1])[::-1], 0].astype(np.int64)
    score = np.zeros(len(block.ids), np.int64)
    k = 0
    while k < len(order) and rest[k] >= threshold:
        for places, values in order[k].lists:
            score[places] += values
        threshold = max(threshold, _kth(score, depth))
        k += 1
    some = np.flatnonzero((score > 0) & (score + rest[k] >= threshold))
    own = score[some]
    left = np.zeros(len(some), np.int64)
    held = np.zeros(len(block.ids), bool)
    for unit in order[k:]:  # the joint maximum only where a document holds both terms
        if unit.both is None or unit.bound == unit.apart:
            left += unit.bound
        else:
            held[:] = False
            held[unit.both] = True
            left += np.where(held[some], unit.bound, unit.apart)
    keep = own + left >= threshold
    some, own = some[keep], own[keep]
    for j in range(k, len(order)):
        for places, values in order[j].lists:
            at = np.minimum(np.searchsorted(places, some), len(places) - 1)
            own = own + np.where(places[at] == some, values[at], 0)
        threshold = max(threshold, _kth(own, depth))
        keep = own + rest[j + 1] >= threshold
        some, own = some[keep], own[keep]
    ranked = sorted(zip(some.tolist(), own.tolist(), strict=True), key=lambda x: (-x[1], block.ids[x[0]] is None, block.ids[x[0]]))
    places, scores = zip(*ranked[:depth], strict=True) if ranked else ((), ())
    return list(places), list(scores), len(some)


def _grouped(index: Index, asked: DataFrame, parts: int, bands: Column):
    """Documents and asked postings by (block, part); every part of the queries asks every block."""
    docs = index.documents().where(bands).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    postings = index.postings().where(bands).drop("band", "df").join(asked, "term")
    return docs.select("block", "part", "place", "id", "n_terms").groupBy("block", "part"), postings


_PAIRS = pa.schema([
    ("block", pa.int64()), ("band", pa.int32()), ("a", pa.string()), ("b", pa.string()), ("joint", pa.int64()), ("kth", pa.int64()),
    ("docs", pa.binary())])
_PAIRS_DDL = "block long, band int, a string, b string, joint long, kth long, docs binary"


def precompute_pairs(index: Index, asked: DataFrame, pairs: DataFrame, parts: int, path: str) -> DataFrame:
    """Write the intersection lists of ``pairs`` in all blocks: block, band, a, b, joint maximum, depth-th joint impact, docs."""
    n_docs, n_terms, depth = index.n_docs, index.n_terms, index.depth

    def run(docs: pa.Table, postings: pa.Table) -> pa.Table:
        rows = postings.to_pylist()
        block = Block(docs, rows, n_docs, n_terms)
        out = []
        for row in rows:
            for b in row["partners"]:
                if b in block.lists:
                    both, joint, kth = block.pair(row["term"], b, depth)
                    if len(both):
                        number = row["block"]
                        out.append((number, _band(number), row["term"], b, joint, kth, both.astype("<u2").tobytes()))
        columns = zip(*out, strict=True) if out else [[]] * len(_PAIRS)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAIRS, strict=True)], schema=_PAIRS)

    partners = pairs.groupBy("part", F.col("a").alias("term")).agg(F.collect_list("b").alias("partners"))
    seconds = pairs.select("part", F.col("b").alias("term")).distinct()
    needed = asked.select("part", "term", "weight").distinct().join(
        partners.join(seconds, ["part", "term"], "full_outer"), ["part", "term"])
    needed = needed.withColumn("partners", F.coalesce("partners", F.array().cast("array<string>")))
    docs, postings = _grouped(index, needed, parts, F.lit(True))
    postings = postings.select("block", "part", "term", "weight", "docs", "tfs", "partners")
    found = docs.cogroup(postings.groupBy("block", "part")).applyInArrow(run, _PAIRS_DDL)
    found.write.mode("overwrite").partitionBy("band").parquet(path)
    return index.spark.read.schema(_PAIRS_DDL).parquet(path)


_HITS = pa.schema([("item", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])


def _search(index: Index):
    n_docs, n_terms, depth = index.n_docs, index.n_terms, index.depth

    def run(docs: pa.Table, postings: pa.Table) -> pa.Table:
        rows = postings.to_pylist()
        block = Block(docs, [r for r in rows if r["b"] is None], n_docs, n_terms)
        pairs = {(r["term"], r["b"]): (np.frombuffer(r["docs"], "<u2").astype(np.int64), r["joint"], r["kth"])
                 for r in rows if r["b"] is not None}
        asked, threshold = {}, {}
        for r in rows:
            for item in r["items"] or ():
                asked.setdefault(item["item"], []).append(r["term"])
                threshold[item["item"]] = item["threshold"] or 0
        out = []
        for item, terms in asked.items():
            places, scores, _ = hits(block, terms, pairs, depth, threshold[item])
            out += [(item, block.ids[p], s) for p, s in zip(places, scores, strict=True)]
        columns = zip(*out, strict=True) if out else [[]] * len(_HITS)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HITS, strict=True)], schema=_HITS)
    return run


def _best(found: DataFrame, depth: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """The ``index.depth`` best documents of every query: item_id, rank (from 1), doc_id, score."""
    asked = materialize(query_terms(index, items, id_col, text_col))
    parts = (asked.agg(F.max("part")).first()[0] or 0) + 1
    wanted = materialize(workload_pairs(asked))
    pairs = precompute_pairs(index, asked, wanted, parts, scratch_dir(index.spark))
    found = index.spark.createDataFrame([], "item long, doc long, score long, rank int")
    # At most nine values, each met by some block.
    for (band,) in index.documents().select("band").distinct().orderBy(F.desc("band")).collect():
        reached = found.groupBy("item").agg(F.when(F.count("*") == index.depth, F.min("score")).alias("threshold"))
        known = asked.join(reached.withColumnRenamed("item", "known"), F.col("item").eqNullSafe(F.col("known")), "left")
        by_term = known.groupBy("part", "term", "weight").agg(F.collect_list(F.struct("item", "threshold")).alias("items"))
        docs, postings = _grouped(index, by_term, parts, F.col("band") == band)
        lists = pairs.where(F.col("band") == band).join(wanted, ["a", "b"]).select(
            "block", "part", F.col("a").alias("term"), "docs", "b", "joint", "kth")
        both = postings.unionByName(lists, allowMissingColumns=True).select(
            "block", "part", "term", "weight", "docs", "tfs", "items", "b", "joint", "kth")
        new = docs.cogroup(both.groupBy("block", "part")).applyInArrow(_search(index), "item long, doc long, score long")
        found = materialize(_best(found.drop("rank").unionByName(new), index.depth))
    return found.select(F.col("item").alias(id_col), "rank", F.col("doc").alias(doc_col), "score")
