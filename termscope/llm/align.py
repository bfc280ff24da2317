"""Alignment of two tokenizers on the same bytes, with corpus-wide counts of the id pairs that meet.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece model that
writes blanks as U+2581 and adds one in front.  Both read a blank and the text, so
their tokens cover the same bytes.  Offsets where both end a token cut the tokens
into groups; each token of A is linked with each of B in its group.

Inverted pair bitmaps: documents are taken in blocks of bounded size, as the input
splits deal them, and every id pair of a block gets one row with

* ``docs``: the block's documents that hold the link, as 16-bit places or, where that is shorter, as a bitmap
* ``planes``: bit k of (links - 1) of each of these documents, one bitmap per k; nothing where all have one link

Bits found in several slices of a block are ORed.  Blocks share no documents, so a pair's
bitmap is that of its blocks one after another and its number of documents is the
sum of their popcounts, links the planes' weighted popcounts.  The totals meet the postings,
and each block adds its postings' counts up per document.

Tokens are found per run of blanks and non-blanks.  Neither tokenizer joins a non-blank
with a blank behind it (B's vocabulary is checked for that), so a run's tokens are those it
has in its text and a worker keeps what it knows of a run.  A text with a run that does not give
its own bytes back is encoded in one piece.

Defined results: texts that are null or empty, or whose joined token bytes differ from
blank + text (with U+2581, say), have no tokens: zeros and ''.  Special tokens' names in a
text are plain text.  Repeated rows and ids are documents of their own, null ids stay; an empty
table gives no rows; extra columns are not read.  A text is cut at runs, a run without blanks is not.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.session import scratch_dir

BLOCK_CHARS = 4 << 20
BLOCK_DOCS = 1 << 16
_BITS = 20  # of a token id in a packed key
_RUN = re.compile(r" +[^ ]+(?: +\Z)?| +")  # blanks at the end belong to the last run
_KEPT_RUNS, _KEPT_CHARS = 1 << 18, 8 << 20
_SLICE = 1 << 19
_JOINED = 128  # runs encoded as one text
_PIECE = 1 << 20
_WIDE = 1 << 16  # links of one group from which they are counted by distinct ids
_PAIRED = 1 << 21  # links expanded at a time
_loaded: dict[tuple[str, str], Aligner] = {}


def byte_characters() -> dict[str, int]:
    """The characters that stand for the 256 byte values in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and the alignment of the runs seen last."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        of = byte_characters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(of.__getitem__, token)) if all(c in of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _BITS:
            raise ValueError(f"vocabularies of more than {1 << _BITS} tokens do not fit a packed pair")
        self.by_runs = not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in s], np.int64) for s in (self.bytes_a, self.bytes_b))
        # How ids are written in groups: inside and at the end of A's part, inside and at the end of B's.
        self.names = [b"%d%s" % (k, mark) for size, marks in ((len(self.bytes_a), (b",", b"|")), (len(self.bytes_b), (b",", b";")))
                      for mark in marks for k in range(size)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.groups: list[bytes] = []
        self.numbers = np.zeros((0, 4), np.int64)  # per run: tokens of A, of B, groups, links
        self.pairs, self.links, self.at = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for texts that begin with a blank."""
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)

    def covers(self, text: str, a: list[int], b: list[int]) -> bool:
        data = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == data and b"".join(map(self.bytes_b.__getitem__, b)) == data

    def side_by_side(self, runs: list[str]):
        """Runs that both tokenizers give back, their tokens of A and of B in a row, and how many each run has.

        Runs are encoded many to a text, which costs less; one that ends in a blank would run into the next.
        """
        joined = [r for r in runs if r[-1] != " "]
        groups = [joined[k : k + _JOINED] for k in range(0, len(joined), _JOINED)] + [[r] for r in runs if r[-1] == " "]
        good, parts = [], []
        while groups:
            texts = ["".join(g) for g in groups]
            again = []
            for group, text, *ids in zip(groups, texts, *self.encoded(texts), strict=True):
                if self.covers(text, *ids):
                    ends = np.cumsum([len(r.encode()) for r in group])
                    ids = [np.array(x, np.int64) for x in ids]
                    places = [np.cumsum(size[x]) for size, x in zip((self.size_a, self.size_b), ids, strict=True)]
                    cuts = [np.minimum(np.searchsorted(p, ends), len(p) - 1) for p in places]
                    if all((p[c] == ends).all() for p, c in zip(places, cuts, strict=True)):
                        good += group
                        parts.append((*ids, *(np.diff(c, prepend=-1) for c in cuts)))
                        continue
                if len(group) > 1:
                    again += [[r] for r in group]
            groups = again
        return good, *(map(np.concatenate, zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 4)

    def aligned(self, a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray):
        """Groups as bytes per text, each with its mark; their four numbers; pairs, links and where each text's pairs begin.

        The texts' tokens stand one after another, so both end where a text ends.
        """
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        cut_a, cut_b = (np.r_[0, np.searchsorted(e, ends) + 1] for e in (ends_a, ends_b))
        n_a, n_b = np.diff(cut_a), np.diff(cut_b)
        until = np.searchsorted(cut_a, np.cumsum(count_a))  # groups up to each text's end
        since = np.r_[0, until[:-1]]
        text_of = np.repeat(np.arange(len(count_a)), until - since)
        links = np.zeros(len(count_a), np.int64)
        np.add.at(links, text_of, n_a * n_b)
        numbers = np.stack([count_a, count_b, until - since, links], axis=1).astype(np.int64)
        keys, counts = self._linked(a, b, cut_a, cut_b, n_a * n_b, text_of)
        return self._written(a, b, cut_a, cut_b, count_a + count_b), numbers, keys[1], counts, np.searchsorted(keys[0], np.arange(len(count_a) + 1))

    def _written(self, a, b, cut_a, cut_b, sizes) -> list[bytes]:
        """Every text's groups, ``a1,a2|b1;`` one after another."""
        name_a, name_b = a.copy(), b + 2 * len(self.bytes_a)
        name_a[cut_a[1:] - 1] += len(self.bytes_a)
        name_b[cut_b[1:] - 1] += len(self.bytes_b)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(cut_b[:-1], np.diff(cut_a))] = name_a
        order[np.arange(len(b)) + np.repeat(cut_a[1:], np.diff(cut_b))] = name_b
        written = list(map(self.names.__getitem__, order.tolist()))
        ends = np.cumsum(sizes).tolist()
        return [b"".join(written[x:y]) for x, y in zip([0, *ends], ends, strict=False)]

    @staticmethod
    def _linked(a, b, cut_a, cut_b, sizes, text_of):
        """Distinct (text, pair) in order, and the number of links of each."""
        found = []
        narrow = np.flatnonzero(sizes < _WIDE)
        steps = np.searchsorted(np.cumsum(sizes[narrow]), np.arange(0, sizes[narrow].sum() + 1, _PAIRED), side="right")
        for x, y in zip(steps, [*steps[1:], len(narrow)], strict=True):
            some = narrow[x:y]
            n, m = sizes[some], np.diff(cut_b)[some]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            left = a[np.repeat(cut_a[some], n) + inner // np.repeat(m, n)]
            right = b[np.repeat(cut_b[some], n) + inner % np.repeat(m, n)]
            found.append(_counted(np.repeat(text_of[some], n), left << _BITS | right, None))
        for k in np.flatnonzero(sizes >= _WIDE):  # repeated ids of a long group meet by their numbers
            left, n = np.unique(a[cut_a[k] : cut_a[k + 1]], return_counts=True)
            right, m = np.unique(b[cut_b[k] : cut_b[k + 1]], return_counts=True)
            pair = (left[:, None] << _BITS | right).ravel()
            found.append((np.full(len(pair), text_of[k]), pair, (n[:, None] * m).ravel()))
        if not found:
            return (np.zeros(0, np.int64), np.zeros(0, np.int64)), np.zeros(0, np.int64)
        text, pair, n = _counted(*(np.concatenate(c) for c in zip(*found, strict=True)))
        return (text, pair), n

    def learn(self, runs: list[str]) -> None:
        """Align runs not known yet; a run that does not give its bytes back is known as -1."""
        good, *ids = self.side_by_side(runs)
        self.known.update(dict.fromkeys(runs, -1))
        self.chars += sum(map(len, runs))
        if good:
            groups, numbers, pair, links, at = self.aligned(*ids)
            self.known.update(zip(good, range(len(self.groups), len(self.groups) + len(good)), strict=True))
            self.groups += groups
            self.numbers = np.concatenate([self.numbers, numbers])
            self.at = np.concatenate([self.at, at[1:] + len(self.pairs)])
            self.pairs, self.links = np.concatenate([self.pairs, pair]), np.concatenate([self.links, links])

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, ...]]:
        """Per text the four numbers and the groups' hash; (text, pair, links) of all texts."""
        if len(self.known) > _KEPT_RUNS or self.chars > _KEPT_CHARS:
            self.forget()
        numbers, hashes, found, used = np.zeros((len(texts), 4), np.int64), [""] * len(texts), [], []
        split = [[_RUN.findall(p) for p in _pieces(" " + t)] if t and self.by_runs else [] for t in texts]
        new = {r for pieces in split for runs in pieces for r in runs if r not in self.known}
        if new:
            self.learn(list(new))
        for k, (text, pieces) in enumerate(zip(texts, split, strict=True)):
            places = [np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs)) for runs in pieces]
            if not text:
                continue
            if not places or min(p.min() for p in places) < 0:
                found.append(self._whole(k, " " + text, numbers, hashes))
                continue
            digest = hashlib.sha256()
            for n, p in enumerate(places):
                written = b"".join(map(self.groups.__getitem__, p.tolist()))
                digest.update(written if n < len(places) - 1 else written[:-1])
                numbers[k] += self.numbers[p].sum(axis=0)
            hashes[k] = digest.hexdigest()
            used += [(np.full(len(p), k), p) for p in places]
        if used:
            text, run, n = _counted(*map(np.concatenate, zip(*used, strict=True)), None)
            size = self.at[run + 1] - self.at[run]
            at = np.repeat(self.at[run] - np.cumsum(size) + size, size) + np.arange(size.sum())
            found.append((np.repeat(text, size), self.pairs[at], self.links[at] * np.repeat(n, size)))
        found = [f for f in found if f is not None]
        merged = _counted(*(np.concatenate(c) for c in zip(*found, strict=True))) if found else (np.zeros(0, np.int64),) * 3
        return numbers, hashes, merged

    def _whole(self, k: int, text: str, numbers: np.ndarray, hashes: list[str]):
        ids_a, ids_b = self.encoded([text])
        if not self.covers(text, ids_a[0], ids_b[0]):
            return None
        a, b = (np.array(x[0], np.int64) for x in (ids_a, ids_b))
        groups, own, pair, links, _ = self.aligned(a, b, np.array([len(a)]), np.array([len(b)]))
        numbers[k], hashes[k] = own[0], hashlib.sha256(groups[0][:-1]).hexdigest()
        return np.full(len(pair), k), pair, links


def _pieces(text: str) -> Iterator[str]:
    """The text, cut before blanks that follow a non-blank."""
    start = 0
    while len(text) - start > 2 * _PIECE:
        cut = re.compile("(?<=[^ ]) +[^ ]").search(text, start + _PIECE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _counted(first: np.ndarray, second: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Distinct (first, second) in order, with the sums of ``n`` (1 each, if none); the two fit 63 bits."""
    if not len(first):
        return first, second, np.zeros(0, np.int64)
    bits = int(second.max()).bit_length()
    key = first << bits | second
    if n is None:
        key, total = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, total = key[new], np.add.reduceat(n[order], new)
    return key >> bits, key & (1 << bits) - 1, total


def packed_places(places: np.ndarray, starts: np.ndarray, width: int) -> pa.Array:
    """Each pair's ascending places as 16-bit numbers, or as a bitmap of ``width`` bytes where that is shorter."""
    n = np.diff(starts)
    short = 2 * n <= width
    ends = np.cumsum(np.where(short, 2 * n, width))
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[np.repeat(short, np.where(short, 2 * n, width))] = places[np.repeat(short, n)].astype("<u2").view(np.uint8)
    for k in np.flatnonzero(~short).tolist():
        bits = np.zeros(width * 8, bool)
        bits[places[starts[k] : starts[k + 1]]] = True
        data[ends[k] - width : ends[k]] = np.packbits(bits)
    return _binary(data, ends)


def packed_planes(links: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Each pair's planes of (links - 1); empty where all are 1."""
    more = links - 1
    some = np.maximum.reduceat(more, starts[:-1]) if len(starts) > 1 else np.zeros(0, np.int64)
    out = [b""] * (len(starts) - 1)
    for k in np.flatnonzero(some).tolist():
        own = more[starts[k] : starts[k + 1]]
        out[k] = b"".join(np.packbits(own >> p & 1).tobytes() for p in range(int(some[k]).bit_length()))
    return pa.array(out, pa.binary())


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    if len(data) > np.iinfo(np.int32).max:
        raise ValueError("a block's postings exceed 2 GB")
    offsets = np.r_[0, ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def places_of(docs: bytes, n: int) -> np.ndarray:
    if len(docs) == 2 * n:
        return np.frombuffer(docs, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(docs, np.uint8)))


def links_of(planes: bytes, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    width = -(-n // 8)
    for p in range(len(planes) // width):
        out += np.unpackbits(np.frombuffer(planes, np.uint8, width, p * width))[:n].astype(np.int64) << p
    return out


_ROWS = pa.schema([
    ("kind", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
    ("n_docs", pa.int64()), ("docs", pa.binary()), ("planes", pa.binary())])
_DDL = ("kind string, block long, place int, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "a int, b int, n_docs long, docs binary, planes binary")


def _table(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    full = [pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
            else columns.get(f.name, pa.nulls(n, f.type)) for f in _ROWS]
    return pa.RecordBatch.from_arrays(full, schema=_ROWS)


def _postings(path_a: str, path_b: str, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if (path_a, path_b) not in _loaded:
            _loaded[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _loaded[path_a, path_b]
        block = TaskContext.get().partitionId() << 32
        place, chars, found = 0, 0, []

        def closed() -> pa.RecordBatch:
            doc, pair, n = _counted_pairs(found)
            starts = np.r_[np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else [], len(pair)].astype(np.int64)
            own = pair[starts[:-1]]
            return _table(
                kind=["pair"] * len(own), block=np.full(len(own), block), a=own >> _BITS, b=own & (1 << _BITS) - 1,
                n_docs=np.diff(starts), n_links=np.add.reduceat(n, starts[:-1]) if len(own) else n,
                docs=packed_places(doc, starts, -(-place // 8)), planes=packed_planes(n, starts))

        for ids, some in _slices(batches):
            if place and (chars >= block_chars or place + len(some) > BLOCK_DOCS):
                yield closed()
                block, place, chars, found = block + 1, 0, 0, []
            numbers, hashes, (doc, pair, n) = aligner.documents(some)
            yield _table(
                kind=["doc"] * len(some), block=np.full(len(some), block), place=np.arange(place, place + len(some)), id=ids,
                n_a=numbers[:, 0], n_b=numbers[:, 1], n_groups=numbers[:, 2], n_links=numbers[:, 3], groups_sha256=hashes)
            found.append((doc + place, pair, n))
            place, chars = place + len(some), chars + sum(map(len, some))
        if place:
            yield closed()
    return run


def _counted_pairs(found: list) -> tuple[np.ndarray, ...]:
    """Slices' (document, pair, links), ORed into one list in order of pair and document."""
    doc, pair, n = (np.concatenate(c) for c in zip(*found, strict=True))
    pair, doc, n = _counted(pair, doc, n)
    return doc, pair, n


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, some, size = [], [], 0
    for batch in batches:
        for id_, text in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(id_.as_py())
            some.append(text.as_py())
            size += len(some[-1])
            if size >= _SLICE or len(some) == 1 << 12:
                yield ids, some
                ids, some, size = [], [], 0
    if some:
        yield ids, some


@dataclass(frozen=True)
class Index:
    """The written bitmaps: documents, postings per block and pair, totals per pair."""

    spark: SparkSession
    path: str

    def _kind(self, name: str) -> DataFrame:
        return self.spark.read.schema(_DDL).parquet(f"{self.path}/rows").where(F.col("kind") == name)

    def documents(self) -> DataFrame:
        """block, place, id, n_a, n_b, n_groups, n_links, groups_sha256"""
        return self._kind("doc").select("block", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def postings(self) -> DataFrame:
        """block, a, b, n_docs, n_links, docs, planes"""
        return self._kind("pair").select("block", "a", "b", "n_docs", "n_links", "docs", "planes")

    def pairs(self) -> DataFrame:
        """a, b, n_docs, n_links over the corpus, and whether no other pair of this a is in more documents"""
        return self.spark.read.schema("a int, b int, n_docs long, n_links long, best boolean").parquet(f"{self.path}/pairs")


def build(
    docs: DataFrame, path_a: str, path_b: str, path: str | None = None, block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id", text_col: str = "text",
) -> Index:
    """Encode and align all texts and write the bitmaps below ``path``."""
    spark = docs.sparkSession
    index = Index(spark, path or scratch_dir(spark))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows.mapInArrow(_postings(path_a, path_b, block_chars), _DDL).write.mode("overwrite").partitionBy("kind").parquet(f"{index.path}/rows")
    totals = index.postings().groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    top = totals.groupBy("a").agg(F.max("n_docs").alias("top"))
    totals.join(top, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("top")).alias("best")).write.mode(
        "overwrite").parquet(f"{index.path}/pairs")
    return index


_SCORES = pa.schema([
    ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _score(docs: pa.Table, postings: pa.Table) -> pa.Table:
    n = docs.num_rows
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    columns = (postings.column(c).to_pylist() for c in ("docs", "planes", "n_docs", "count", "best"))
    for held, planes, size, count, is_best in zip(*columns, strict=True):
        places = places_of(held, size)
        links = links_of(planes, size) if planes else 1
        total[places] += links * count
        if is_best:
            best[places] += links
    place = docs.column("place").to_numpy()
    more = {"n_best": best[place], "count_sum": total[place]}
    return pa.Table.from_arrays([pa.array(more[f.name]) if f.name in more else docs.column(f.name) for f in _SCORES], schema=_SCORES)


def scores(index: Index, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    counts = index.pairs().select("a", "b", F.col("n_docs").alias("count"), "best")
    postings = index.postings().join(counts, ["a", "b"]).select("block", "docs", "planes", "n_docs", "count", "best")
    return index.documents().groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(
        _score, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    ).withColumnRenamed("id", id_col)
