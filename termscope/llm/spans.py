"""Substring dedup: runs of consecutive sentences that occur before, in any document, are removed.

A sentence ends behind ``.``, ``!`` or ``?`` and a blank, at a line break, or with its
``longest``-th word, so that unpunctuated text has sentences as well.  A run has at
least ``min_sentences`` sentences and ``min_words`` words.  The shortest
runs from every sentence on and up to every sentence are hashed (96 bits over their
words).  They stand for all runs that repeat in the same sentences: with a run its
parts occur before, too, and each of its sentences is in the shortest run from there
on or, if that ends behind the run, in the shortest run up to the run's last sentence.
Equal words in other sentences are found where the hashed runs agree.  The first
occurrence of a run is the one in the document with the least id, and in it the
earliest.  A sentence is removed when any run over it is not a first occurrence.

A block of documents asks once for each distinct run it holds, so a run that a
third of all documents share has one row per block.  A window over the run gives
its count and first document, and only runs that are not unique go back to their blocks.

Defined results: a null text counts as empty and stays empty; rows that agree
in id count as one document and are not cut because of each other; rows
without id come after all others and keep what is first in them; words compare in lower case, and sentences without words are
never removed; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termscope.llm.blocks import block_count, in_blocks, texts
from termscope.llm.words import WORD, mixed

_CUT = re.compile(r"(?<=[.!?])\s+|\n+")
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LETTERS = 0xD6E8FEB86659FD95
_LAST = (1 << 63) - 1  # order of rows without id
_CHUNK = 1 << 18  # characters read at once
_LONG = 64  # letters from which a word is hashed by itself
_IRREGULAR = ("\u0130", "\u03a3")  # what they are in lower case has another length or depends on what stands beside them
_WORD, _BLANK, _LINE, _STOP = 1, 2, 4, 8


@dataclass(frozen=True)
class Settings:
    min_sentences: int = 2
    min_words: int = 25
    longest: int = 40  # words of a sentence


def _punctuated(text: str) -> list[str]:
    cuts = [0, *(m.end() for m in _CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _cut_long(piece: str, longest: int) -> list[str]:
    starts = [m.start() for m in WORD.finditer(piece)][longest::longest]
    return [piece[x:y] for x, y in zip([0, *starts], [*starts, len(piece)], strict=True)]


def sentences(text: str, longest: int = Settings.longest) -> list[str]:
    """The text in pieces: each sentence with the blanks behind it."""
    return [x for piece in _punctuated(text) for x in _cut_long(piece, longest)]


def _powers(base: int, n: int) -> np.ndarray:
    return _few_powers(base)[:n] if n <= _CHUNK + 1 else _all_powers(base, n)


def _all_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _few_powers(base: int) -> np.ndarray:
    return _all_powers(base, _CHUNK + 1)


def _range_hash(values: np.ndarray, a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[a:b] for all pairs, by differences of a running polynomial."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)), dtype=np.uint64)])
    back = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mixed((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64))


@cache
def _kinds() -> np.ndarray:
    """What each character is to the patterns ``\\w`` and ``\\s``, a line break or the end of a sentence."""
    chars = [chr(i) for i in range(0x110000)]
    out = np.fromiter((_WORD * c.isalnum() + _BLANK * c.isspace() for c in chars), np.uint8, len(chars))
    for c, kind in (("_", _WORD), ("\n", _LINE), (".", _STOP), ("!", _STOP), ("?", _STOP)):
        out[ord(c)] |= kind
    return out


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _word_hashes(text: str, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = _range_hash(codes.astype(np.uint64), starts, ends, _LETTERS)
    for k in np.flatnonzero(ends - starts > _LONG):
        out[k] = xxhash.xxh64_intdigest(text[starts[k] : ends[k]])
    return out


@dataclass(frozen=True)
class Sentences:
    """Of several texts: each text's number of sentences; each sentence's start in its text and number of words; hashes of all words."""

    count: np.ndarray
    start: np.ndarray
    words: np.ndarray
    hashes: np.ndarray


def _read(chunk: list[str], longest: int) -> Sentences:
    """The sentences of texts without ``_IRREGULAR`` characters, all at once."""
    text = "\0".join(chunk).lower()
    codes = _letters(text)
    kind = _kinds()[codes]
    size = np.fromiter(map(len, chunk), np.int64, len(chunk))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    word, word_end = _stretches(kind & _WORD > 0)
    blank, blank_end = _stretches(kind & _BLANK > 0)
    line, line_end = _stretches(kind & _LINE > 0)
    stopped = (kind[blank - 1] & _STOP > 0) & (blank > 0)
    loose = ~stopped[np.searchsorted(blank, line, "right") - 1]
    cut = np.unique(np.concatenate([begin, blank_end[stopped], line_end[loose]]))
    cut = cut[cut < end[np.searchsorted(begin, cut, "right") - 1]]
    piece = np.searchsorted(cut, word, "right") - 1
    place = np.arange(len(word)) - np.searchsorted(piece, piece)
    cut = np.sort(np.concatenate([cut, word[(place > 0) & (place % longest == 0)]]))
    owner = np.searchsorted(begin, cut, "right") - 1
    words = np.diff(np.searchsorted(word, np.append(cut, len(codes))))
    return Sentences(np.bincount(owner, minlength=len(chunk)), cut - begin[owner], words, _word_hashes(text, codes, word, word_end))


def _read_slowly(text: str, longest: int) -> Sentences:
    """The same of any one text, word by word."""
    pieces, worded = [], []  # as ``sentences`` has them
    for piece in _punctuated(text):
        words = WORD.findall(piece.lower())  # never fewer than the piece itself has
        parts = _cut_long(piece, longest) if len(words) > longest else [piece]
        pieces += parts
        worded += [words] if len(parts) == 1 else [WORD.findall(p.lower()) for p in parts]
    words = [w for ws in worded for w in ws]
    hashes = np.empty(len(words), np.uint64)
    step = _CHUNK // (_LONG + 1)
    for k in range(0, len(words), step):
        some = " ".join(w if len(w) <= _LONG else "_" for w in words[k : k + step])
        codes = _letters(some)
        hashes[k : k + step] = _word_hashes(some, codes, *_stretches(_kinds()[codes] & _WORD > 0))
    for k, w in enumerate(words):
        if len(w) > _LONG:
            hashes[k] = xxhash.xxh64_intdigest(w)
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    sizes = np.fromiter(map(len, worded), np.int64, len(worded))
    return Sentences(np.array([len(pieces)]), np.append(0, ends[:-1])[: len(pieces)], sizes, hashes)


@dataclass(frozen=True)
class Runs:
    """Runs over sentences with words: the text each is in, its first and end sentence (counted over all texts) and hashes."""

    owner: np.ndarray
    first: np.ndarray
    end: np.ndarray
    high: np.ndarray
    low: np.ndarray


def runs(found: Sentences, settings: Settings) -> Runs:
    at = np.flatnonzero(found.words)  # sentences with words
    owner = np.repeat(np.arange(len(found.count)), found.count)[at]
    ends = np.cumsum(found.words[at])
    starts = ends - found.words[at]
    k = np.arange(len(at))
    last = np.maximum(np.searchsorted(ends, starts + settings.min_words), k + settings.min_sentences - 1)
    begin = np.minimum(np.searchsorted(starts, ends - settings.min_words, "right") - 1, k - settings.min_sentences + 1)
    on, up = last < np.searchsorted(owner, owner, "right"), begin >= np.searchsorted(owner, owner)
    both = np.unique(np.concatenate([k[on] * len(at) + last[on], begin[up] * len(at) + k[up]]))  # by first, then last sentence
    k, last = np.divmod(both, max(len(at), 1))
    high = _range_hash(found.hashes, starts[k], ends[last], _BASES[0]).view(np.int64)
    low = (_range_hash(mixed(found.hashes), starts[k], ends[last], _BASES[1]) >> np.uint64(33)).astype(np.int32)
    return Runs(owner[k], at[k], at[last] + 1, high, low)


def _alone(text: str) -> bool:
    return len(text) >= _CHUNK or any(c in text for c in _IRREGULAR)


def _chunks(table: pa.Table) -> Iterator[tuple[int, list[str]]]:
    """The texts in order, as many as ``_CHUNK`` characters hold, with the row of the first; one that cannot be read among others is alone."""
    some, size, n = [], 0, 0
    for text in texts(table):
        alone = _alone(text)
        if some and (alone or size + len(text) + 1 > _CHUNK):
            yield n - len(some), some
            some, size = [], 0
        if alone:
            yield n, [text]
        else:
            some.append(text)
            size += len(text) + 1
        n += 1
    if some:
        yield n - len(some), some


def sentences_of(chunk: list[str], longest: int) -> Sentences:
    return _read_slowly(chunk[0], longest) if _alone(chunk[0]) else _read(chunk, longest)


_ASKED = pa.schema([("block", pa.int32()), ("high", pa.int64()), ("low", pa.int32()), ("n", pa.int32()), ("first", pa.int64())])
_CLEAN = pa.schema([
    ("id", pa.int64()), ("n_sentences", pa.int32()), ("removed", pa.list_(pa.int32())), ("n_words", pa.int64()),
    ("n_words_removed", pa.int64()), ("text", pa.string())])


def _orders(table: pa.Table) -> np.ndarray:
    return table.column("id").fill_null(_LAST).to_numpy()


def _ask(settings: Settings):
    def run(table: pa.Table) -> pa.Table:
        orders = _orders(table)
        found = []
        for row, chunk in _chunks(table):
            r = runs(sentences_of(chunk, settings.longest), settings)
            if len(r.high):
                found.append((r.high, r.low, orders[row + r.owner]))
        if not found:
            return _ASKED.empty_table()
        high, low, order = map(np.concatenate, zip(*found, strict=True))
        rank = np.lexsort((order, low, high))
        high, low, order = high[rank], low[rank], order[rank]
        new = np.flatnonzero(np.r_[True, (np.diff(high) != 0) | (np.diff(low) != 0)])
        count = np.diff(np.r_[new, len(high)])
        block = np.full(len(new), table.column("block")[0].as_py(), np.int32)
        return pa.Table.from_arrays(
            [pa.array(block), pa.array(high[new]), pa.array(low[new]), pa.array(count.astype(np.int32)), pa.array(order[new])],
            schema=_ASKED)
    return run


def _place(high: np.ndarray, low: np.ndarray, r: Runs) -> np.ndarray:
    """Place of each run in the sorted answer, -1 if it is not in it."""
    if not len(high):
        return np.full(len(r.high), -1)
    a, b = np.searchsorted(high, r.high), np.searchsorted(high, r.high, "right")
    at = np.minimum(a, len(high) - 1)
    out = np.where((b > a) & (low[at] == r.low), at, -1)
    for k in np.flatnonzero((b - a > 1) & (out < 0)):  # the first 64 bits are shared by another run
        more = a[k] + np.flatnonzero(low[a[k] : b[k]] == r.low[k])
        out[k] = more[0] if len(more) else -1
    return out


def removed(found: Sentences, r: Runs, place: np.ndarray, first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each sentence goes, given the answer's first documents and the order of each text."""
    known = np.flatnonzero(place >= 0)
    own, owner, seen = place[known], r.owner[known], np.zeros(len(known), bool)
    seen[np.unique(owner * len(first) + own, return_index=True)[1]] = True  # earliest in its document
    again = known[~(seen & (first[own] == order[owner]))]
    edge = np.zeros(len(found.words) + 1, np.int64)
    np.add.at(edge, r.first[again], 1)
    np.add.at(edge, r.end[again], -1)
    return (np.cumsum(edge)[:-1] > 0) & (found.words > 0)


def _kept(text: str, start: np.ndarray, gone: np.ndarray) -> str:
    borders = [*start.tolist(), len(text)]
    return "".join(text[borders[k] : borders[k + 1]] for k in np.flatnonzero(~gone))


def _clean(settings: Settings):
    def run(docs: pa.Table, answer: pa.Table) -> pa.Table:
        high, low, first = (answer.column(c).to_numpy() for c in ("high", "low", "first"))
        rank = np.lexsort((low, high))
        high, low, first = high[rank], low[rank], first[rank]
        ids, orders, out = docs.column("id").to_pylist(), _orders(docs), []
        for row, chunk in _chunks(docs):
            found = sentences_of(chunk, settings.longest)
            r = runs(found, settings)
            gone = removed(found, r, _place(high, low, r), first, orders[row : row + len(chunk)])
            border = np.append(0, np.cumsum(found.count))
            n_words, n_gone = (np.diff(np.append(0, np.cumsum(x))[border]).tolist() for x in (found.words, found.words * gone))
            for k, text in enumerate(chunk):
                part = slice(border[k], border[k + 1])
                cut = np.flatnonzero(gone[part]).tolist() if n_gone[k] else []
                kept = _kept(text, found.start[part], gone[part]) if cut else text
                out.append((ids[row + k], int(found.count[k]), cut, n_words[k], n_gone[k], kept))
        columns = zip(*out, strict=True) if out else [[]] * len(_CLEAN)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CLEAN, strict=True)], schema=_CLEAN)
    return run


def without_repeats(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_sentences, removed (their places), n_words, n_words_removed, text (what is kept)."""
    rows = in_blocks(docs, block_count(docs, text_col), id_col, text_col)
    asked = rows.groupBy("block").applyInArrow(_ask(settings), "block int, high long, low int, n int, first long")
    same = Window.partitionBy("high", "low")
    answer = asked.withColumn("total", F.sum("n").over(same)).withColumn("least", F.min("first").over(same))
    # A block whose only occurrence is the first of all has nothing to remove.
    answer = answer.where("total > 1 and not (n = 1 and first = least)").select(
        "block", "high", "low", F.col("least").alias("first"))
    cleaned = rows.groupBy("block").cogroup(answer.groupBy("block")).applyInArrow(
        _clean(settings), "id long, n_sentences int, removed array<int>, n_words long, n_words_removed long, text string")
    return cleaned.withColumnRenamed("id", id_col)
