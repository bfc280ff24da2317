"""Token ids in Parquet: list columns, dictionary and delta encoding, small row groups, page indexes.

Format of a token folder: ``tokens/`` holds one Parquet file per range of
document ids, rows in ascending id order, with the columns

    doc_id, part (place of the file), local_start (ids before the row in its
    file), n_tokens, tokens (list<int>)

The token column is dictionary encoded, the integer columns are delta encoded,
row groups and pages are small, and column and offset indexes are written, so
that a read of some ids or of the metadata alone skips the rest.
``parts/`` has one row per file with the ids in all files before it.

Encoding goes through the tokenizers library.  Words repeat, so a worker
encodes each distinct run of blanks and letters, or of blanks and anything up
to the next blank, once and then looks it up; a run ends where the library's own
first split ends, hence the ids are those of the whole text.  Texts with characters for which the two notions of a blank differ,
or with the text of a special token, are encoded in one piece.

Defined results: a null text counts as empty and gives the end id alone; null
ids come first; rows that agree in id follow by a hash of their text; an empty table gives
an empty folder.  Extra columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termscope.session import materialize

TOKENS = "tokens"
PARTS = "parts"
SCHEMA = "doc_id long, part int, local_start long, n_tokens long, tokens array<int>"
_CACHE_ENTRIES = 350_000  # per generation
_HOT_ID = 100  # rows of one id from which its rows may go to several files
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ӿ"  # scripts with the fast path; others go up to the next blank
_RUN = re.compile(rf" ?[{_LETTERS}]+|\s*\S+|\s+")
_ODD_BLANKS = ("\x1c", "\x1d", "\x1e", "\x1f", "\u180e")
_loaded: dict[str, Encoder] = {}


class Encoder:
    """Whole-text encoding that remembers runs in two generations.

    A full young generation becomes the old one, so frequent runs stay and rare ones leave.
    """

    def __init__(self, path: str, entries: int = _CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; waiting threads would burn it
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.odd = [*_ODD_BLANKS, *(t.content for t in self.library.get_added_tokens_decoder().values())]
        blank = self.library.pre_tokenizer.pre_tokenize_str(" ")[0][0]  # how the vocabulary writes it
        vocabulary = self.library.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith(blank)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.entries = entries

    def _encoded(self, texts: list[str]) -> list:
        return self.library.encode_batch_fast(texts, add_special_tokens=False)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("i", e.ids).tobytes() for e in self._encoded(texts)]

    def _learn(self, runs: list[str]) -> None:
        """Encode new runs; runs of one blank and letters go side by side in one text, which costs less."""
        plain, alone = [], []
        for run in runs:
            (plain if run[0] == " " and run[1:].isalpha() else alone).append(run)
        groups = ["".join(plain[k : k + 64]) for k in range(0, len(plain), 64)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self._encoded(groups)), np.int32)
        cuts = (np.flatnonzero(self.opens[ids]) * 4).tolist()  # a run's blank is in its first token
        if len(cuts) == len(plain):
            data = ids.tobytes()
            self.young.update(zip(plain, map(data.__getitem__, map(slice, cuts, [*cuts[1:], len(data)])), strict=True))
        else:
            alone = runs
        if alone:
            self.young.update(zip(alone, self.whole(alone), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers in the machine's order (little-endian on all platforms of Spark)."""
        split = [None if any(map(t.__contains__, self.odd)) else _RUN.findall(t) for t in texts]
        if len(self.young) > self.entries:
            self.old, self.young = self.young, {}
        known = self.young
        found = [list(map(known.get, runs)) if runs else [] for runs in split]
        gaps = [_gaps(some) for some in found]
        new = []
        for run in {runs[k] for runs, some in zip(split, gaps, strict=True) for k in some}:
            ids = self.old.get(run)
            if ids is None:
                new.append(run)
            else:
                known[run] = ids
        if new:
            self._learn(new)
        for runs, some, places in zip(split, found, gaps, strict=True):
            for k in places:
                some[k] = known[runs[k]]
        return [self.whole([t])[0] if runs is None else b"".join(some) for t, runs, some in zip(texts, split, found, strict=True)]


def text_order(text: str) -> int:
    """What rows that agree in id are ordered by: Spark's xxhash64 of the text."""
    import xxhash

    return np.array(xxhash.xxh64_intdigest(text, seed=42), np.uint64).astype(np.int64).item()


def _gaps(found: list[bytes | None]) -> list[int]:
    """Places of None."""
    out, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


def slices(texts: pa.Array, chars: int = 1 << 18) -> Iterator[list[str]]:
    """The batch's texts in lists of about ``chars`` characters."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py())
        size += len(some[-1])
        if size >= chars:
            yield some
            some, size = [], 0
    if some:
        yield some


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


@dataclass(frozen=True)
class Layout:
    """Sizes inside a token file; rows per page are a multiple of ``page_rows``."""

    group_ids: int = 2 << 20
    page_bytes: int = 64 << 10
    page_rows: int = 64

    def writer(self, sink) -> pq.ParquetWriter:
        delta = {c: "DELTA_BINARY_PACKED" for c in ("doc_id", "part", "local_start", "n_tokens")}
        return pq.ParquetWriter(
            sink, _FILE, version="2.6", data_page_version="2.0", compression="zstd", compression_level=1,
            use_dictionary=["tokens.list.element"], column_encoding=delta, write_page_index=True,
            data_page_size=self.page_bytes, write_batch_size=self.page_rows)


_FILE = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()), ("n_tokens", pa.int64()),
    ("tokens", pa.list_(pa.field("element", pa.int32())))])


def _encode(path: str, tokenizer: str, end_id: int, layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, start, encode = task.partitionId(), 0, encoder(tokenizer)
        end = np.asarray([end_id], np.int32).tobytes()
        store, root = fs.FileSystem.from_uri(f"{path}/{TOKENS}")
        name = f"part-{part:05d}.parquet"
        mine = f"{root}/.{name}.{task.taskAttemptId()}"  # a repeated task writes anew and replaces the file
        rows, held = 0, ([], [])

        def table() -> pa.Table:
            nonlocal start
            ids, coded = held
            sizes = np.fromiter((len(x) // 4 for x in coded), np.int64, len(coded))
            after = np.cumsum(sizes)
            values = pa.Array.from_buffers(pa.int32(), int(after[-1]), [None, pa.py_buffer(b"".join(coded))])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], after]).astype(np.int32)), values)
            out = pa.Table.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.full(len(coded), part, np.int32)), pa.array(start + after - sizes),
                 pa.array(sizes), lists.cast(_FILE.field("tokens").type)], schema=_FILE)
            start += int(after[-1])
            ids.clear()
            coded.clear()
            return out

        writer, size = None, 0
        with store.open_output_stream(mine) as sink:
            for batch in batches:
                ids = iter(batch.column(0).to_pylist())
                for some in slices(batch.column(1)):
                    for data in encode(some):
                        held[0].append(next(ids))
                        held[1].append(data + end)
                        size += len(data) // 4 + 1
                    if size >= layout.group_ids:
                        writer = writer or layout.writer(sink)
                        rows += len(held[0])
                        writer.write_table(table())
                        size = 0
            if held[0]:
                writer = writer or layout.writer(sink)
                rows += len(held[0])
                writer.write_table(table())
            if writer:
                writer.close()
        if rows:
            store.move(mine, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([rows], pa.int64()), pa.array([start], pa.int64())],
                names=["part", "n_rows", "n_ids"])
        else:
            store.delete_file(mine)
    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    layout: Layout = Layout(),
) -> None:
    """Encode ``text_col`` of all rows into the token folder ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    # Borders inside an id need the texts' hashes, which costs one more reading of the texts.
    most = rows.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    dealt = rows.repartitionByRange(*(order if most > _HOT_ID else order[:1])).sortWithinPartitions(*order)
    store, root = fs.FileSystem.from_uri(f"{path}/{TOKENS}")
    store.create_dir(root, recursive=True)
    written = materialize(dealt.mapInArrow(_encode(path, tokenizer, end_id, layout), "part int, n_rows long, n_ids long"))
    # One row per file, so this window is over as many rows as the write had tasks.
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = written.select("part", "n_rows", F.coalesce(before, F.lit(0)).alias("part_start"))
    parts.coalesce(1).write.mode("overwrite").parquet(f"{path}/{PARTS}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all rows before), n_tokens, tokens; columns that are not used are not read.

    ``parts`` has one row per file of the folder; Spark broadcasts it while it is small.
    """
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/{PARTS}")
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/{TOKENS}")
    start = (F.col("part_start") + F.col("local_start")).alias("start")
    return rows.join(parts, "part").select("doc_id", start, "n_tokens", "tokens")


def with_crc(tokens: DataFrame) -> DataFrame:
    """Replace ``tokens`` by ids_crc32, the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            at = lists.offsets.to_numpy() * 4
            sums = [zlib.crc32(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
