"""WARC archives with an index first: written per partition, read back by coalesced byte ranges.

``write_archive`` gives every page one record.  Of pages with equal payloads the
one with the largest id is a ``response``; the others are ``revisit`` records
that name it and hold no payload.  Each task writes one archive file (to a
name of its own first, then moved, so that a repeated task replaces it) and
returns the index: file, offset, length, url and digest per record, stored as
Parquet in the same folder.  A file begins with a ``warcinfo`` record; a revisit
names the response's page, URI and record id.  Every record is a gzip member of its own, as usual for
archives, so offsets and lengths are those of compressed bytes.

``read_records`` takes selected index rows, deals them out by file and stretch
of bytes, sorts them by offset and reads neighbouring records with one request.

Files go through Arrow's file systems, so the folder may be any that both
Arrow and Spark reach (file, hdfs, s3, gs).

Defined results: a null payload counts as empty; a null url becomes
``urn:page:<id>``; rows that agree in id and payload are records of the same
kind; pages without id rank below all others; an empty table gives an empty
archive.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = (
    "page_id long, url string, file string, offset long, length long, digest string, record_type string, refers_to long"
)
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def target_uri(page_id: int | None, url: str | None) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"


def record_id(*parts: object) -> str:
    """The same id for the same record, also when a task is repeated."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_to_url: str | None, revisit: bool, date: str,
) -> tuple[bytes, str]:
    """One record's bytes and the digest of its payload."""
    sha = digest(payload)
    uri = target_uri(page_id, url)
    block = _HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, uri, sha)}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    head += [] if page_id is None else [f"X-Page-ID: {page_id}"]
    if revisit:
        response = target_uri(refers_to, refers_to_url)
        head += [
            f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, response, sha)}",
            f"WARC-Refers-To-Target-URI: {response}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + _END + block + _END, sha


def file_record(name: str, date: str) -> bytes:
    """The ``warcinfo`` record that a file begins with."""
    block = b"software: termscope\r\nformat: WARC File Format 1.1\r\n"
    head = [
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id('warcinfo', name)}", f"WARC-Date: {date}",
        f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def packed(data: bytes) -> bytes:
    """A gzip member without name or time, so that repeated tasks write equal bytes."""
    member = zlib.compressobj(level=4, wbits=31)
    return member.compress(data) + member.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one packed record; raises on a record that is not whole."""
    data = zlib.decompress(data, wbits=31)
    at = data.index(_END)
    lines = data[:at].decode().split("\r\n")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = data[at + 4 : at + 4 + int(head["Content-Length"])]
    if lines[0] != "WARC/1.1" or data[at + 4 + len(block) :] != _END:
        raise ValueError(f"no whole record: {lines[:2]}")
    return head, block[block.index(_END) + 4 :]


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``revisit`` and ``refers_to`` to (page_id, url, payload).

    Equal payloads are found on narrow rows; the payloads cross the network
    once, by page, where no key is hot.
    """
    keyed = pages.withColumn("key", F.sha2(F.col("payload").cast("binary"), 256))
    narrow = keyed.select("page_id", "url", "key", F.octet_length("payload").alias("n"))
    tops = narrow.where(F.col("n") >= min_bytes).groupBy("key").agg(
        F.max("page_id").alias("top"), F.max_by("url", "page_id").alias("top_url"), F.count("*").alias("copies")).where("copies > 1 and top is not null")
    again = narrow.join(tops, "key").where(~F.col("page_id").eqNullSafe(F.col("top"))).select(
        F.col("page_id").alias("again_id"), F.col("key").alias("again_key"), F.col("top").alias("refers_to"),
        F.col("top_url").alias("refers_to_url")).distinct()
    of_row = keyed["page_id"].eqNullSafe(again["again_id"]) & (keyed["key"] == again["again_key"])
    return keyed.join(again, of_row, "left").select(
        "page_id", "url", "payload", F.col("again_key").isNotNull().alias("revisit"), "refers_to", "refers_to_url")


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write archive files and ``index/`` below ``path``."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        name = f"part-{task.partitionId():05d}.warc.gz"
        mine = f"{root}/.{name}.{task.taskAttemptId()}"
        with store.open_output_stream(mine) as out:
            at = out.write(packed(file_record(name, date)))
            for batch in batches:
                index = []
                for page_id, url, payload, revisit, refers_to, refers_to_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data, sha = record(page_id, url, payload.encode(), refers_to, refers_to_url, revisit, date)
                    data = packed(data)
                    out.write(data)
                    kind = "revisit" if revisit else "response"
                    index.append((page_id, url, name, at, len(data), sha, kind, refers_to))
                    at += len(data)
                if index:
                    yield _batch(index, INDEX_SCHEMA)
        store.move(mine, f"{root}/{name}")

    placed = roles(rows, min_bytes).sortWithinPartitions("page_id", "payload")
    placed.mapInArrow(run, INDEX_SCHEMA).write.mode("overwrite").parquet(f"{path}/index")


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def read_tasks(wanted_bytes: int, stretch_bytes: int) -> int:
    """Twice as many tasks as stretches, so that few tasks have several."""
    return max(1, 2 * math.ceil(wanted_bytes / stretch_bytes))


def read_records(
    index: DataFrame, path: str, payloads: bool = True, gap_bytes: int = 64 << 10, range_bytes: int = 8 << 20,
    stretch_bytes: int = 8 << 20,
) -> DataFrame:
    """The records of the index rows given; ``payloads=False`` leaves the payload column null."""
    def read(store, name: str, rows: list[tuple[int, int]]) -> list[tuple]:
        start = rows[0][0]
        with store.open_input_file(name) as file:
            data = file.read_at(rows[-1][0] + rows[-1][1] - start, start)
        out = []
        for offset, length in rows:
            head, payload = parse(data[offset - start : offset - start + length])
            revisit = head["WARC-Type"] == "revisit"
            sha = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if not revisit and (digest(payload) != sha or len(payload) != int(head["X-Payload-Length"])):
                raise ValueError(f"{name}: payload at {offset} does not fit its digest")
            refers_to = head.get("X-Refers-To-Page")
            out.append((
                int(head["X-Page-ID"]) if "X-Page-ID" in head else None, head["WARC-Target-URI"], head["WARC-Type"],
                None if refers_to is None else int(refers_to), int(head["X-Payload-Length"]), sha,
                payload if payloads and not revisit else None))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        name, rows = None, []
        for batch in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                end = rows[-1][0] + rows[-1][1] if rows else 0
                if rows and (file != name or offset - end > gap_bytes or offset + length - rows[0][0] > range_bytes):
                    yield _batch(read(store, f"{root}/{name}", rows), RECORD_SCHEMA)
                    rows = []
                name = file
                rows.append((offset, length))
        if rows:
            yield _batch(read(store, f"{root}/{name}", rows), RECORD_SCHEMA)

    # The rows are narrow but stand for the bytes they point to, so the number of tasks follows those.
    wanted = index.agg(F.sum("length")).first()[0] or 0
    stretch = F.floor(F.col("offset") / stretch_bytes)
    dealt = index.select("file", "offset", "length").repartition(
        read_tasks(wanted, stretch_bytes), "file", stretch).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, RECORD_SCHEMA)
