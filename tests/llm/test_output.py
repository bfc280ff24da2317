"""Mixing, token output, license scan and WARC: brute force, exact round trips, edge rows."""

from __future__ import annotations

import glob
import gzip
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termscope.llm import licenses, mixing, tokens, warc
from termscope.session import scratch_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
EDGES = [
    (1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (None, None), (4, "word " * 60_000), (5, "<|endoftext|> x"),
    (6, "tab\tnew\n\n line \x1c odd　wide"), (7, "é😀 中文 don't"),
]


def table(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind)


def mix_rows():
    draw = random.Random(2)
    rows = [(i, "w " * draw.randrange(1, 60), "hot" if i % 3 == 0 else f"s{draw.randrange(6)}", 1, "t") for i in range(900)]
    return rows + [(1000, None, "s1", 1, "t"), (1001, "", None, 1, "t"), (1002, "a  b\tc\n", None, 1, "t"), (None, "x y", "tiny", 1, "t"),
                   (1003, "q", "tiny", 1, "t"), (1003, "q", "tiny", 1, "t"), (1004, "", "void", 1, "t")]


MIX = "doc_id long, text string, source string, size int, target string"


def filled(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * rest / free > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * rest / free for s in names}
        capped |= over


def test_mixing(spark):
    rows = mix_rows()
    docs = table(spark, rows, MIX)
    got = mixing.mixed(docs, chunk_digits=1).collect()
    sizes = Counter()
    for _, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    want = filled(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert r.taken == r.size * r.repeats <= 3 * r.size
        taken[r.source] += r.taken
    largest = Counter()
    for r in got:
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in want)
    rows_of = lambda d: Counter(map(tuple, d.select("doc_id", "size", "taken").collect()))
    again = mixing.mixed(docs.repartition(7), chunk_digits=3)
    assert rows_of(again) == rows_of(mixing.mixed(docs, chunk_digits=1))
    assert rows_of(mixing.mixed(docs, seed="other")) != rows_of(again)


def test_helper_columns_do_not_clash(spark):
    names = ("_source", "_size", "_draw", "_chunk", "_start", "_inner", "_whole", "_of_source", "_of_chunk", "_total", "_target", "_copy", "Taken")
    plain = table(spark, mix_rows(), MIX)
    docs = plain.withColumns({n: F.lit("x") for n in names})
    wanted = ("doc_id", "source", "text")
    mix = mixing.mixed(docs)
    assert sorted(map(str, mix.select(*wanted, "taken").collect())) == sorted(map(str, mixing.mixed(plain).select(*wanted, "taken").collect()))
    assert mixing.mixed_corpus(docs).columns == docs.columns


def test_repeated_documents(spark):
    docs = table(spark, mix_rows(), MIX).drop("size", "target")
    mix = mixing.mixed(docs)
    out = mixing.repeated(mix)
    assert out.columns == docs.columns
    assert out.count() == sum(r.repeats for r in mix.collect())
    assert mixing.mixed(table(spark, [], MIX)).collect() == []
    assert [r.taken for r in mixing.mixed(table(spark, [(1, None, "a", 1, "t")], MIX)).collect()] == [0]


def test_tokens_round_trip(spark):
    path = scratch_dir(spark)
    rows = EDGES + [(i, f"document {i} " * (i % 9)) for i in range(20, 200)]
    random.Random(1).shuffle(rows)
    tokens.write_tokens(table(spark, rows).repartition(5), path, TOKENIZER, 2, layout=tokens.Layout(group_ids=2000))
    read = tokens.read_tokens(spark, path)
    library = tokens.Encoder(TOKENIZER).library
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tokens.text_order(r[1] or ""))):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), ids))
        start += len(ids)
    assert sorted(map(tuple, read.collect()), key=lambda r: r[1]) == want
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in tokens.with_crc(read).collect()}
    assert sums == {(i, s): zlib.crc32(array("I", ids).tobytes()) for i, s, _, ids in want}
    files = sorted(glob.glob(f"{path.removeprefix('file://')}/tokens/*.parquet"))
    ends = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        group = meta.row_group(0)
        columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert columns["tokens.list.element"].has_dictionary_page and columns["doc_id"].has_column_index
        ids = [i for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist() if i is not None]
        assert ids == sorted(ids)
        ends += ids[:1] + ids[-1:]
    assert ends == sorted(ends)
    assert read.where("doc_id between 30 and 32").select("n_tokens").count() == 3


def test_tokens_of_a_hot_id(spark):
    path = scratch_dir(spark)
    rows = [(7, f"text {k} " * (k % 5)) for k in range(400)] + [(None, f"{k}") for k in range(300)] + [(k, "t") for k in range(20)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokens.write_tokens(table(spark, rows).repartition(6), path, TOKENIZER, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = tokens.read_tokens(spark, path).orderBy("start").collect()
    assert [r.start for r in read] == [sum(r.n_tokens for r in read[:k]) for k in range(len(read))]
    ids = [-1 if r.doc_id is None else r.doc_id for r in read]
    assert ids == sorted(ids) and len(ids) == len(rows)
    parts = spark.read.parquet(f"{path}/{tokens.PARTS}").count()
    assert parts == 4  # each of the test session's partitions has rows, although two ids hold nearly all


def test_tokens_of_nothing(spark):
    path = scratch_dir(spark)
    tokens.write_tokens(table(spark, []), path, TOKENIZER, 2)
    assert tokens.with_crc(tokens.read_tokens(spark, path)).collect() == []


_encoder = tokens.Encoder(TOKENIZER, entries=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé 中²\t\n.,'s1\x1f᠎　ا́😀<|>_-llve"), max_size=30), max_size=6))
def test_encoder_equals_the_library(texts):
    texts = [*texts, "".join(texts) + "<|endoftext|> end"]
    assert _encoder(texts) == _encoder.whole(texts)


LINES = [
    "Licensed under the Apache License, Version 2.0.", "licensed: Apache version 2 under the license 0", "Apache License",
    "cc by CC BY-NC 4.0 cc cc by", "GNU General Public License", "All rights reserved", "all rights  RESERVED. all-rights-reserved",
    "Released under the MIT licence", "released under the mit license " + "filler " * 50, "ALL RİGHTS reserved", "nothing here",
]


def test_license_report(spark):
    draw = random.Random(4)
    rows = EDGES[:7] + [(10 + i, draw.choice("\n ").join(draw.choices(LINES, k=draw.randrange(1, 7)))) for i in range(80)]
    found = Counter(map(tuple, licenses.license_report(table(spark, rows)).collect()))
    upper = str.maketrans(licenses.UPPER, licenses.LOWER)
    want = Counter()
    for i, t in rows:
        t = (t or "").translate(upper)
        words = re.findall(licenses.WORD, t)
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        labels, best, blocks = {x for _, x in places}, 0.0, set()
        lines = [re.findall(licenses.WORD, line) for line in t.split("\n")]
        line_of = [b for b, line in enumerate(lines) for _ in line]
        step = licenses.half_window(licenses.TEMPLATES)
        for label, template in licenses.TEMPLATES:
            need = set(template.split())

            def common(have, need=need):
                n = len(set(have) & need)
                return n if n >= licenses.required(len(need), 0.9) else 0

            hit = {b for b, line in enumerate(lines) if common(line)}
            best = max([best, *(common(lines[b]) / len(need) for b in hit)])
            last, around = None, set()
            for k in range(max(-(-len(words) // step) - 2, 0) + 1):
                window = range(k * step, min((k + 2) * step, len(words)))
                if window and line_of[window[0]] < line_of[window[-1]] and common([words[x] for x in window]):
                    if not any(line_of[window[0]] <= b <= line_of[window[-1]] for b in hit):
                        around |= set() if last == k - 1 else {-1 - k}
                        last = k
                        best = max(best, common([words[x] for x in window]) / len(need))
            if hit | around:
                labels.add(label)
                blocks |= hit | around
        at = [k for k, _ in places]
        want[i, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})),
             ",".join(sorted(labels)), 1.0 if at else best, len(blocks)] += 1
    assert found == want
    assert licenses.license_report(table(spark, [])).collect() == []


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted"
GPL = "you can redistribute it and/or modify it under the terms of the GNU General Public License"


def test_wrapped_licenses(spark):
    other = "nothing of interest stands here " * 40
    rows, want = [], []
    for label, text in (("mit", MIT), ("bsd", BSD), ("gpl", GPL)):
        words = text.split(" ")
        for width in (1, 2, 5, 8, 11):
            wrapped = "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))
            for before in range(0, 60, 7):
                rows.append((len(rows), " ".join(other.split()[:before]) + "\n" + wrapped + "\n" + other))
                want.append((label, 1.0, 1))
    rows += [(1000, MIT + "\n" + other), (1001, other + "\n" + other), (1002, MIT.replace(" to", "\nto") + "\n" + other + "\n" + MIT)]
    want += [("mit", 1.0, 1), ("", 0.0, 0), ("mit", 1.0, 2)]
    found = {r.doc_id: r for r in licenses.license_report(table(spark, rows)).collect()}
    assert [(found[i].labels, found[i].score, found[i].n_blocks) for i, _ in rows] == want


PAGES = "page_id long, url string, html string, file string, offset int"


def page_rows():
    rows = [(i, f"http://h/{i % 5}\r\nx", "same" if i % 3 == 0 else f"<p>{i}\r\n\r\nWARC/1.1 é", "f", 1) for i in range(40)]
    return rows + [(100, None, None, "f", 1), (101, "u", "", "f", 1), (102, "u", "x" * 300_000, "f", 1), (None, "u", "same", "f", 1),
                   (103, "u", "dup", "f", 1), (103, "u", "dup", "f", 1)]


@pytest.mark.parametrize("least", [0, 4, 5])
def test_warc_round_trip(spark, least):
    rows = page_rows()
    path = scratch_dir(spark)
    warc.write_archive(table(spark, rows, PAGES).repartition(3), path, min_bytes=least)
    index = warc.read_index(spark, path)
    got = warc.read_records(index, path, range_bytes=2000, gap_bytes=30).collect()
    groups = defaultdict(list)
    for i, _, h, *_ in rows:
        groups[h or ""].append(i)
    want = Counter()
    for h, ids in groups.items():
        top = max(i for i in ids if i is not None)
        for i in ids:
            again = len(ids) > 1 and len(h.encode()) >= least and i != top
            want[i, len(h.encode()), warc.digest(h.encode()), "revisit" if again else "response", top if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    texts = defaultdict(set)
    for i, _, h, *_ in rows:
        texts[i].add((h or "").encode())
    assert all(bytes(r.payload) in texts[r.page_id] for r in got if r.record_type == "response")
    some = warc.read_records(index.where("page_id in (7, 8, 102)"), path, payloads=True).collect()
    assert {r.page_id for r in some} == {7, 8, 102}


def test_warc_index_places(spark):
    path = scratch_dir(spark)
    warc.write_archive(table(spark, page_rows(), PAGES), path)
    for r in warc.read_index(spark, path).collect():
        with open(f"{path.removeprefix('file://')}/{r.file}", "rb") as f:
            f.seek(r.offset)
            head, payload = warc.parse(f.read(r.length))
        assert head["WARC-Payload-Digest"] == f"sha1:{r.digest}" and head["WARC-Type"] == r.record_type


def test_warc_files_are_plain_gzip(spark):
    path = scratch_dir(spark)
    warc.write_archive(table(spark, page_rows(), PAGES), path)
    for f in glob.glob(f"{path.removeprefix('file://')}/*.warc.gz"):
        with gzip.open(f) as archive:
            data = archive.read()
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def test_warc_reads_are_dealt_by_bytes(spark):
    path = scratch_dir(spark)
    noise = random.Random(8)
    rows = [(i, "u", "".join(chr(noise.randrange(33, 1000)) for _ in range(3000)), "f", 1) for i in range(60)]
    warc.write_archive(table(spark, rows, PAGES).coalesce(1), path)
    index = warc.read_index(spark, path)
    read = warc.read_records(index, path, stretch_bytes=20_000, range_bytes=8_000)
    per_task = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 3 and sum(r["count"] for r in per_task) == 60


def test_warc_revisits_name_their_response(spark):
    path = scratch_dir(spark)
    warc.write_archive(table(spark, page_rows(), PAGES), path)
    seen = {}
    for f in glob.glob(f"{path.removeprefix('file://')}/*.warc.gz"):
        with gzip.open(f) as archive:
            heads = [h for h in archive.read().split(b"WARC/1.1\r\n") if h.startswith(b"WARC-Type")]
        assert heads[0].startswith(b"WARC-Type: warcinfo")
        for h in heads:
            head = dict(x.split(": ", 1) for x in h.decode(errors="replace").split("\r\n\r\n")[0].split("\r\n"))
            seen[head["WARC-Record-ID"]] = head
    revisits = [h for h in seen.values() if h["WARC-Type"] == "revisit"]
    assert revisits
    for h in revisits:
        response = seen[h["WARC-Refers-To"]]
        assert response["WARC-Type"] == "response" and response["X-Page-ID"] == h["X-Refers-To-Page"]
        assert response["WARC-Target-URI"] == h["WARC-Refers-To-Target-URI"]
        assert response["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


def test_warc_of_nothing(spark):
    path = scratch_dir(spark)
    warc.write_archive(table(spark, [], PAGES), path)
    assert warc.read_records(warc.read_index(spark, path), path).collect() == []
