"""Alignment of two tokenizers against a plain count over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termscope.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
_HERE: list = []


def aligner():
    if not _HERE:
        _HERE.append(align.Aligner(A, B))
    return _HERE[0]


def groups(text):
    """Groups of (A ids, B ids) of the whole text, by a walk over both token lists; None without tokens."""
    if not text:
        return None
    own, data = aligner(), (" " + text).encode()
    (a,), (b,) = own.encoded([" " + text])
    if b"".join(own.bytes_a[i] for i in a) != data or b"".join(own.bytes_b[i] for i in b) != data:
        return None
    out, left, right, x, y = [], [], [], 0, 0
    a, b = list(a), list(b)
    while a or b:
        if x <= y and a:
            left.append(a.pop(0))
            x += len(own.bytes_a[left[-1]])
        else:
            right.append(b.pop(0))
            y += len(own.bytes_b[right[-1]])
        if x == y and left and right:
            out.append((left, right))
            left, right = [], []
    return out


def brute(rows):
    cut = [groups(t) or [] for _, t in rows]
    links = [Counter((i, j) for a, b in g for i in a for j in b) for g in cut]
    count = Counter(p for own in links for p in own)
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for (id_, _), g, own in zip(rows, cut, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            id_, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
            sum(n for p, n in own.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def found(spark, rows, parts=3, **how):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, block int, docs string")
    return sorted(map(tuple, align.scores(align.build(docs.repartition(parts), A, B, **how)).collect()), key=str)


ODD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "tail   ", "a▁b", "<s> </s> <unk>", "<|endoftext|> x", "<0x0A>", "\n", "\r\n a\n\n b",
    "\t\ta", "é́ ﬁ ＡＢ", "日本語のテキスト", "🙂🙂 👩‍👩‍👧", "　wide", "\x00nul \x1f", "x" * 3000, "don't I'll we've", "�￿",
    "a b", "word\n word", "12345 6.7e8",
]


def test_odd_repeated_and_empty_rows(spark):
    rows = list(enumerate(ODD)) + [(5, "the same text twice")] * 2 + [(None, "no id"), (None, None)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_small_blocks_give_the_same(spark):
    draw = random.Random(3)
    words = ["the", "then", "xq", "über", "naïve", "foo.bar", "a", "12", "日本"]
    rows = [(k, " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))) for k in range(300)]
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, block_chars=500) == want


def test_long_texts_are_cut_at_runs(monkeypatch):
    monkeypatch.setattr(align, "_PIECE", 50)
    text = "  many words in  one line \n and    more " * 30
    assert len(list(align._pieces(" " + text))) > 5
    assert "".join(align._pieces(" " + text)) == " " + text
    numbers, hashes, (_, pair, n) = align.Aligner(A, B).documents([text])
    want = brute([(1, text)])[0]
    assert (*numbers[0].tolist(), hashes[0]) == (*want[1:5], want[7]) and int(n.sum()) == want[4]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t.'aeltsö日🙂<s>0▁", max_size=40), min_size=1, max_size=4))
def test_runs_equal_whole_texts(texts):
    numbers, hashes, (doc, pair, n) = aligner().documents(texts)
    want = brute(list(enumerate(texts)))
    for k, row in enumerate(sorted(want)):
        assert (*numbers[k].tolist(), hashes[k]) == (*row[1:5], row[7])
        assert int(n[doc == k].sum()) == row[4]


def test_wide_groups_count_by_ids(monkeypatch):
    texts = ["日本🙂" * 40, "x" * 500, "the end"]
    want = [c.tolist() for c in aligner().documents(texts)[2]]
    monkeypatch.setattr(align, "_WIDE", 2)
    monkeypatch.setattr(align, "_PAIRED", 3)
    assert [c.tolist() for c in align.Aligner(A, B).documents(texts)[2]] == want


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_places_and_planes_round_trip(width):
    draw = random.Random(width)
    lists = [sorted(draw.sample(range(width * 8), draw.randint(1, min(width * 8, 50)))) for _ in range(20)]
    links = [[draw.choice([1, 1, 2, 9, 70_000]) for _ in x] for x in lists]
    import numpy as np

    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    docs = align.packed_places(np.array(sum(lists, []), np.int64), starts, width).to_pylist()
    planes = align.packed_planes(np.array(sum(links, []), np.int64), starts).to_pylist()
    assert [align.places_of(d, len(x)).tolist() for d, x in zip(docs, lists, strict=True)] == lists
    assert [align.links_of(p, len(x)).tolist() for p, x in zip(planes, links, strict=True)] == links
    assert all(len(d) <= width for d in docs)


def test_pair_totals(spark):
    docs = spark.createDataFrame([(1, "the the cat"), (2, "the"), (3, "cat")], "doc_id long, text string")
    index = align.build(docs.repartition(2), A, B)
    the, cat = (aligner().encoded([f" {w}"])[0][0][0] for w in ("the", "cat"))
    totals = {r["a"]: (r["n_docs"], r["n_links"], r["best"]) for r in index.pairs().collect()}
    assert totals[the] == (2, 3, True) and totals[cat] == (2, 2, True)
