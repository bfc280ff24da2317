"""Ranked search against scoring every document for every query."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from termscope.llm import search

WORD = re.compile(search.TERM)


def terms(text):
    return [w.translate(search._LOWER) for w in WORD.findall(text or "")]


def brute(docs, items, depth):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, n_docs = sum(n for *_, n in counted), len(counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        rows = []
        for doc, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in wanted if t in c)
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        rows.sort(key=lambda r: r[:3])
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(rows[:depth])]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def found(spark, docs, items, depth=50, parts=3, **how):
    corpus = spark.createDataFrame([(i, t, 0, "x", None) for i, t in docs], "doc_id long, text string, block int, term string, docs int")
    queries = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, part int, term string")
    rows = search.search(search.build(corpus.repartition(parts), depth, **how), queries).collect()
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(n, seed=1):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, " ".join(draw.choices(words, weights, k=draw.randint(0, 40)))) for k in range(n)]
    items = [(k, " ".join(draw.choices(words, weights, k=draw.randint(1, 12)))) for k in range(25)]
    return docs, items


@pytest.mark.parametrize("block_chars", [1 << 22, 400])
def test_equals_brute_force_in_any_blocks(spark, block_chars):
    docs, items = corpus(400)
    assert found(spark, docs, items, depth=7, block_chars=block_chars) == brute(docs, items, 7)


def test_odd_rows(spark):
    docs = [(1, "Ärger ÄRGER a-b a_b"), (2, None), (3, ""), (4, "..."), (None, "hot cat"), (5, "HOT cat"), (6, "hot cat"), (6, "hot cat"),
            (7, "cat " * 5000), (8, "\x00x\x7fy ü9")]
    items = [(1, "hot"), (1, "CAT cat"), (2, None), (3, "unknown"), (None, "Ärger B x"), (4, ""), (5, "9 y ü9 a")]
    assert found(spark, docs, items) == brute(docs, items, 50)
    assert found(spark, docs, items, depth=2) == brute(docs, items, 2)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_several_parts_of_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 4)
    docs, items = corpus(120, seed=2)
    assert found(spark, docs, items, depth=5, block_chars=900) == brute(docs, items, 5)


def block_of(docs):
    numbers = search.Numbers()
    each = [numbers.of(t or "") for _, t in docs]
    n_docs, n_terms = sum(len(e) > 0 for e in each), sum(map(len, each))
    table = pa.table({"place": list(range(len(docs))), "id": [i for i, _ in docs], "n_terms": [len(e) for e in each]})
    rows = []
    for term, number in numbers.terms.items():
        held = [(k, int((e == number).sum())) for k, e in enumerate(each) if (e == number).any()]
        rows.append({
            "term": term, "weight": math.floor(1000 * math.log((2 * n_docs + 2) / (2 * len(held) + 1))),
            "docs": np.array([k for k, _ in held], "<u2").tobytes(), "tfs": np.array([n for _, n in held], "<u4").tobytes()})
    return search.Block(table, rows, n_docs, n_terms)


def test_pair_bounds_hold_and_skip_more():
    docs, items = corpus(1500, seed=4)
    block = block_of(docs)
    looked, plain = 0, 0
    for _, text in items:
        wanted = [t for t in set(terms(text)) if t in block.lists]
        order = sorted(wanted, key=lambda t: (block.weights[t], t))
        pairs = {p: block.pair(*p, 10) for p in zip(order[::2], order[1::2])}
        for (a, b), (both, joint, kth) in pairs.items():
            apart = [int(block.lists[t][1].max()) for t in (a, b)]
            assert joint <= sum(apart) and kth <= joint
            assert set(both.tolist()) == set(block.lists[a][0].tolist()) & set(block.lists[b][0].tolist())
        with_pairs, without = search.hits(block, wanted, pairs, 10), search.hits(block, wanted, {}, 10)
        assert with_pairs[:2] == without[:2]
        looked, plain = looked + with_pairs[2], plain + without[2]
        some = with_pairs[1][4] if len(with_pairs[1]) > 4 else 0
        above = search.hits(block, wanted, pairs, 10, threshold=some)
        assert [s for s in above[1] if s >= some] == [s for s in with_pairs[1] if s >= some]
    assert looked <= plain


def test_bands_are_nested_samples():
    bands = Counter(search._band(p << 32 | k) for p in range(200) for k in range(80))
    assert 0.9 < bands[0] / 16_000 < 0.97 and bands[1] > bands.get(2, 0) > 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(search, "_PIECE", 20)
    text = "many Words, in-one line " * 20 + "x" * 100
    assert len(list(search.pieces(text))) > 5
    numbers = search.Numbers()
    coded = numbers.of(text).tolist()
    names = {v: k for k, v in numbers.terms.items()}
    assert [names[c] for c in coded] == terms(text)
