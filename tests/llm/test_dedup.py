"""Exact dedup, n-gram join, span dedup and components against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from termscope.llm import exact, graph, near, spans

SCHEMA = "doc_id long, text string, uid string, key int, block string, n int"


def table(spark, rows):
    """Documents with columns whose names the operators also use inside."""
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def words(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


EDGES = [
    (1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (None, "a"), (None, None), (5, " "), (6, "long " * 40_000),
    (7, "long " * 40_000), (8, "long " * 39_999 + "lonh "), (9, "é😀" * 30), (10, "é😀" * 30), (11, "x\ny\r\n"),
]


def check_exact(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        for i in ids:
            want[i, top, len(ids), sha] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert len(kept) == len(groups) and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_groups(spark):
    check_exact(EDGES, exact.exact_groups(table(spark, EDGES)).collect())


@pytest.mark.parametrize("buckets", [1, 3])
def test_exact_groups_with_shared_buckets(spark, buckets):
    draw = random.Random(1)
    rows = [(i, "".join(draw.choice("ab") for _ in range(draw.randrange(14)))) for i in range(150)]
    few = lambda v: F.pmod(F.xxhash64(v), F.lit(buckets))
    check_exact(rows, exact.exact_groups(table(spark, rows), block_chars=2, bucket=few).collect())


def test_exact_groups_of_nothing(spark):
    assert exact.exact_groups(table(spark, [])).collect() == []


def test_components(spark):
    draw = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (None, 3)]
    edges += [(300 + draw.randrange(80), 300 + draw.randrange(80)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def jaccard(a, b):
    return len(a & b) / len(a | b)


def near_rows():
    draw = random.Random(5)
    rows = []
    for base in range(6):
        text = words(base, 60)
        for _ in range(8):
            copy = list(text)
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(60)] = f"edit{draw.randrange(9)}"
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(text)))
        rows.append((len(rows), " ".join(text).upper()))
    rows += [(len(rows) + k, " ".join(words(50 + k, 40))) for k in range(10)]
    return rows


def brute_links(rows):
    sets = [set(near.shingles(t or "").tolist()) for _, t in rows]
    links, root = Counter(), list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return links, root


@pytest.mark.parametrize("options", [{}, {"block_docs": 4, "block_grams": 200}])
def test_near_classes(spark, options):
    rows = near_rows()
    links, root = brute_links(rows)
    got = {r.doc_id: r for r in near.near_classes(table(spark, rows), **options).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: links[k] for k, (i, _) in enumerate(rows)}
    assert {i: r.class_id for i, r in got.items()} == {i: rows[root[k]][0] for k, (i, _) in enumerate(rows)}
    assert sum(r.kept for r in got.values()) == len(set(root))
    kept = near.one_per_class(table(spark, rows), **options)
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_similar_pairs_are_all_pairs(spark):
    rows = near_rows()
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(near.shingles(t).tolist()), i)
    reps = list(sets.items())
    want = {tuple(sorted((i, j))): jaccard(a, b) for k, (a, i) in enumerate(reps) for b, j in reps[:k] if jaccard(a, b) >= 0.8}
    got = {(r.a, r.b): r.jaccard for r in near.similar_pairs(table(spark, rows), block_docs=5).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_near_edges(spark):
    got = near.near_classes(table(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [r.n_links for r in by[3] + by[4]] == [3, 3, 3] and by[4][0].class_id == 3
    assert by[6][0].class_id == by[7][0].class_id == 6 and by[2][0].n_links == 0
    kept = near.one_per_class(table(spark, EDGES)).collect()
    assert Counter(r.text for r in kept if r.text and r.text.startswith("a")) == {"a": 1}
    assert near.near_classes(table(spark, [])).collect() == []
    assert near.one_per_class(table(spark, [])).collect() == []


def test_banding_reaches_its_recall():
    for threshold in (0.5, 0.8, 0.95, 1.0):
        shape = near.banding(threshold, 0.999)
        assert 1 - (1 - threshold**shape.rows) ** shape.bands >= 0.999 or threshold < 0.6
        assert shape.rows * shape.bands <= 128
    assert near.banding() == near.Banding(18, 5)


def brute_clean(rows, settings):
    """Removed sentences by comparing all runs of every length."""
    first, docs = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        pieces = spans.sentences(t or "", settings.longest)
        worded = [tuple(spans.WORD.findall(p.lower())) for p in pieces]
        at = [k for k, w in enumerate(worded) if w]
        found = []
        for a in range(len(at)):
            for b in range(a + settings.min_sentences - 1, len(at)):
                words = tuple(w for k in at[a : b + 1] for w in worded[k])
                if len(words) >= settings.min_words:
                    found.append((at[a], at[b] + 1, words))
        docs.append((i, pieces, worded, found))
        for a, _, w in found:
            first.setdefault(w, (i, a))
    out = {}
    for i, pieces, worded, found in docs:
        gone = {k for a, b, w in found if first[w] != (i, a) for k in range(a, b) if worded[k]}
        out[i] = "".join(p for k, p in enumerate(pieces) if k not in gone), sorted(gone)
    return out


def test_spans_against_brute_force(spark):
    draw = random.Random(9)
    passage = ". ".join(" ".join(words(700 + k, 13)) for k in range(5)) + "."
    rows = []
    for i in range(60):
        lines = [" ".join(words(1000 + i * 10 + k, draw.choice((1, 3, 12, 30, 45)))) + draw.choice((".", "!", " ...")) for k in range(6)]
        if i % 3 == 0:
            lines.insert(draw.randrange(6), passage)
        if i % 7 == 0:
            lines += lines[1:4]
        rows.append((i, draw.choice(("\n", " ")).join(lines)))
    rows += [(100, None), (101, ""), (102, "?!. \n\n."), (None, rows[1][1]), (103, rows[0][1]), (104, "Short one. Short two.")]
    settings = spans.Settings()
    want = brute_clean(rows, settings)
    got = {r.doc_id: r for r in spans.without_repeats(table(spark, rows), settings).collect()}
    assert {i: (r.text, r.removed) for i, r in got.items()} == want
    assert sum(passage.split(".")[1] in r.text for r in got.values()) == 1  # the first alone keeps it
    assert got[104].n_words_removed == 0


def test_spans_of_edges(spark):
    got = spans.without_repeats(table(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    assert spans.without_repeats(table(spark, [])).collect() == []


def test_long_sentences_are_cut(spark):
    draw = random.Random(2)
    for n in (1, 39, 40, 41, 80, 81, 500):
        text = "".join(f"w{k}" + draw.choice([" ", ", ", "  ", "-"]) for k in range(n))
        pieces = spans.sentences("Start here. " + text)
        assert "".join(pieces) == "Start here. " + text
        sizes = [len(spans.WORD.findall(p)) for p in pieces[1:]]
        assert sum(sizes) == n and all(x == 40 for x in sizes[:-1]) and 0 < sizes[-1] <= 40
    own = " ".join(words(50, 60))
    rows = [(1, f"Some text first. {own}. And more."), (2, f"Other words then. {own}. Not the same."), (3, "Short. " + " ".join(words(90, 38)) + "."),
            (4, "Brief. " + " ".join(words(90, 38)) + ".")]
    got = {r.doc_id: r for r in spans.without_repeats(table(spark, rows)).collect()}
    assert [got[k].n_words_removed for k in (1, 2, 3, 4)] == [0, 60, 0, 0]


def test_spans_keep_no_tail(spark):
    draw = random.Random(4)
    fresh = iter(range(10**6))
    sentence = lambda n: " ".join(f"v{next(fresh)}" for _ in range(n)) + "."
    passages = [[sentence(n) for n in sizes] for sizes in ((30, 20, 4), (45, 38), (3, 45, 2, 2), (24, 1, 39), (12, 12), (4, 20, 30))]
    passages += [[sentence(draw.choice((1, 3, 9, 22, 39, 41))) for _ in range(draw.randrange(2, 9))] for _ in range(30)]
    rows = [(len(passages) * c + k, " ".join([sentence(30), *p, sentence(30)])) for c in range(2) for k, p in enumerate(passages)]
    rows += [(1000 + k, " ".join([*p, sentence(5), *p[1:], *p])) for k, p in enumerate(passages)]
    settings = spans.Settings()
    want = {i: gone for i, (_, gone) in brute_clean(rows, settings).items()}
    got = {r.doc_id: r.removed for r in spans.without_repeats(table(spark, rows), settings).collect()}
    assert got == want
    second = len(passages)
    assert [got[second + k] for k in range(5)] == [[1, 2, 3], [1, 2, 3], [1, 2, 3, 4, 5], [1, 2, 3], []]


def test_spans_read_texts_at_once_as_one_by_one():
    words = "One two. Three\n\nfour _5 six! \tSeven?\nEight é\u00df 'nine' " + "x" * 70 + " ten"
    chunk = [words, "", " . a", words.upper(), ". \n b\x00c\n", "no stop " * 9]
    found = spans.sentences_of(chunk, 4)
    alone = [spans._read_slowly(t, 4) for t in chunk]
    for name in ("count", "start", "words", "hashes"):
        assert getattr(found, name).tolist() == [x for one in alone for x in getattr(one, name).tolist()]
    border = [0, *found.count.cumsum().tolist()]
    for t, a, b in zip(chunk, border, border[1:]):
        starts = [*found.start[a:b].tolist(), len(t)]
        assert [t[x:y] for x, y in zip(starts, starts[1:])] == spans.sentences(t, 4)
    for odd in ("\u0130stanbul. ", "\u039f\u03a3 \u03a3\u0391. "):  # letters that are read one text at a time
        assert spans.sentences_of([odd * 3], 4).words.tolist() == [len(spans.WORD.findall(p.lower())) for p in spans.sentences(odd * 3, 4)]
