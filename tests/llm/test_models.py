"""Toxicity, LM scoring and decontamination: held-out accuracy, plain recomputation, edge rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from termscope.llm import decontaminate, lm, toxicity

DOCS = "doc_id long, text string, score string, leaks int, block string, _label int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "b", 0) for i, t in rows], DOCS)


EDGES = [(1, None), (2, ""), (3, "?!"), (None, "plain words"), (4, "same"), (4, "same"), (5, "long text " * 30_000)]
BAD = ("gribblot", "wumpfish", "zarkling", "plonkrat")


def labelled(n, seed):
    draw = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ten", "ra", "su", "del", "vo", "ni", "par"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(draw.choices(syllables, k=draw.randrange(1, 4))) for _ in range(draw.randrange(20, 200))]
        toxic = int(draw.random() < 0.3)
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                word = list(draw.choice(BAD))
                word[draw.randrange(len(word))] = draw.choice("abcxyz*"[:6])  # a misspelling
                words.insert(draw.randrange(len(words)), "".join(word))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_finds_unseen_misspellings(spark):
    rows, labels = labelled(900, 1)
    docs = table(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks, usable=marks["doc_id"] % 4 != 2)
    truth = dict(labels)
    scored = toxicity.with_score(docs, model)
    assert sorted(scored.columns) == sorted(docs.columns)
    held = [(truth[r.doc_id], r.score) for r in scored.collect() if r.doc_id % 4 == 2]
    assert all(0 <= s <= 1 for _, s in held)
    pos, neg = ([s for t, s in held if t == k] for k in (1, 0))
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.97
    assert np.mean([s >= 0.3 for s in pos]) > 0.9 and np.mean([s >= 0.3 for s in neg]) < 0.05
    kept = toxicity.without_toxic(docs, model, 0.5)
    assert kept.columns == docs.columns and {truth[r.doc_id] for r in kept.where("doc_id % 4 != 2").collect()} >= {0}
    edge = {(r.doc_id, r.text): r.score for r in toxicity.with_score(table(spark, EDGES), model).collect()}
    assert edge[1, None] == edge[2, ""] == edge[3, "?!"] < 0.5
    assert toxicity.with_score(table(spark, []), model).collect() == []


def test_toxicity_without_both_classes(spark):
    docs = table(spark, EDGES)
    for rows in ([], [(4, 1)], [(4, 0)]):
        model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert all(r.score < 1e-6 for r in toxicity.with_score(docs, model).collect())


def test_scores_do_not_depend_on_the_batch():
    rows, labels = labelled(60, 2)
    texts = [t for _, t in rows] + ["", "gribblot"]
    model = toxicity.fit(texts[:60], [t for _, t in labels], toxicity.Settings(epochs=1))
    together = model.scores(texts)
    model.known.clear()
    model.sums.clear()
    assert np.allclose(together, [model.scores([t])[0] for t in texts])


def test_scores_against_plain_loops():
    rows, labels = labelled(80, 3)
    texts = [t for _, t in rows]
    model = toxicity.fit(texts, [t for _, t in labels], toxicity.Settings(epochs=2, steps=20))
    texts = [*texts[:20], "", "one", "a b c d e f g", "ünï çødé 日本 " * 40]
    want = []
    for text in texts:
        words = toxicity._WORD.findall(text.lower())
        held = [[model.weight[b] for b in toxicity.grams([w], model.settings)[0]] for w in words]
        size, step = model.settings.window, model.settings.window // 2
        starts = [0]
        while starts[-1] + size < len(words):
            starts.append(starts[-1] + step)
        evidence, seen = 0.0, set()
        for a in starts:
            if tuple(words[a : a + size]) in seen:
                continue
            seen.add(tuple(words[a : a + size]))
            some = [x for w in held[a : a + size] for x in w]
            evidence += math.log1p(math.exp(sum(some) / max(len(some), 1) + model.bias))
        z = model.shape @ [math.log(max(evidence - len(seen) * model.level, 0) + 3e-3), math.log(len(seen)), 1.0]
        want.append(1 / (1 + math.exp(-z)))
    assert np.allclose(model.scores(texts), want, rtol=1e-6)


def test_all_windows_count():
    """Two weak passages are more evidence than one, and clean text around one does not add up."""
    rows, labels = labelled(900, 1)
    model = toxicity.fit([t for _, t in rows], [t for _, t in labels], toxicity.Settings())
    clean = [t for (_, t), (_, y) in zip(rows, labels, strict=True) if not y]
    once, often = model.scores(clean), model.scores([" ".join([t] * 100) for t in clean])
    assert np.mean(once < 0.3) > 0.97 and np.mean(often < 0.3) > 0.85
    one = [f"{t} gribblot {t}" for t in clean]
    two = [f"{t} {u} wumpfish {u}" for t, u in zip(one, reversed(clean), strict=True)]
    assert np.mean(model.scores(one) > 0.5) > 0.95
    assert (model.evidence(two)[:, 0] > model.evidence(one)[:, 0]).mean() > 0.95


def test_windows_cover_all_words():
    lengths = [0, 1, 2, 5, 6, 7, 23]
    first, last, of = toxicity.windows(lengths, 6)
    start = np.cumsum(lengths) - lengths
    for k, n in enumerate(lengths):
        seen = {w for a, b, o in zip(first, last, of, strict=True) if o == k for w in range(a, b)}
        assert seen == set(range(start[k], start[k] + n)) and (of == k).sum() >= 1


def plain_scores(rows, targets, strength):
    grams = {i: [] for i in range(len(rows))}
    for k, (_, t) in enumerate(rows):
        data = b"\0\0\0\0" + (t or "").encode()
        grams[k] = [data[j : j + 5] for j in range(len(data) - 4)]
    out = []

    def counts(keep):
        c = Counter()
        for k, (i, _) in enumerate(rows):
            if keep(i):
                for g in grams[k]:
                    c.update((("5", g), ("4", g[:4]), ("3", g[2:]), ("2", g[2:4])))
        return c

    models = [counts(lambda i: i in targets), counts(lambda i: True)]
    for k, (i, _) in enumerate(rows):
        loss = []
        for c in models:
            total = 0.0
            for g in grams[k]:
                p3 = (c["3", g[2:]] + strength / 256) / (c["2", g[2:4]] + strength)
                total -= math.log((c["5", g] + strength * p3) / (c["4", g[:4]] + strength))
            loss.append(total / len(grams[k]) if grams[k] else 0.0)
        out.append((i, len(grams[k]), *loss, loss[1] - loss[0]))
    return out


def test_lm_scores(spark):
    draw = random.Random(3)
    rows = EDGES[:6] + [(10 + i, " ".join(draw.choices(("alpha", "beta", "gamma", "ñandú", "\n"), k=draw.randrange(30)))) for i in range(60)]
    targets = {i for i, _ in rows if i is not None and i % 3 == 0}
    marks = spark.createDataFrame([(i,) for i in targets] * 2 + [(None,), (9999,)], "doc_id long")
    want = sorted(plain_scores(rows, targets, 4.0), key=repr)
    for size in (1 << 20, 200):  # one block and many
        n = lm.block_count
        lm.block_count = lambda docs, col, size=size: n(docs, col, size)
        try:
            got = sorted(map(tuple, lm.cross_entropy_difference(table(spark, rows), marks).collect()), key=repr)
        finally:
            lm.block_count = n
        for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
            assert a[:2] == b[:2] and np.allclose(a[2:], b[2:])
    assert lm.cross_entropy_difference(table(spark, []), marks).collect() == []
    assert len(lm.cross_entropy_difference(table(spark, rows), marks.where("false")).collect()) == len(rows)


def test_lm_prefers_the_target(spark):
    rows = [(i, "good clean prose here " * 5) for i in range(20)] + [(100 + i, "xq zz%% kkj " * 9) for i in range(20)]
    marks = spark.createDataFrame([(i,) for i in range(10)], "doc_id long")
    got = {r.doc_id: r.score for r in lm.cross_entropy_difference(table(spark, rows), marks).collect()}
    assert min(got[i] for i in range(20)) > max(got[100 + i] for i in range(20)) + 1


def plain_tiles(doc, item, least):
    """Greedy string tiling by comparing all places."""
    marked_d, marked_i, total = set(), set(), 0
    while True:
        best, found = least, []
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while (a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]
                       and a + n not in marked_d and b + n not in marked_i):
                    n += 1
                if n > best:
                    best, found = n, [(a, b)]
                elif n == best:
                    found.append((a, b))
        if not found:
            return total
        for a, b in sorted(found):
            if all(a + k not in marked_d and b + k not in marked_i for k in range(best)):
                marked_d |= set(range(a, a + best))
                marked_i |= set(range(b, b + best))
                total += best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=16), st.integers(2, 4))
def test_tiles_equal_plain_greedy_tiling(doc, item, least):
    items = decontaminate.Items([0], [np.array(item, np.uint64) + np.uint64(7)], least)
    got = decontaminate.covered(np.array(doc, np.uint64) + np.uint64(7), items)
    assert sum(n for _, n, _, _ in got) == plain_tiles(doc, item, min(least, len(item)))


ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, "red green blue"), (3, None), (4, ""), (5, "a b c d e f g h i j k l")]
LEAKY = [
    (1, "before one two three four five six seven eight nine ten after"), (2, "six seven eight nine ten ONE two, three four five"),
    (3, "one two three four"), (4, "red green blue"), (5, None), (6, ""), (None, "x red green blue"), (7, "red green"),
    (8, "a b c d e f"), (9, "a b c d e x g h i j"), (9, "a b c d e x g h i j"), (10, "word " * 50_000 + "a b c d e f g h i j k l"),
]


def test_coverage(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for words in (1 << 20, 4):  # one block and several
        got = decontaminate.coverage(table(spark, LEAKY), items, block_words=words)
        assert sorted(got.columns) == sorted(set(DOCS.replace(",", "").split()[::2]))
        leaks = {r.doc_id: sorted((x.item_id, x.covered) for x in r.leaks) for r in got.collect()}
        assert leaks == {1: [(1, 10)], 2: [(1, 10)], 3: [], 4: [(2, 3)], 5: [], 6: [], None: [(2, 3)], 7: [], 8: [(5, 6)],
                         9: [], 10: [(5, 12)]}
    clean = decontaminate.without_leaks(table(spark, LEAKY).drop("leaks"), items)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 5, 6, 7, 9, 9]
    assert decontaminate.coverage(table(spark, []), items).collect() == []
    assert all(r.leaks == [] for r in decontaminate.coverage(table(spark, LEAKY), items.where("false")).collect())
