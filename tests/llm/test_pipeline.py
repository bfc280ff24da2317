"""The pipeline on small folders: stages against plain Python, edge rows, registered queries."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
from termscope.llm import queries
from tokenizers import Tokenizer

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, docs, labels=(), benchmark=()):
    for name, rows, kind in (("documents", docs, COLUMNS), ("labels", labels, "doc_id long, quality int, toxic int"),
                             ("benchmark", benchmark, "item_id long, text string")):
        spark.createDataFrame(list(rows), kind).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def corpus():
    draw = random.Random(8)
    syllables = ["ka", "lo", "mi", "ten", "ra", "su", "del", "vo", "ni", "par"]
    docs, labels = [], []
    for i in range(240):
        words = ["".join(draw.choices(syllables, k=3)) for _ in range(60)]
        if i % 4 == 0:
            words[10:10] = ["gribblot"] * 3
        docs.append([i, " ".join(words), "en", f"s{i % 3}", 0])
        labels.append((i, 1, int(i % 4 == 0)))
    item = " ".join("".join(draw.choices(syllables, k=4)) for _ in range(12))
    docs[5][1] += " " + item
    docs += [[300, docs[1][1], "en", "s1", 0], [301, docs[2][1].upper(), "en", "s2", 0], [302, docs[3][1] + " end", "en", "s0", 0]]
    return docs, labels, [(1, item)]


def test_run(spark, tmp_path):
    docs, labels, benchmark = corpus()
    got = corpus_pipeline.run(spark, write(spark, tmp_path, docs, labels, benchmark)).orderBy("start").collect()
    kept = {i for i in range(240) if i % 4 and i != 5}
    assert {r.doc_id for r in got} <= kept and {r.doc_id for r in got if r.doc_id % 3 == 0} == {i for i in kept if i % 3 == 0}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {d[0]: d[1] for d in docs}
    start = 0
    for r in got:
        assert r.start == start and r.tokens == library.encode(text[r.doc_id], add_special_tokens=False).ids + [2]
        start += r.n_tokens
    # sources s0, s1, s2 share 5 : 2 : 1 of all words, up to three times their own
    words = Counter(f"s{i % 3}" for i in kept)
    times = Counter(f"s{r.doc_id % 3}" for r in got)
    total = sum(words.values())
    for name, weight in (("s0", 5), ("s1", 2), ("s2", 1)):
        assert abs(times[name] - total * weight / 8) <= 1
    assert max(Counter(r.doc_id for r in got).values()) <= 3


def test_stages_keep_columns_and_edge_rows(spark, tmp_path):
    docs, labels, benchmark = corpus()
    docs = docs[:60] + [[400, None, None, None, None], [401, "", "en", "s1", 0], [None, "no id", "en", "s1", 5], [402, "word " * 30_000, "en", "s2", 1],
                        [403, "twice", "en", "s0", 5], [403, "twice", "en", "s0", 5]]
    folder = write(spark, tmp_path, docs, labels, benchmark)
    rows = spark.createDataFrame([(*d, "x", 1.5, 7, "t", 0) for d in docs], COLUMNS + ", _th string, score double, size int, target string, leaks int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, folder)
        assert out.columns == rows.columns, name
        if name != "mixing":
            assert {400, 401, None, 402, 403} <= {r.doc_id for r in out.collect()}, name


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [])).collect() == []


def test_queries_are_registered():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
    assert set(queries.ORACLES) <= set(queries.QUERIES)
