"""License scan: an exact set-similarity join of text blocks with license templates, in DataFrame functions only.

Blocks are lines, and windows of words that run over line breaks: twice the longest
template, from every half window on, so that a passage as long as a template
lies in one of them wherever its lines end.
A block matches a template when it holds at least ``threshold`` of the
template's distinct words.  The join never compares every block with every
template:

* a block is reduced to its words that occur in any template, and blocks that
  are then shorter than the shortest requirement leave (length filter);
* the remaining words get one global order, rarest first, from their counts
  over all remaining blocks of all documents;
* blocks and templates join on equal words of their prefixes: n - c + 1 words
  of n, where c words have to be common (prefix filter);
* a pair stays if the words behind both places can still reach c (positional filter);
* the common words of the pairs left are counted.

All filters are exact, so every block over the threshold is found.  The
templates are a parameter; only they, their index and their words' counts are
held by the driver.

Beside the labels of the matched templates the scan gives the places of fixed
base phrases, counted in words from 0 (overlapping places count).

Defined results: a null text counts as empty and has no words and labels ''; repeated rows
are scanned one by one; extra columns are not read; a window beside a line that
matches the same template is part of that line's match, and neighbouring windows
that match the same template count as one block.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscope.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this work has been dedicated to the public domain"),
    ("no-reproduction", "no part of this publication may be reproduced without prior written permission"),
)


def lowered(text: Column) -> Column:
    """ASCII lower case; other letters stay as they are."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def required(n: int, threshold: float) -> int:
    """Least number of common words for a template of ``n`` distinct words."""
    return max(1, math.ceil(n * threshold - 1e-9))


def _places(phrase: str) -> Column:
    """Starts of ``phrase`` in the array ``words``; the places are looked up only where the phrase occurs."""
    parts = phrase.split(" ")
    words = F.col("words")

    def here(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get(words, i + k) == F.lit(p) for k, p in enumerate(parts)])

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when(F.contains(F.col("joined"), F.lit(f" {phrase} ")), starts).otherwise(F.array().cast("array<int>"))


def half_window(templates: Sequence[tuple[str, str]]) -> int:
    """Words of the longest template."""
    return max((len(words.split(" ")) for _, words in templates), default=1)


def _windows(step: int, vocabulary: Column) -> Column:
    """Windows of the array ``words`` that hold words of several ``lines``, numbered -1, -2, ... in order."""
    words, line_of = F.col("words"), F.col("line_of")
    n = F.size(words)

    def window(k: Column) -> Column:
        start = k * step
        return F.struct(
            (-1 - k).alias("block"), F.get(line_of, start).alias("from"),
            F.get(line_of, F.least(start + 2 * step, n) - 1).alias("to"),
            F.array_intersect(F.slice(words, start + 1, F.lit(2 * step)), vocabulary).alias("words"))

    last = F.greatest(F.ceil(n / step).cast("int") - 2, F.lit(0))
    wraps = lambda k: F.get(line_of, k * step) < F.get(line_of, F.least((k + 2) * step, n) - 1)
    return F.transform(F.filter(F.sequence(F.lit(0), last), wraps), window)


def _once(matches: DataFrame) -> DataFrame:
    """Matches of windows without those beside a matched line; neighbours get the first one's number."""
    same = Window.partitionBy("uid", "template")
    lines = F.collect_set(F.when(F.col("block") >= 0, F.col("block"))).over(same)
    beside = F.exists("lines", lambda x: x.between(F.col("from"), F.col("to")))
    kept = matches.withColumn("lines", lines).where((F.col("block") >= 0) | ~beside)
    kept = kept.withColumn("window", F.col("block") < 0)
    place = F.row_number().over(Window.partitionBy("uid", "template", "window").orderBy(F.desc("block")))
    run = kept.withColumn("run", F.col("block") + place)
    first = F.max("block").over(Window.partitionBy("uid", "template", "window", "run"))
    return run.withColumn("block", F.when(F.col("window"), first).otherwise(F.col("block")))


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
    threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, matches).

    documents: uid, id, n_words, places (of all base phrases), base (their labels).
    matches: uid, block (line from 0, or below 0 a window), label, template, common, containment.
    """
    spark = docs.sparkSession
    sets = [(label, list(dict.fromkeys(words.split(" ")))) for label, words in templates]
    needs = [required(len(words), threshold) for _, words in sets]
    vocabulary = F.array(*[F.lit(w) for w in dict.fromkeys(w for _, words in sets for w in words)])

    lines = F.transform(F.split(lowered(F.col(text_col)), "\n"), lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0)))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), lines.alias("lines"))
    known = F.transform("lines", lambda x, i: F.struct(
        i.alias("block"), i.alias("from"), i.alias("to"), F.array_intersect(x, vocabulary).alias("words")))
    line_of = F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.size(x))))
    rows = rows.select("uid", "id", F.flatten("lines").alias("words"), known.alias("known"), line_of.alias("line_of"))
    rows = rows.withColumn("known", F.concat("known", _windows(half_window(templates), vocabulary)))
    rows = rows.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    found = F.filter("known", lambda b: F.size(b.words) >= min(needs, default=1))
    places = {label: _places(phrase) for phrase, label in phrases.items()}
    stored = materialize(rows.select(
        "uid", "id", F.size("words").cast("long").alias("n_words"), found.alias("blocks"),
        F.struct(*[p.alias(f"p{k}") for k, p in enumerate(places.values())]).alias("at")))
    at = [F.col("at")[f"p{k}"] for k in range(len(places))]
    documents = stored.select(
        "uid", "id", "n_words", F.concat(*at).alias("places"),
        F.array_compact(F.array(*[F.when(F.size(a) > 0, F.lit(x)) for a, x in zip(at, places, strict=True)])).alias("base"))

    blocks = stored.select("uid", F.explode("blocks").alias("b")).select("uid", "b.*")
    counts = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect())  # template words only
    order = sorted({w for _, words in sets for w in words}, key=lambda w: (counts.get(w, 0), w))
    place = {w: i + 1 for i, w in enumerate(order)}
    index = []
    for k, ((label, words), need) in enumerate(zip(sets, needs, strict=True)):
        ranks = sorted(place[w] for w in words)
        index += [(k, label, r, i, need, ranks) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    index = spark.createDataFrame(index, "template int, label string, rank int, i int, need int, t_ranks array<int>")

    ranks = F.array_sort(F.transform("words", lambda w: F.array_position(F.array(*map(F.lit, order)), w).cast("int")))
    ranked = blocks.select("uid", "block", "from", "to", ranks.alias("ranks"))
    prefix = F.slice("ranks", F.lit(1), F.size("ranks") - min(needs, default=1) + 1)
    seeds = ranked.select("uid", "block", "from", "to", "ranks", F.posexplode(prefix).alias("j", "rank"))
    rest = F.least(F.size("ranks") - F.col("j"), F.size("t_ranks") - F.col("i"))
    pairs = seeds.join(index, "rank").where((F.size("ranks") >= F.col("need")) & (rest >= F.col("need")))
    common = F.size(F.array_intersect("ranks", "t_ranks"))
    matches = (
        pairs.withColumn("common", common).where(F.col("common") >= F.col("need"))
        .withColumn("containment", F.col("common") / F.size("t_ranks"))
        .select("uid", "block", "from", "to", "label", "template", "common", "containment").distinct()
    )
    return documents, _once(matches).select("uid", "block", "label", "template", "common", "containment")


def license_report(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
    threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: word and place counts, base labels, all labels, matched blocks and a score.

    The score is 1 where a base phrase stands, else the best containment of a matched block, else 0.
    """
    documents, matches = scan(docs, templates, phrases, threshold, id_col, text_col)
    best = matches.groupBy("uid").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"),
        F.countDistinct("block").alias("n_blocks"))
    return documents.join(best, "uid", "left").select(
        F.col("id").alias(id_col), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )


def report_sql(
    templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES, threshold: float = 0.9,
) -> str:
    """The report as DuckDB SQL: every line and window against every template."""
    def listed(words: Sequence[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    rows = []
    for number, (label, words) in enumerate(templates):
        distinct = list(dict.fromkeys(words.split(" ")))
        rows.append(f"({number}, '{label}', {listed(distinct)}, {len(distinct)}, {required(len(distinct), threshold)})")
    step = half_window(templates)
    starts = []
    for phrase, label in phrases.items():
        parts = phrase.split(" ")
        test = " AND ".join(f"words[i + {k}] = '{p}'" for k, p in enumerate(parts, 1))
        starts.append(f"list_transform(list_filter(range(len(words)), lambda i: {test}), lambda i: {{'p': i, 'label': '{label}'}})")
    places = f"list_concat({starts[0]}, list_concat({starts[1]}, {starts[2]}))"
    return rf"""
    WITH templates(template, label, t, n, need) AS (VALUES {", ".join(rows)}),
    lowered AS (
      SELECT row_number() OVER () AS uid, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents
    ), lined AS (
      SELECT uid, doc_id, list_transform(string_split(text, chr(10)), lambda x: regexp_extract_all(x, '{WORD}')) AS lines FROM lowered
    ), worded AS (
      SELECT uid, doc_id, lines, flatten(lines) AS words,
             flatten(list_transform(lines, lambda x, i: list_transform(x, lambda w: i - 1))) AS line_of
      FROM lined
    ), based AS (
      SELECT uid, doc_id, len(words) AS n_words, {places} AS places FROM worded
    ), stepped AS (
      SELECT uid, words, line_of, len(words) AS n,
             unnest(range(greatest(CAST(ceil(len(words) / {step}) AS BIGINT) - 2, 0) + 1)) AS k
      FROM worded
    ), blocks AS (
      SELECT uid, block, block AS since, block AS until, words
      FROM (SELECT uid, unnest(lines) AS words, generate_subscripts(lines, 1) - 1 AS block FROM worded)
      UNION ALL
      SELECT uid, -1 - k, line_of[k * {step} + 1] AS since, line_of[least((k + 2) * {step}, n)] AS until,
             words[k * {step} + 1 : (k + 2) * {step}]
      FROM stepped WHERE since < until
    ), matched AS (
      SELECT * FROM (
        SELECT uid, block, since, until, template, label, len(list_intersect(list_distinct(words), t)) AS common, n, need
        FROM blocks, templates)
      WHERE common >= need
    ), kept AS (
      SELECT *, block + row_number() OVER (PARTITION BY uid, template, block < 0 ORDER BY block DESC) AS run
      FROM matched AS m
      WHERE block >= 0 OR NOT EXISTS (
        SELECT 1 FROM matched AS l
        WHERE l.uid = m.uid AND l.template = m.template AND l.block >= 0 AND l.block BETWEEN m.since AND m.until)
    ), counted AS (
      SELECT uid, label, common, n,
             CASE WHEN block < 0 THEN max(block) OVER (PARTITION BY uid, template, block < 0, run) ELSE block END AS block
      FROM kept
    ), best AS (
      SELECT uid, list(DISTINCT label) AS more, max(CAST(common AS DOUBLE) / n) AS best, count(DISTINCT block) AS n_blocks
      FROM counted GROUP BY uid
    )
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
           CAST(list_min(list_transform(places, lambda x: x.p)) AS BIGINT) AS first_word,
           CAST(list_max(list_transform(places, lambda x: x.p)) AS BIGINT) AS last_word,
           coalesce(array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label))), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda x: x.label), coalesce(more, [])))), ','), '') AS labels,
           CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score,
           coalesce(n_blocks, 0) AS n_blocks
    FROM based LEFT JOIN best USING (uid)
    """
