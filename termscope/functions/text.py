"""Column functions on text: cleaning, lexicon sentiment, sentences, codes."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from termscope import defaults as D


# White space but the blank, as Unicode and the four separators of ASCII have it.
_OTHER_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def clean_text(col: Column) -> Column:
    """Collapse runs of (Unicode) white space to one blank and trim; null gives ''.

    Single blanks, nearly all of the white space there is, are not touched.
    """
    runs = f"[{_OTHER_SPACE}][ {_OTHER_SPACE}]*| [ {_OTHER_SPACE}]+"
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), runs, " "))


def normalize_name(col: Column) -> Column:
    """Turn "Last, First" into "First Last"; other names are only cleaned."""
    name = clean_text(col)
    last = F.trim(F.regexp_extract(name, "^([^,]*),(.*)$", 1))
    first = F.trim(F.regexp_extract(name, "^([^,]*),(.*)$", 2))
    return F.when((first != "") & (last != ""), F.concat_ws(" ", first, last)).otherwise(name)


def null_if(col: Column, mark: str = D.MISSING_MARK) -> Column:
    """Replace the placeholder ``mark`` by null."""
    return F.nullif(col, F.lit(mark))


def tokens(col: Column, pattern: str = D.WORD_PATTERN) -> Column:
    """Lower-case words of a text, in order."""
    return F.regexp_extract_all(F.lower(col), F.lit(pattern), F.lit(0))


def count_in(words: Column, vocabulary: Sequence[str]) -> Column:
    """How many elements of the array ``words`` belong to ``vocabulary``."""
    return F.size(F.filter(words, lambda w: w.isin(*vocabulary)))


def vocabulary_words(col: Column, vocabulary: Sequence[str], pattern: str = D.WORD_PATTERN) -> Column:
    """The words of a text that belong to ``vocabulary``, in order: one scan, which takes out these words alone.

    ``pattern`` is a character class with a plus: a word is a longest run of its characters.
    """
    letters = pattern.removesuffix("+")
    if not re.fullmatch(r"\[[^\]]+\]\+", pattern):
        return F.filter(tokens(col, pattern), lambda w: w.isin(*vocabulary))
    known = [w for w in dict.fromkeys(vocabulary) if re.fullmatch(pattern, w)]
    if not known:
        return F.array().cast("array<string>")
    first = "".join(re.escape(c) for c in sorted({w[0] for w in known}))
    whole = f"(?<!{letters})(?=[{first}])(?:{trie_pattern(known)})(?!{letters})"
    return F.regexp_extract_all(F.lower(col), F.lit(whole), F.lit(0))


def lexicon_hits(col: Column, vocabulary: Sequence[str], pattern: str = D.WORD_PATTERN) -> Column:
    """How many words of a text belong to ``vocabulary``."""
    return F.size(vocabulary_words(col, vocabulary, pattern))


def polarity_score(positive: Column, negative: Column) -> Column:
    """Sentiment in [-1, 1] from the numbers of positive and negative hits."""
    hits = positive + negative
    confidence = F.least(F.lit(1.0), F.log1p(hits) / F.lit(math.log(D.SATURATION_HITS)))
    score = (positive - negative) / hits * confidence
    # greatest and least skip nulls, so zero hits are handled before them.
    return F.when(hits > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))).otherwise(0.0)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body``, like a let expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sentiment(
    col: Column,
    positive: Sequence[str] = D.POSITIVE_WORDS,
    negative: Sequence[str] = D.NEGATIVE_WORDS,
) -> Column:
    """Lexicon sentiment of a text; null for a null or empty text."""
    hits = bind(
        vocabulary_words(col, [*positive, *negative]),
        lambda w: F.struct(count_in(w, positive).alias("p"), count_in(w, negative).alias("n")),
    )
    return F.when(col != "", bind(hits, lambda h: polarity_score(h["p"], h["n"])))


def sentiment_label(score: Column, on_null: str | None = None, cutoff: float = D.LABEL_CUTOFF) -> Column:
    """positive / neutral / negative, or ``on_null`` for a missing score."""
    return (
        F.when(score.isNull(), F.lit(on_null))
        .when(score >= cutoff, "positive")
        .when(score <= -cutoff, "negative")
        .otherwise("neutral")
    )


def sentences(col: Column) -> Column:
    """Sentences of the cleaned text, split after ., ! or ? and white space."""
    parts = F.split(clean_text(col), "(?<=[.!?]) ")  # a cleaned text has no other white space
    return F.filter(parts, lambda s: s != "")


def trie_pattern(terms: Sequence[str]) -> str:
    """A regular expression of the longest term that begins at a place, as a trie of the terms' letters."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict) -> str:
        tails = [re.escape(letter) + written(below) for letter, below in sorted(node.items()) if letter]
        if not tails:
            return ""
        if len(tails) == 1 and "" not in node:
            return tails[0]
        return "(?:" + "|".join(tails) + ")" + ("?" if "" in node else "")

    return written(root)


def term_starts(col: Column, terms: Sequence[str]) -> Column:
    """For every place of ``col`` where a term begins, the longest such term: one scan for all terms.

    The terms that the longest one begins with begin there as well, so this tells
    for each term where it stands, also where terms overlap (see ``begins_with``).
    """
    terms = [t for t in dict.fromkeys(terms) if t]
    first = "".join(re.escape(c) for c in sorted({t[0] for t in terms}))
    return F.regexp_extract_all(col, F.lit(f"(?=[{first}])(?=({trie_pattern(terms)}))"), F.lit(1))


def begins_with(found: Column, terms: Sequence[str], vocabulary: Sequence[str]) -> Column:
    """Whether a term of ``vocabulary`` found by ``term_starts`` begins with one of ``terms``."""
    return found.isin(*[v for v in dict.fromkeys(vocabulary) if any(v.startswith(t) for t in terms)])


def _overlaps_itself(term: str) -> bool:
    return any(term.startswith(term[k:]) for k in range(1, len(term)))


def term_counts(col: Column, groups: Sequence[Sequence[str]]) -> list[Column]:
    """For each group of terms the non-overlapping occurrences of every term, added up (null counts 0).

    All groups share one scan.  A term that can overlap itself ("aa") is counted by itself.
    """
    low = F.lower(F.coalesce(col, F.lit("")))
    simple = [[t for t in group if not _overlaps_itself(t)] for group in groups]
    vocabulary = [t for group in simple for t in group]
    out = []
    if vocabulary:
        def counts(starts: Column) -> Column:
            def one(group: Sequence[str]) -> Column:
                # A longer term that a place begins with counts for each of the group's terms it begins with.
                worth = {v: n for v in dict.fromkeys(vocabulary) if (n := sum(v.startswith(t) for t in group))}
                least = [[v for v, n in worth.items() if n > k] for k in range(max(worth.values(), default=0))]
                return reduce(lambda a, b: a + b, [count_in(starts, some) for some in least], F.lit(0))

            return F.array(*[one(group) for group in simple])

        found = bind(term_starts(low, vocabulary), counts)
        out = [found[k] for k in range(len(groups))]
    else:
        out = [F.lit(0)] * len(groups)
    for k, group in enumerate(groups):
        for term in group:
            if _overlaps_itself(term):
                out[k] = out[k] + F.regexp_count(low, F.lit(re.escape(term)))
    return out


def course_codes(col: Column, pattern: str = D.COURSE_CODE) -> Column:
    """Course codes in the upper-cased text as (subject_id, catalog_nbr) structs."""
    whole = F.regexp_extract_all(F.upper(col), F.lit(pattern), F.lit(0))

    def split(code: Column) -> Column:
        group = [F.regexp_extract(code, pattern, k) for k in (1, 2)]
        return F.struct(group[0].alias("subject_id"), group[1].cast("int").alias("catalog_nbr"))

    return F.transform(whole, split)
