"""URL filters: rules on a host and a path prefix, met with all urls by a sorted sweep.

A rule (host, path) fits its host and all subdomains where the url's path starts
with the rule's.  Host labels are reversed, so that the rule is one prefix of the
canonical key ``org.example//path`` and hence the interval of bytes from that
prefix up to the prefix followed by 0xFF.  A url has one key per number of labels
that rule hosts have (its own host cut to so many labels, then its path), cut to
the longest rule's length, and pages that agree in these keys are asked for once.

Two sweeps run over keys in byte order, in chunks dealt by range:

* over the starts and ends of rules; the running sum of +1 and -1 is a rule's level of nesting
* over rules and urls; the last rule of every level is the stack.  Entries whose
  interval has ended do not begin the url's key and are passed over.

The sweeps' state is carried over the chunks' borders by one row per chunk and
level.  Range borders take a hash besides the key, so a key that a third of all
rows share spreads over chunks.  Of the rules that fit, the longest (host and path)
wins, and of equally long ones that with the longer host.

Defined results: the host reaches from the first ``://`` to ``/``, ``?``, ``#`` or
the end, A-Z in lower case, the path from there to ``?``, ``#`` or the end; without
``://``, or for a null url, both are empty.  No rule: ``rule`` is null, the verdict
``default``.  Of rules with equal host and path ``block`` counts.  Rules without
host, or with ``/``, ``?`` or ``#`` in it, fit no url; a null path is empty and fits
all.  Repeated pages are answered each; null ids stay; long urls are read whole,
only keys are cut; without rules or pages the tables' schema stays.  Extra columns,
whatever their names, are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscope.session import materialize

_CLOSE, _OPEN, _ASK = 0, 1, 2  # in this order where keys are equal: intervals do not hold their ends


def lower_ascii(col: Column) -> Column:
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def clean_rules(rules: DataFrame) -> DataFrame:
    """(key, labels, rule, host_length, verdict) of every distinct rule that can fit a url; reads host, path, verdict."""
    host, path = lower_ascii(F.col("host")), F.coalesce("path", F.lit(""))
    named = rules.where("host != ''").where(~F.col("host").rlike("[/?#]")).select(
        _key(_labels(host), path).alias("key"), F.size(_labels(host)).alias("labels"),
        F.concat(host, path).alias("rule"), F.length(host).alias("host_length"), "verdict")
    return named.groupBy("key", "labels", "rule", "host_length").agg(F.max("verdict").alias("verdict"))


def _in_chunks(events: DataFrame) -> DataFrame:
    """Events in ranges of (at, kind, salt), with the number of the range; written, since ranges are drawn anew each time."""
    return materialize(events.repartitionByRange("at", "kind", "salt").withColumn("chunk", F.spark_partition_id()))


def _running() -> Window:
    return Window.partitionBy("chunk").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier() -> Window:
    """All chunks before; over as many rows as there are chunks."""
    return Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)


def _before_all() -> Column:
    return F.lit(b"").alias("at")


def nested(rules: DataFrame) -> DataFrame:
    """Rules with their ``level``: 1, and 1 more for every rule whose interval holds theirs."""
    start = F.encode("key", "UTF-8")
    rule = F.struct("key", "rule", "host_length", "verdict").alias("rule")
    events = rules.select(start.alias("at"), F.lit(_OPEN).alias("kind"), F.lit(1).alias("step"), rule).unionAll(
        rules.select(F.concat(start, F.lit(b"\xff")), F.lit(_CLOSE), F.lit(-1), F.lit(None).cast(rules.select(rule).schema[0].dataType)))
    dealt = _in_chunks(events.withColumn("salt", F.lit(0)))
    steps = dealt.groupBy("chunk").agg(F.sum("step").alias("step"))
    carry = steps.select("chunk", F.coalesce(F.sum("step").over(_earlier()), F.lit(0)).alias("step"))
    both = dealt.select("chunk", "at", "kind", "step", "rule").unionByName(
        carry.select("chunk", _before_all(), F.lit(_CLOSE).alias("kind"), "step"), allowMissingColumns=True)
    swept = both.withColumn("level", F.sum("step").over(_running()).cast("int"))
    return swept.where("rule is not null").select("at", "rule", "level")


def _stacks(rules: DataFrame, asked: DataFrame, levels: int) -> DataFrame:
    """(heads, fitting): for every asked key the rules of the sweep's stack that begin it."""
    none = F.lit(None)
    rule_type = rules.schema["rule"].dataType
    opens = rules.select("at", F.lit(_OPEN).alias("kind"), F.lit(0).cast("long").alias("salt"), "level", "rule",
                         none.cast("string").alias("head"), none.cast("array<string>").alias("heads"))
    asks = asked.select(F.explode("heads").alias("head"), "heads").select(
        F.encode("head", "UTF-8").alias("at"), F.lit(_ASK).alias("kind"), F.xxhash64("heads").alias("salt"),
        none.cast("int").alias("level"), none.cast(rule_type).alias("rule"), "head", "heads")
    dealt = _in_chunks(opens.unionAll(asks))
    last = {k: F.max(F.when(F.col("level") == k, F.struct("at", "rule"))).alias(f"top{k}") for k in range(1, levels + 1)}
    tops = dealt.groupBy("chunk").agg(*last.values())
    kept = [F.last(f"top{k}", ignorenulls=True).over(_earlier()).alias(f"top{k}") for k in last]
    carry = tops.select("chunk", *kept).select(
        "chunk", F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.col(f"top{k}.rule").alias("rule")) for k in last])).alias("x"))
    carry = carry.where("x.rule is not null").select("chunk", _before_all(), F.lit(_OPEN).alias("kind"), "x.level", "x.rule")
    both = dealt.drop("salt").unionByName(carry, allowMissingColumns=True)
    stack = F.array(*[F.last(F.when(F.col("level") == k, F.col("rule")), ignorenulls=True).over(_running()) for k in last])
    swept = both.select("kind", "head", "heads", stack.alias("stack")).where(F.col("kind") == _ASK)
    fits = F.filter("stack", lambda r: r.isNotNull() & F.startswith(F.col("head"), r["key"]))
    return swept.select("heads", fits.alias("fitting"))


def verdicts(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule (the longest that fits), verdict, n_rules (all that fit).

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``).
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    known = nested(clean_rules(rules))
    known = materialize(known)
    # One row: the numbers of labels are as many as the longest rule host's labels at most.
    labels = F.size(F.split(F.element_at(F.split("rule.key", "/"), 1), r"\."))
    longest, depths, levels = known.agg(
        F.max(F.length("rule.key")), F.array_sort(F.collect_set(labels)), F.max("level")).first()
    if not levels:
        found = rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
                            F.lit(0).cast("long").alias("n_rules"))
        return found.withColumnRenamed("id", id_col)
    own = _labels(F.col("host"))
    cut = F.transform(
        F.filter(F.array(*map(F.lit, depths)), lambda d: d <= F.size(own)),
        lambda d: F.left(_key(F.slice(own, F.lit(1), d), F.left("path", F.lit(longest))), F.lit(longest)))
    rows = rows.withColumn("heads", cut)
    rank = F.transform("fitting", lambda r: F.struct(
        F.length(r["rule"]).alias("length"), r["host_length"].alias("host_length"), r["rule"].alias("rule"),
        r["verdict"].alias("verdict")))
    answers = _stacks(known, rows.select("heads").distinct(), levels).groupBy("heads").agg(
        F.max(F.array_max(rank)).alias("best"), F.sum(F.size("fitting").cast("long")).alias("n_rules"))
    return rows.join(answers, "heads", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"), F.coalesce("n_rules", F.lit(0)).alias("n_rules"))
