"""Keyed table maintenance on snapshots: upsert, insert-if-absent, replace slice.

All operators return the new snapshot as a DataFrame; the caller writes it.
Updates are reduced to one row per key with aggregates that combine on the map
side, so a key repeated in a third of the updates never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SET, KEEP, OR, PRESENT = "set", "keep", "or", "present"


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], keep: str = "last") -> DataFrame:
    """One row per key: the first or last in ``order_by`` (nulls sort first)."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    order = F.struct(*_ordered(order_by), F.xxhash64(*df.columns))
    row = pick(F.struct(*rest), order) if rest else F.count(F.lit(1))
    picked = df.groupBy(*keys).agg(row.alias("row"))
    return picked.select(*keys, *[F.col("row")[c].alias(c) for c in rest]).select(*df.columns)


def _ordered(order_by: Sequence[str | Column]) -> list[Column]:
    columns = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return [c.alias(f"o{n}") for n, c in enumerate(columns)]


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def fold_updates(
    updates: DataFrame,
    keys: Sequence[str],
    policies: Mapping[str, str],
    order_by: Sequence[str | Column],
    default: str = SET,
) -> DataFrame:
    """Collapse repeated keys of one batch as if its rows were applied in order.

    Each column appears twice: ``first_`` is the value a new row is inserted
    with, ``name`` is what an existing row is updated with.
    """
    order = F.struct(*_ordered(order_by), F.xxhash64(*updates.columns))
    rest = [c for c in updates.columns if c not in keys]
    changed = {c: policies.get(c, default) for c in rest}
    first = F.min_by(F.struct(*rest), order)
    last = F.max_by(F.struct(*rest), order)
    extra = [F.bool_or(c).alias(f"or_{c}") for c in rest if changed[c] == OR]
    # max_by skips rows whose order key is null, so a null value drops out.
    extra += [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"present_{c}")
        for c in rest
        if changed[c] == PRESENT
    ]
    folded = updates.groupBy(*keys).agg(first.alias("f"), last.alias("l"), *extra)

    def insert_value(c: str) -> Column:
        source = {SET: F.col("l")[c], KEEP: F.col("f")[c]}
        return source.get(changed[c], F.col(f"{changed[c]}_{c}"))

    return folded.select(*keys, *[insert_value(c).alias(c) for c in rest])


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    policies: Mapping[str, str] | None = None,
    default: str = SET,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """Insert new keys and update existing ones, column by column.

    Policies: ``set`` overwrites with the last value, ``keep`` retains the
    first value ever loaded, ``or`` merges booleans, ``present`` overwrites
    only with a non-null value.  ``set_cols`` is short for ``set`` on those
    columns and ``keep`` on all others.
    """
    if set_cols is not None:
        policies, default = {c: SET for c in set_cols}, KEEP
    policies = dict(policies or {})
    rest = [c for c in target.columns if c not in keys]
    batch = updates.select(*target.columns, *[c for c in _names(order_by) if c not in target.columns])
    batch = fold_updates(batch, keys, policies, order_by, default).alias("u")
    old, new = F.col("t.known").isNotNull(), F.col("u.fresh").isNotNull()
    joined = (
        target.withColumn("known", F.lit(1))
        .alias("t")
        .join(batch.withColumn("fresh", F.lit(1)).alias("u"), _same_key("t", "u", keys), "full_outer")
    )

    def merged(c: str) -> Column:
        t, u = F.col(f"t.{c}"), F.col(f"u.{c}")
        updated = {SET: u, KEEP: t, OR: u | t, PRESENT: F.coalesce(u, t)}[policies.get(c, default)]
        return F.when(old & new, updated).when(old, t).otherwise(u).alias(c)

    key_cols = [F.coalesce(f"t.{k}", f"u.{k}").alias(k) for k in keys]
    return joined.select(*key_cols, *[merged(c) for c in rest]).select(*target.columns)


def _names(order_by: Sequence[str | Column]) -> list[str]:
    return [c for c in order_by if isinstance(c, str)]


def insert_missing(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Append rows whose key is not in ``target`` yet, one row per key."""
    fresh = dedupe(rows, keys, order_by, keep="first").join(
        target.select(*keys), list(keys), "left_anti"
    )
    return target.unionByName(fresh, allowMissingColumns=True)


def replace_slice(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop every target row of a parent key found in ``rows``, then append ``rows``."""
    parents = rows.select(*keys).distinct()
    return target.join(parents, list(keys), "left_anti").unionByName(rows)


def with_id(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Add a stable surrogate key, the MD5 of the natural key's values.

    Each value is written with its length, and a null as ``-``, so that no two
    keys give the same text; 128 bits leave no collisions to expect.
    """
    def part(key: str) -> Column:
        value = F.col(key).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return df.withColumn(name, F.md5(F.concat_ws(",", *map(part, keys))))


def set_if_present(new: Column, old: Column) -> Column:
    """New value when there is one, else the old value."""
    return F.coalesce(new, old)


def full_refresh(df: DataFrame, path: str) -> None:
    """Empty the table at ``path`` and load ``df``."""
    df.write.mode("overwrite").parquet(path)
