"""Result types both engines agree on."""

from __future__ import annotations

from pyspark.sql import functions as F


def tidy(df, digits: int = 6):
    """Doubles rounded, integers as 64 bits, dates as text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), digits)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind in ("date", "timestamp"):
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)


def dbl(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}::DOUBLE, {digits}) AS {n}" for n in names)


def big(*names: str) -> str:
    return ", ".join(f"{n}::BIGINT AS {n}" for n in names)
