"""Column functions on terms, course numbers, clock times and seat counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termscope import defaults as D


def digits_to_int(col: Column) -> Column:
    """Integer value of an all-digit text, else null ("3" but not "3.0")."""
    return F.when(col.rlike("^[0-9]+$"), col.try_cast("int"))


def season(term: Column) -> Column:
    """Season name from the last character of a term code."""
    last = F.right(term, F.lit(1))
    return (
        F.when(last == "2", "spring")
        .when(last == "6", "summer")
        .when(last == "8", "fall")
        .otherwise("other")
    )


def term_label(term: Column, semesters: dict[str, str] = D.TERM_SEMESTERS) -> Column:
    """Display label such as "Fall 2024"; codes that are not 4 digits stay as they are."""
    last = F.right(term, F.lit(1))
    name = F.lit("Unknown")
    for digit, semester in semesters.items():
        name = F.when(last == digit, semester).otherwise(name)
    label = F.concat(name, F.lit(" 20"), F.substring(term, 2, 2))
    return F.when(term.rlike("^[0-9]{4}$"), label).otherwise(term)


def term_numeric(term: Column) -> Column:
    """Term code as an integer."""
    return term.cast("int")


def level_band(number: Column) -> Column:
    """1000, 2000, 3000 or 4000 for course numbers in those bands, else null."""
    return F.when(number.between(1000, 4999), F.floor(number / 1000).cast("int") * 1000)


def level_floor(number: Column) -> Column:
    """Course number rounded down to thousands; 0 when it is not a number."""
    value = F.coalesce(number.try_cast("int"), F.lit(0))
    return (F.floor(value / 1000) * 1000).cast("int")


def safe_ratio(numerator: Column, capacity: Column) -> Column:
    """numerator / capacity as double, null unless the capacity is positive."""
    return F.when(capacity > 0, numerator.cast("double") / capacity)


def filled_flag(seats: Column, capacity: Column, waitlist: Column) -> Column:
    """1 when the section is full or has a waitlist, else 0 (also when unknown)."""
    return F.when((seats >= capacity) | (waitlist > 0), 1).otherwise(0)


def day_count(days: Column) -> Column:
    """Number of weekday letters in a day string; null gives 0."""
    return F.coalesce(F.length(F.regexp_replace(days, "[^MTWRFSU]", "")), F.lit(0))


def is_tba(start: Column) -> Column:
    """1 when the start time is the unknown marker, else 0."""
    return F.when(start == D.UNKNOWN_MEETING, 1).otherwise(0)


def clock_minutes(col: Column) -> Column:
    """Minutes after midnight of a clock text; null when blank, TBA or unreadable."""
    text = F.upper(F.trim(col))
    parsed = F.coalesce(
        *[F.try_to_timestamp(text, F.lit(f)) for f in ("h:mma", "h:mm a", "H:mm", "H:mm:ss")]
    )
    return F.hour(parsed) * 60 + F.minute(parsed)


def seats_open(capacity: Column, seats: Column) -> Column:
    """Free seats, never negative."""
    free = F.coalesce(capacity, F.lit(0)) - F.coalesce(seats, F.lit(0))
    return F.greatest(free, F.lit(0))


def clip(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to [low, high]; null stays null."""
    out = col
    if low is not None:
        out = F.when(out < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(high)).otherwise(out)
    return out


def sigmoid(col: Column, limit: float | None = D.SIGMOID_CLIP) -> Column:
    """Logistic function; the argument is clipped to +-limit unless limit is None."""
    x = col if limit is None else clip(col, -limit, limit)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(col: Column, margin: float = D.LOGIT_CLIP) -> Column:
    """Log odds of a probability clipped to [margin, 1 - margin]."""
    p = clip(col, margin, 1 - margin)
    return F.log(p / (F.lit(1.0) - p))
