"""Small column expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def clean_label(c: Column) -> Column:
    """Trimmed, lower case, with blanks and hyphens as underscores."""
    return F.regexp_replace(F.lower(F.trim(c)), "[ \\-]+", "_")


def clean_name(c: Column) -> Column:
    return F.lower(F.trim(c))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.try_divide(dot(a, b), norm)


def clip(c: Column, low: float, high: float) -> Column:
    """Into [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def stable_bucket(c: Column, n: int) -> Column:
    """An int below n from the first 8 hex digits of md5."""
    return (F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint") % n).cast("int")
