"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """Spark keeps NaN apart from NULL; the data model has only NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double(c: Column) -> Column:
    """Lenient numeric parse: bad text -> NULL (ANSI mode would raise)."""
    return nan_to_null(c.cast("string").try_cast("double"))


def safe_div(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


def round_half_even(c: Column, scale: int = 2) -> Column:
    """Half-even rounding the way numeric libraries do it: scale by 10^s,
    ``rint`` (ties to even) on the binary product, unscale. ``bround`` would
    round the shortest decimal text of the value instead, which differs on
    values whose scaled product is not what their text suggests."""
    f = float(10 ** scale)
    return F.rint(c * F.lit(f)) / F.lit(f)
