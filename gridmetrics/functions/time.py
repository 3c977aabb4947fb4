"""Time-bucket column expressions (all UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LEVELS

_STEP_SQL = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY",
             "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}


def check_level(level: str) -> str:
    lv = (level or "").strip().lower()
    if lv not in LEVELS:
        raise ValueError(f"Invalid agg level: {lv}")
    return lv


def resolve_level(mode: str = "eu", override: str | None = None, defaults: dict | None = None) -> str:
    """Default ``day`` for EU runs and ``month`` for global runs; an override wins."""
    from ..schema import DEFAULT_LEVEL
    table = dict(DEFAULT_LEVEL)
    table.update(defaults or {})
    return check_level(override or table.get(mode, "day"))


def step(level: str) -> Column:
    return F.expr(_STEP_SQL[check_level(level)])


def bucket_start(ts: Column | str, level: str) -> Column:
    """Bucket label of a timestamp.

    hour/day/month buckets are left-closed and labelled by their start.
    Weeks end on Monday: Tuesday 00:00 .. Monday 23:59:59 carries the label
    of that Monday 00:00.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    lv = check_level(level)
    if lv == "week":
        return F.date_trunc("week", ts - F.expr("INTERVAL 1 DAY")) + F.expr("INTERVAL 7 DAYS")
    return F.date_trunc(lv, ts)


def expected_points(bucket: Column | str, level: str) -> Column:
    """Hourly points a complete bucket holds (hourly source assumed)."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    lv = check_level(level)
    if lv == "hour":
        return F.lit(1).cast("long")
    if lv == "day":
        return F.lit(24).cast("long")
    if lv == "week":
        return F.lit(168).cast("long")
    d = F.to_date(b)
    return (F.datediff(F.add_months(d, 1), d) * 24).cast("long")


def iso_z(ts: Column | str) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` text of a UTC timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_utc_ts(c: Column | str) -> Column:
    """Parse text (ISO-8601, optional Z/offset) or pass timestamps through;
    anything unparsable becomes NULL rather than failing the job."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_to_timestamp(c.cast("string")),
                      F.try_to_timestamp(c.cast("string"), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


def ts_of(df, name: str) -> Column:
    """Timestamp view of column ``name`` of ``df``: timestamps pass through,
    zone-less timestamps and dates are read as UTC, text is parsed leniently."""
    from pyspark.sql import types as T
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    return to_utc_ts(c)


STEP_MICROS = {"hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def _month_index(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def steps_between(start: Column, end: Column, level: str) -> Column:
    """Number of grid points ``start + k*step`` (k >= 0) that lie before ``end``
    (0 when ``end <= start``). Month grids assume ``start`` is a month start."""
    lv = check_level(level)
    if lv == "month":
        n = (_month_index(end) - _month_index(start)
             + F.when(end > F.date_trunc("month", end), 1).otherwise(0))
        return F.greatest(n, F.lit(0)).cast("long")
    us = STEP_MICROS[lv]
    span = F.unix_micros(end) - F.unix_micros(start)
    return F.when(span > 0, F.floor((span + F.lit(us - 1)) / F.lit(us))).otherwise(0).cast("long")


def nth_step(start: Column, i: Column, level: str) -> Column:
    """``start`` advanced by ``i`` steps (exact microsecond / calendar-month arithmetic)."""
    lv = check_level(level)
    if lv == "month":
        return F.add_months(F.to_date(start), i.cast("int")).cast("timestamp")
    return F.timestamp_micros(F.unix_micros(start) + i * F.lit(STEP_MICROS[lv]))


def chunked_range(n: Column, chunk: int) -> tuple[Column, Column, Column]:
    """Generator pieces for ``0 .. n-1`` in chunks of at most ``chunk``: the
    outer ``explode`` yields chunk ids; the inner sequence for chunk ``c`` is
    ``lo(c) .. hi(c)``, so no single array exceeds ``chunk`` elements."""
    ids = F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.ceil(n / F.lit(chunk)) - 1)) \
           .otherwise(F.array().cast("array<bigint>"))
    lo = lambda c: c * F.lit(chunk)
    hi = lambda c: F.least(c * F.lit(chunk) + F.lit(chunk), n) - 1
    return ids, lo, hi
