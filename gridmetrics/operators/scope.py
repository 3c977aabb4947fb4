"""Scope, normalisation and selection operators (row-local, no shuffle
except the fixed-size dimension broadcast)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import alias_country_list, to_utc_ts, trim_ws
from ..schema import EU27


def local_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small literal table planned as a LocalRelation (no RDD, no job)."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return repr(v)
    vals = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {vals} AS t({', '.join(names)})")


def eu27_frame(spark: SparkSession) -> DataFrame:
    """The 27-row member dimension (iso2, name)."""
    return local_table(spark, EU27, ["iso2", "name"])


def eu27_keys(spark: SparkSession) -> DataFrame:
    """Dimension unpivoted to 54 lookup keys (ISO2 code or display name)
    -> display name, so scope mapping is one equi-join. Fixed size, so it is
    always safe to broadcast."""
    rows = [(iso, name) for iso, name in EU27] + [(name, name) for _, name in EU27]
    return local_table(spark, rows, ["scope_key", "scope_name"])


def normalize_ts(df: DataFrame, col: str = "ts_utc") -> DataFrame:
    """Parse ``col`` to a UTC timestamp and drop rows that do not parse."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampType):
        parsed = F.col(col)
    elif isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        parsed = F.col(col).cast("timestamp")
    else:
        parsed = to_utc_ts(col)
    return df.withColumn(col, parsed).where(F.col(col).isNotNull())


def eu_scope(df: DataFrame, country_col: str = "country", region: str = "EU") -> DataFrame:
    """Keep EU27 rows whether the country is an ISO2 code or a display name
    (surrounding whitespace ignored), rename codes to display names and set
    the region."""
    spark = df.sparkSession
    keys = F.broadcast(eu27_keys(spark))
    cols = df.columns
    out = (df.join(keys, trim_ws(df[country_col]) == keys["scope_key"], "inner")
             .withColumn(country_col, F.col("scope_name")))
    if "region" in cols:
        out = out.withColumn("region", F.lit(region))
        return out.select(*cols)
    return out.select(*cols, F.lit(region).alias("region"))


def export_scope(df: DataFrame, country_col: str = "country", region: str = "EU") -> DataFrame:
    """Report scope: display names only (codes are dropped), region forced."""
    names = [n for _, n in EU27]
    out = df.where(F.col(country_col).isin(names))
    if "region" in df.columns:
        out = out.withColumn("region", F.lit(region))
    return out


def as_ts(x: Column | str) -> Column:
    return F.to_timestamp(F.lit(x)) if isinstance(x, str) else x


def range_select(df: DataFrame, start: str | None = None, end: str | None = None,
                 countries: Iterable[str] | None = None, ts_col: str = "ts_utc",
                 country_col: str = "country") -> DataFrame:
    """Half-open time range ``[start, end)`` and optional country list."""
    cond: Column = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts_col) >= F.to_timestamp(F.lit(start)))
    if end is not None:
        cond = cond & (F.col(ts_col) < F.to_timestamp(F.lit(end)))
    if countries is not None:
        cond = cond & F.col(country_col).isin(list(countries))
    return df.where(cond)


def alias_countries(df: DataFrame, col: str, out_col: str | None = None,
                    inverse: bool = False) -> DataFrame:
    """Comma list column -> cleaned list with the DE / DE_LU bidding-zone alias."""
    return df.withColumn(out_col or col, alias_country_list(col, inverse=inverse))
