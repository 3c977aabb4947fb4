"""Column-expression building blocks (JVM-side, codegen friendly; no UDFs)."""

from .numeric import nan_to_null, round_half_even, safe_div, to_double
from .text import (absolutize, alias_country_list, extract_link, fuel_bucket, metric_bucket,
                   norm_text, rule_bucket, source_bucket, trim_ws)
from .time import (bucket_start, check_level, expected_points, iso_z, resolve_level, step,
                   to_utc_ts, ts_of)

__all__ = [
    "absolutize", "alias_country_list", "bucket_start", "check_level", "expected_points",
    "extract_link", "fuel_bucket", "iso_z", "metric_bucket", "nan_to_null", "norm_text",
    "resolve_level", "round_half_even", "rule_bucket", "safe_div", "source_bucket", "step",
    "to_double", "to_utc_ts", "trim_ws", "ts_of",
]
