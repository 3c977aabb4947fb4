"""Text and rule column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FUEL_RULES, GERMANY_ALIAS, METRIC_RULES, SOURCE_RULES


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every code point that counts as whitespace (tabs, line breaks, no-break and
# typographic spaces, ...), derived by rule rather than listed by hand.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def trim_ws(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of any kind (not only blanks).
    A character-set trim: no regex evaluation per row."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def norm_text(c: Column | str) -> Column:
    return F.lower(trim_ws(col_(c).cast("string")))


def fuel_bucket(fuel: Column | str) -> Column:
    """Fuel-type name -> energy_source; later rules override earlier ones."""
    f = F.lower(col_(fuel).cast("string"))
    expr = F.lit("all")
    for bucket, pattern in FUEL_RULES:
        expr = F.when(F.coalesce(f.rlike(pattern), F.lit(False)), F.lit(bucket)).otherwise(expr)
    return expr


def rule_bucket(text: Column | str, rules=SOURCE_RULES, default: str = "all") -> Column:
    """First rule whose any substring occurs in ``text`` wins."""
    t = col_(text)
    expr = F.lit(default)
    for bucket, words in reversed(list(rules)):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.coalesce(t.contains(w.lower()), F.lit(False))
        expr = F.when(hit, F.lit(bucket)).otherwise(expr)
    return expr


def metric_bucket(text: Column | str, rules=METRIC_RULES) -> Column:
    return rule_bucket(text, rules, "other")


def source_bucket(text: Column | str, rules=SOURCE_RULES) -> Column:
    return rule_bucket(text, rules, "all")


def alias_country_list(c: Column | str, inverse: bool = False, sep: str = ",") -> Column:
    """Comma list -> trimmed, blank-free list with the Germany bidding-zone alias.

    Forward: ``DE`` (any case) -> ``DE_LU``; inverse: ``DE_LU`` -> ``DE``.
    """
    src, dst = GERMANY_ALIAS if not inverse else GERMANY_ALIAS[::-1]
    parts = F.transform(F.split(col_(c), sep), lambda x: trim_ws(x))
    parts = F.filter(parts, lambda x: x != F.lit(""))
    parts = F.transform(parts, lambda x: F.when(F.upper(x) == F.lit(src), F.lit(dst)).otherwise(x))
    return F.array_join(parts, sep)


def extract_link(html: Column | str, pattern: str = r'href="([^"]+\.csv)"') -> Column:
    """First link matching ``pattern`` (case-insensitive), NULL when none."""
    return F.nullif(F.regexp_extract(col_(html), "(?i)" + pattern, 1), F.lit(""))


def absolutize(link: Column, base_url: Column) -> Column:
    """Site-relative links (``/x``) get the scheme and host of ``base_url``."""
    host = F.regexp_extract(base_url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return F.when(link.startswith("/"), F.concat(host, link)).otherwise(link)
