"""Operator 9: quality rules with adaptive thresholds.

Features of whole texts are computed once, quantile sketches per language and
source give the thresholds, and a join applies them. Everything is DataFrame
functions on the JVM.

The sketch is a log-bucket histogram with relative error ``ALPHA``: bucket
``ceil(log_gamma(x))`` with a count. Two sketches merge by adding counts, so
they are built by partial aggregation (a source that holds a third of all rows
is collapsed before the shuffle), have a bounded number of rows, and come out
the same on every run. A (language, source) with fewer than ``MIN_ROWS``
documents takes the merged sketch of its language, or of all documents.

A document is rejected by the method when a feature lies beyond the outer
fence of its group: ``q75 + FENCE * max(q75 - q25, least spread)``, for the
mean word length below the lower fence as well. Quartiles are robust against
up to a quarter of junk, and the fences are wide enough to leave the tails of
clean text alone.

Defined cases: null or empty text has no words and fails the base rule; null
language or source form groups of their own; repeated rows are rated each;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch, let, source_key, text_or_empty, words

ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
FENCE = 6.0
MIN_ROWS = 200
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Feature: (numerator, denominator, least spread, whether it has a lower fence too).
FEATURES = {
    "word_length": ("word_chars", "n_words", 0.25, True),
    "symbols": ("n_symbols", "n_words", 0.05, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.10, False),
    "repeats": ("n_repeat_words", "n_words", 0.05, False),
}


def repeat_words(w: Column) -> Column:
    """Words of the array that lie in a 3-word window found twice or more.

    Windows are compared by 64-bit hashes. Only texts with an equal pair sort
    their (hash, place) list; the covered places then follow from the gaps
    between the places of the repeated windows.
    """
    def covered(pos: Column) -> Column:
        steps = F.transform(pos, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(pos, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        def again(e: Column, k: Column) -> Column:
            return (F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                    | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)))
        return F.sort_array(F.transform(F.filter(s, again), lambda e: e["i"]))

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(let(pairs, lambda s: let(repeated(s), covered))))

    def windows(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(v) - 3),
                           lambda i: F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)))

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(windows(w), count))


def features(text: Column) -> Column:
    """Struct of the base figures of a text (one evaluation of its word list)."""
    bare = F.length(F.translate(text, SPACES, ""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def figures(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))

    def line_figures(v: Column) -> Column:
        return F.struct(F.size(v).cast("long").alias("n_lines"),
                        (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"))

    return F.struct(bare.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
                    let(words(text), figures).alias("w"), let(lines, line_figures).alias("l"))


def ratio(name: str) -> Column:
    num, den, _, _ = FEATURES[name]
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def sketches(rated: DataFrame) -> DataFrame:
    """(lang_key, source_key, feature, bucket, n): the mergeable sketch of each group."""
    each = F.array(*(F.struct(F.lit(k).alias("feature"), ratio(k).alias("x")) for k in FEATURES))
    x = F.col("e.x")
    bucket = F.when(x > 0, F.ceil(F.log(x) / F.lit(math.log(GAMMA)))).otherwise(F.lit(None)).cast("long")
    return (rated.select("lang_key", "source_key", F.explode(each).alias("e"))
            .groupBy("lang_key", "source_key", F.col("e.feature").alias("feature"),
                     F.coalesce(bucket, F.lit(-(10 ** 6))).alias("bucket"))
            .agg(F.count("*").alias("n")))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "feature", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, feature, rows, q25, q75) read off the sketches.

    A window runs over the buckets of one sketch, a few thousand at most.
    """
    group = [*keys, "feature"]
    run = Window.partitionBy(*group).orderBy("bucket")
    whole = Window.partitionBy(*group)
    value = F.when(F.col("bucket") == -(10 ** 6), F.lit(0.0)).otherwise(
        F.lit(2.0) * F.pow(F.lit(GAMMA), F.col("bucket")) / F.lit(GAMMA + 1))
    cum = sketch.withColumn("upto", F.sum("n").over(run)).withColumn("rows", F.sum("n").over(whole))

    def q(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("rows") * F.lit(share), value))

    return cum.groupBy(*group).agg(F.max("rows").alias("rows"), q(0.25).alias("q25"), q(0.75).alias("q75"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang_key, source_key) with ``<feature>_lo`` and ``<feature>_hi``."""
    own = quartiles(sketch, ["lang_key", "source_key"])
    lang = quartiles(merged(sketch, ["lang_key"]), ["lang_key"])
    every = quartiles(merged(sketch, []), [])
    q = (own.alias("o").join(lang.alias("l"), ["lang_key", "feature"])
         .join(every.alias("e"), ["feature"]))

    def pick(name: str) -> Column:
        return (F.when(F.col("o.rows") >= MIN_ROWS, F.col(f"o.{name}"))
                .when(F.col("l.rows") >= MIN_ROWS, F.col(f"l.{name}")).otherwise(F.col(f"e.{name}")))

    q = q.select("lang_key", "source_key", "feature", pick("q25").alias("q25"), pick("q75").alias("q75"))
    least = F.lit(0.0)
    for name, (_, _, spread, _) in FEATURES.items():
        least = F.when(F.col("feature") == name, F.lit(spread)).otherwise(least)
    reach = F.lit(FENCE) * F.greatest(F.col("q75") - F.col("q25"), least)
    q = q.withColumn("lo", F.col("q25") - reach).withColumn("hi", F.col("q75") + reach)
    at = lambda k, c: F.max(F.when(F.col("feature") == k, F.col(c))).alias(f"{k}_{c}")
    return q.groupBy("lang_key", "source_key").agg(*(at(k, c) for k in FEATURES for c in ("lo", "hi")))


def quality_rules(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Rate every document; see the module text for the method.

    ``docs`` needs ``doc_id, text, lang, source``. Returns ``doc_id``, the base
    figures, ``base_failed``, ``kept``, and the columns ``carry`` in a struct
    column ``row`` (none by default), whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    row = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(None).cast("struct<doc_id:long>")
    f = docs.select("doc_id", source_key(F.col("lang")).alias("lang_key"),
                    source_key(F.col("source")).alias("source_key"), row.alias("row"),
                    features(text_or_empty()).alias("f"))
    rated = scratch.save(f.select("doc_id", "lang_key", "source_key", "row", "f.word_chars", "f.n_symbols",
                                  "f.w.n_words", "f.w.n_repeat_words", "f.l.n_lines", "f.l.n_dup_lines"), "rated")
    sketch = scratch.save(sketches(rated), "sketches")
    limits = scratch.save(thresholds(sketch), "limits")  # written: its size decides how it is joined
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    ok = ~F.col("base_failed")
    for name, (_, _, _, lower) in FEATURES.items():
        ok &= ratio(name) <= F.col(f"{name}_hi")
        if lower:
            ok &= ratio(name) >= F.col(f"{name}_lo")
    out = rated.withColumn("base_failed", base_failed).join(limits, ["lang_key", "source_key"], "left")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.coalesce(ok, F.lit(False)).alias("kept"), *(["row"] if carry else []))


def oracle() -> str:
    """DuckDB twin over the table ``documents``."""
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    case = lambda i: "CASE feature " + " ".join(
        f"WHEN '{k}' THEN {v[i]}" for k, v in FEATURES.items()) + " END"
    each = " UNION ALL ".join(
        f"SELECT lk, sk, '{k}' AS feature, CASE WHEN {den} > 0 THEN {num} / CAST({den} AS DOUBLE) ELSE 0.0 END AS x FROM m"
        for k, (num, den, _, _) in FEATURES.items())
    lg = repr(math.log(GAMMA))
    value = f"CASE WHEN bucket = -1000000 THEN 0.0 ELSE 2.0 * pow({GAMMA!r}, bucket) / {GAMMA + 1!r} END"

    def quart(keys: str, name: str) -> str:
        part = f"PARTITION BY {keys}feature"
        return (f"{name} AS (SELECT {keys}feature, max(rws) AS rws, min(CASE WHEN upto >= rws * 0.25 THEN v END) AS q25, "
                f"min(CASE WHEN upto >= rws * 0.75 THEN v END) AS q75 FROM (SELECT *, {value} AS v, "
                f"sum(n) OVER ({part} ORDER BY bucket) AS upto, sum(n) OVER ({part}) AS rws "
                f"FROM (SELECT {keys}feature, bucket, sum(n) AS n FROM sk0 GROUP BY ALL)) GROUP BY {keys}feature)")

    tests = " AND ".join(
        f"(CASE WHEN {den} > 0 THEN {num} / CAST({den} AS DOUBLE) ELSE 0.0 END) <= {k}_hi"
        + (f" AND (CASE WHEN {den} > 0 THEN {num} / CAST({den} AS DOUBLE) ELSE 0.0 END) >= {k}_lo" if lower else "")
        for k, (num, den, _, lower) in FEATURES.items())
    pivots = ", ".join(f"max(CASE WHEN feature = '{k}' THEN {c} END) AS {k}_{c}" for k in FEATURES for c in ("lo", "hi"))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, lang, source FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS c FROM g) WHERE c >= 2),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, count(*) AS nl, count(DISTINCT x) AS dl
       FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d) WHERE trim(x, {spaces}) <> '' GROUP BY rid),
m AS (SELECT d.rid, doc_id, coalesce('0' || lang, '1') AS lk, coalesce('0' || source, '1') AS sk,
        CAST(len(ws) AS BIGINT) AS n_words, CAST(length(translate(t, {spaces}, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        coalesce(nl, 0) AS n_lines, CAST(coalesce(nl - dl, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid)),
sk0 AS (SELECT lk, sk, feature, CASE WHEN x > 0 THEN CAST(ceil(ln(x) / {lg}) AS BIGINT) ELSE -1000000 END AS bucket,
        count(*) AS n FROM ({each}) GROUP BY ALL),
{quart('lk, sk, ', 'own')}, {quart('lk, ', 'lng')}, {quart('', 'evr')},
q AS (SELECT own.lk, own.sk, feature,
        CASE WHEN own.rws >= {MIN_ROWS} THEN own.q25 WHEN lng.rws >= {MIN_ROWS} THEN lng.q25 ELSE evr.q25 END AS q25,
        CASE WHEN own.rws >= {MIN_ROWS} THEN own.q75 WHEN lng.rws >= {MIN_ROWS} THEN lng.q75 ELSE evr.q75 END AS q75
      FROM own JOIN lng USING (lk, feature) JOIN evr USING (feature)),
f AS (SELECT *, q25 - {FENCE} * greatest(q75 - q25, {case(2)}) AS lo, q75 + {FENCE} * greatest(q75 - q25, {case(2)}) AS hi FROM q),
lim AS (SELECT lk, sk, {pivots} FROM f GROUP BY lk, sk),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed) AND {tests} AS kept
FROM b JOIN lim USING (lk, sk)"""
