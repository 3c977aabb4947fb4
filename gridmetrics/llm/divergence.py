"""Operator 11: how far apart the sources of a language are in their words.

Terms are runs of letters (everything that is no ASCII character but A-Z and
a-z), only A-Z lower-cased. Arrow kernels count them inside ``mapInArrow``:
``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and a hash
``group_by`` give a task's partial counts, which are grouped again whenever
many have gathered, so a task holds a bounded number of them. Spark sums the
partial counts; terms in at least ``LEAST_DOCS`` documents of their language
are kept and dealt, by a hash of the term, to shards of about ``SHARD_ROWS``
rows. A shard is a columnar block of terms by sources; it gives its part of
the distance between every two sources and its leading terms of each source,
and both are merged by Spark.

With ``count`` the occurrences of a term in a source, ``N`` their sum over the
kept terms and ``V`` the number of kept terms of the language, a term has
``p = 1 + floor(10**9 * (count + 5) / (N + 5 * V))``; the same over all
sources gives the language's ``q``. All arithmetic is on integers.

Defined cases: null text, language or source is ''; a group without terms has
count 0 everywhere; a language without kept terms has value 0 for all pairs and
no terms; repeated rows count each; other columns are not read; an empty table
gives an empty result. The pairs of sources of a language are the result asked
for, so it has as many rows as there are pairs; no pairs of documents or terms
are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, small_batches

NOT_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
SCALE_STEPS, SCALE_STEP = 3, 1000  # 10**9, in steps that stay within 64 bits
SMOOTH = 5
TOP_TERMS = 50
#: Bytes of text that are split at once, and rows of partial counts a task gathers before it groups them again.
TEXT_BYTES = 8 << 20
GATHER_ROWS = 1_000_000
#: Rows of one shard of terms.
SHARD_ROWS = 50_000

PARTIAL = "lang string, source string, term string, n long, docs long"


def text_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``TEXT_BYTES``, or one longer text."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // TEXT_BYTES
    cuts = np.flatnonzero(np.diff(part)) + 1
    for i, j in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(i, j - i)


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of a few documents."""
    blank = lambda c: pc.fill_null(batch.column(c).cast(pa.string()), "")
    split = pc.split_pattern_regex(pc.ascii_lower(blank("text")), pattern=NOT_LETTERS)
    doc, terms = pc.list_parent_indices(split), pc.list_flatten(split)
    some = pc.greater(pc.binary_length(terms), 0)
    doc, coded = doc.filter(some), terms.filter(some).dictionary_encode()
    by_doc = pa.table({"doc": doc, "code": coded.indices}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    group = pa.StructArray.from_arrays([blank("lang"), blank("source")], ["lang", "source"])
    names = group.to_pylist()
    number = {g: k for k, g in enumerate(dict.fromkeys((x["lang"], x["source"]) for x in names))}
    of_doc = pa.array([number[x["lang"], x["source"]] for x in names], pa.int32())
    by_group = pa.table({"g": of_doc.take(by_doc["doc"].combine_chunks()), "code": by_doc["code"], "n": by_doc["count_all"]})
    out = by_group.group_by(["g", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    g, known = out["g"].combine_chunks(), list(number)
    take = lambda k: pa.array([x[k] for x in known], pa.string()).take(g)
    return pa.table({"lang": take(0), "source": take(1), "term": coded.dictionary.take(out["code"].combine_chunks()),
                     "n": out["n_sum"], "docs": out["n_count"]})


def grouped(parts: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    out = pa.concat_tables(parts).group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table({**{k: out[k] for k in keys}, "n": out["n_sum"], "docs": out["docs_sum"]})


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        for part in text_parts(batch):
            held.append(term_counts(part))
            rows += held[-1].num_rows
            if rows > GATHER_ROWS:
                held = [grouped(held)]
                rows = held[0].num_rows
                if rows > GATHER_ROWS // 2:  # mostly different ones: pass them on
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held, rows = [], 0
    if held:
        yield from grouped(held).to_batches(max_chunksize=50_000)


def scaled(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * count / total) without leaving 64 bits, for totals up to 9 * 10**15."""
    out, rest = count // total, count % total
    for _ in range(SCALE_STEPS):
        rest = rest * SCALE_STEP
        out, rest = out * SCALE_STEP + rest // total, rest % total
    return out + 1


def shard_parts(key: tuple, rows: pa.Table) -> pa.Table:
    """A shard's part of all distances, and its leading terms of every source.

    ``rows`` holds the counts of the shard's terms and one row without term for
    each source of the language, with the source's ``total``."""
    lang = key[0].as_py()
    is_group = pc.is_null(rows["term"])
    groups, counts = rows.filter(is_group), rows.filter(pc.invert(is_group))
    order = pc.sort_indices(groups["source"])
    sources, totals = groups["source"].take(order).to_pylist(), groups["total"].take(order).to_numpy()
    vocabulary = groups["vocabulary"][0].as_py()
    coded = counts["term"].combine_chunks().dictionary_encode()
    terms, place = coded.dictionary, {s: k for k, s in enumerate(sources)}
    column = np.array([place[s] for s in counts["source"].to_pylist()], np.int64)
    table = np.zeros((len(terms), len(sources)), np.int64)
    table[coded.indices.to_numpy(), column] = counts["n"].to_numpy()
    out: dict[str, list] = {c: [] for c in ("source", "part", "item", "value")}

    def give(source: str, part: str, items: list[str], values: np.ndarray) -> None:
        out["source"] += [source] * len(items)
        out["part"] += [part] * len(items)
        out["item"] += items
        out["value"] += values.tolist()

    p = q = table
    if len(terms):
        p = scaled(table + SMOOTH, totals + SMOOTH * vocabulary)
        q = scaled(table.sum(axis=1) + SMOOTH, int(totals.sum()) + SMOOTH * vocabulary)
    rank_of = np.empty(len(terms), np.int64)
    rank_of[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
    for k, source in enumerate(sources):
        apart = np.abs(p - p[:, k:k + 1]).sum(axis=0)
        others = [j for j in range(len(sources)) if j != k]
        give(source, "pair", [sources[j] for j in others], apart[others])
        if len(terms):
            more = np.flatnonzero((table[:, k] > 0) & (p[:, k] > q))
            f = p[more, k] - q[more]
            best = np.lexsort((rank_of[more], -f))[:TOP_TERMS]
            give(source, "term", terms.take(pa.array(more[best])).to_pylist(), f[best])
    return pa.table({"lang": pa.array([lang] * len(out["source"]), pa.string()), "source": pa.array(out["source"], pa.string()),
                     "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.string()),
                     "value": pa.array(out["value"], pa.int64())})


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Distances between the sources of each language and their leading terms;
    see the module text. ``docs`` needs ``text, lang, source``. Returns
    ``lang, source, part, item, value, rank``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    small_batches(spark)
    name = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    groups = docs.select(name("lang"), name("source")).distinct()
    partial = docs.select("text", "lang", "source").mapInArrow(count_terms, PARTIAL)
    # a task's rows are grouped already: dealt first, they are not grouped in vain before the shuffle
    counts = (partial.repartition("lang", "term", "source").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_term = Window.partitionBy("lang", "term")
    kept = counts.withColumn("df", F.sum("docs").over(of_term)).filter(F.col("df") >= least_docs)
    kept = scratch.save(kept.select("lang", "term", "source", "n"), "kept")

    # sizes of groups and languages: a row per source, summed from the kept counts
    size = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(size, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    langs = kept.groupBy("lang").agg(F.count_distinct("term").alias("vocabulary"), F.count("*").alias("rows"))
    none = F.lit(0)
    groups = groups.join(langs, "lang", "left").select(
        "lang", "source", "total", F.coalesce("vocabulary", none).alias("vocabulary"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("rows", none) / shard_rows)).cast("long").alias("shards"))
    groups = scratch.save(groups, "groups")
    shards = groups.select("lang", "shards").distinct()
    dealt = kept.join(shards, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "shards").alias("shard"), "source", "term", "n",
        F.lit(None).cast("long").alias("total"), F.lit(None).cast("long").alias("vocabulary"))
    heads = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "source",
                          F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n"), "total", "vocabulary")
    parts = dealt.unionByName(heads).groupBy("lang", "shard").applyInArrow(
        shard_parts, "lang string, source string, part string, item string, value long")
    whole = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = whole.withColumn("rank", rank.cast("int"))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))


def oracle() -> str:
    """The same in SQL over the table ``documents``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
members AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocab AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n, v.n AS all_n
          FROM members g JOIN vocab v USING (lang) LEFT JOIN counts c USING (lang, source, term)),
sums AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(all_n) OVER (PARTITION BY lang, source) AS all_total,
                count(*) OVER (PARTITION BY lang, source) AS v FROM cells),
rated AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p,
                 1 + (1000000000::HUGEINT * (all_n + 5)) // (all_total + 5 * v) AS q FROM sums),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM members a JOIN members b ON a.lang = b.lang AND a.source <> b.source),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM rated a
          JOIN rated b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
combined AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value
         FROM pairs LEFT JOIN apart USING (lang, source, item)
         UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM rated WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM combined)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
