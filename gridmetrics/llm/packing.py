"""Operator 7: optimal length buckets.

A dynamic program over the global histogram of lengths chooses the bucket
bounds that need the least padding; batches of a token budget form inside each
bucket.

Lengths up to ``EXACT`` are candidate bounds themselves; longer ones are
gathered in 128 steps per doubling, so the histogram has at most a few thousand
rows whatever the data, and the driver may hold it. The longest length of a step
is its bound, so no bucket is longer than its longest member. The program is
exact over these candidates, with exact counts; bounds between them could save
less than 1/128 of the padded length. Batches come
from ranks spread over blocks, so a bucket that holds most rows is many tasks.

Defined cases: null text has no tokens and is placed in the shortest bucket; a
document longer than the token budget is a batch of its own, never cut;
repeated rows are placed each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, n_words, ranked, text_or_empty

BUCKETS = 16
BATCH_TOKENS = 65_536
EXACT = 256


def candidate(n: Column) -> Column:
    """The step of a length: itself, or rounded up by under 1/128."""
    bits = F.length(F.bin(n - 1)) - 8
    step = F.pow(F.lit(2.0), bits)
    return F.when(n <= EXACT, n).otherwise((F.ceil(n / step) * step).cast("long"))


def best_bounds(values: list[int], counts: list[int], buckets: int) -> list[int]:
    """Bounds (ascending, the last is the largest value) of at most ``buckets``
    buckets with the least total padded length."""
    v, c = np.asarray(values, np.float64), np.concatenate([[0.0], np.cumsum(np.asarray(counts, np.float64))])
    m = len(v)
    if not m:
        return []
    cost = v[None, :] * (c[None, 1:] - c[:-1, None])  # [i, j]: values i..j padded to v[j]
    cost[np.tril_indices(m, -1)] = np.inf
    best, back = cost[0].copy(), []
    for _ in range(min(buckets, m) - 1):
        through = np.concatenate([[np.inf], best[:-1]])[:, None] + cost  # the last bucket starts at i
        start = through.argmin(axis=0)
        value = through[start, np.arange(m)]
        better = value < best
        back.append(np.where(better, start, -1))
        best = np.where(better, value, best)
    bounds, j = [], m - 1
    for start in reversed(back):
        if start[j] < 0:
            continue
        bounds.append(int(values[j]))
        j = int(start[j]) - 1
    bounds.append(int(values[j]))
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
         length: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """Place each document in a bucket, a batch and a slot.

    ``docs`` needs ``doc_id, text``; ``length`` counts a document's tokens
    (default: its words). Returns ``doc_id, n_tokens, bucket, bucket_len,
    padding, batch, slot`` and, if asked, the columns ``carry`` in the struct
    column ``row``. ``batch`` counts gaplessly over all buckets.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    row = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(None).cast("struct<doc_id:long>")
    n = length if length is not None else n_words(text_or_empty())
    lens = docs.select("doc_id", n.cast("long").alias("n_tokens"), F.xxhash64("doc_id", "text").alias("place"),
                       row.alias("row"))
    lens = scratch.save(lens if carry else lens.drop("row"), "lengths")
    hist = (lens.groupBy(candidate(F.col("n_tokens")).alias("step")).agg(F.max("n_tokens").alias("v"), F.count("*").alias("n"))
            .orderBy("v").collect())
    bounds = best_bounds([r["v"] for r in hist], [r["n"] for r in hist], buckets) or [0]
    bucket, base, first = F.lit(len(bounds) - 1), [], 0
    per_batch = [max(1, batch_tokens // max(1, b)) for b in bounds]
    for k, b in enumerate(bounds):
        held = sum(r["n"] for r in hist if (bounds[k - 1] if k else -1) < r["v"] <= b)
        base.append(first)
        first += -(-held // per_batch[k])
    for k in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("n_tokens") <= bounds[k], F.lit(k)).otherwise(bucket)
    at = lambda xs: F.element_at(F.array(*(F.lit(int(x)) for x in xs)), F.col("bucket") + 1)
    total = sum(r["n"] for r in hist)
    placed = ranked(lens.withColumn("bucket", bucket), ["bucket"],
                    [F.xxhash64("doc_id", "place"), F.col("doc_id"), F.col("place")], total)
    return placed.select(
        "doc_id", "n_tokens", "bucket", at(bounds).cast("long").alias("bucket_len"),
        (at(bounds) - F.col("n_tokens")).cast("long").alias("padding"),
        (at(base) + F.floor(F.col("rank") / at(per_batch))).cast("long").alias("batch"),
        F.pmod("rank", at(per_batch)).cast("long").alias("slot"), *(["row"] if carry else []))
