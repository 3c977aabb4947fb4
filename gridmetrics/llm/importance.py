"""Operator 8: quality selection by importance resampling.

Two generative bag-of-n-grams models over hashed words and word pairs, one of
target text and one of the raw corpus, give each document the log weight
``sum over its n-grams of log p_target - log p_raw``. Adding Gumbel noise and
taking the top k samples k documents without replacement in proportion to
their weights.

The raw model counts every n-gram of every document. The target model is
fitted on documents labelled as good, at most ``TARGET_ROWS`` of them (chosen
by hash; the bound makes the list of their ids safe to broadcast). Both models
have ``BINS`` bins, so what a task gets and gives does not grow with the data.
k is ``keep_share`` of all documents, by default the share of good documents
among the labelled ones; the k-th key is found by narrowing a bracket with
quantiles of the keys, not by a global sort. The noise is drawn by a hash of
doc_id and text, so weights, keys and the sample do not depend on how rows are
dealt out; rows equal in both tie, and those tied with the k-th key are all taken.

Defined cases: null or empty text has weight 0; a document with several labels
counts as good only if all are; without labels the target equals the raw model
and all documents are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .texthash import chunks, pair_hashes, word_hashes

BINS = 1 << 14
TARGET_ROWS = 20_000
SEED = 17
#: Rows that may go to one task when the bracket around the k-th key is narrow.
FEW = 10_000


def ngram_bins(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bin of each n-gram, row bounds) for words and for word pairs."""
    w, at = word_hashes(data, offsets, lower=True)
    p, pat = pair_hashes(w, at)
    half = np.uint64(BINS // 2 - 1)
    return [((w & half).astype(np.int64), at), ((p & half).astype(np.int64) + BINS // 2, pat)]


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each row on its own: what stands beside it makes no difference."""
    out, some = np.zeros(len(bounds) - 1), np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values, bounds[:-1][some])
    return out


def count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, raw, target) of all texts of the task."""
    counts = np.zeros((2, BINS), np.int64)
    for batch in batches:
        good = np.asarray(batch.column("good").fill_null(False).to_numpy(zero_copy_only=False), bool)
        for i, j, data, offsets in chunks(batch.column("text")):
            for bins, at in ngram_bins(data, offsets):
                counts[0] += np.bincount(bins, minlength=BINS)
                chosen = np.repeat(good[i:j], np.diff(at))
                counts[1] += np.bincount(bins[chosen], minlength=BINS)
    used = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])],
                                     names=["bin", "raw", "target"])


def scorer(ratio: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for i, j, data, offsets in chunks(batch.column("text")):
                for k, (bins, at) in enumerate(ngram_bins(data, offsets)):
                    weight[i:j] += row_sums(ratio[bins], at)
                    if not k:
                        n[i:j] = np.diff(at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(weight), batch.column("draw")],
                                             names=["doc_id", "n_words", "log_weight", "draw"])
    return score


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, target_rows: int = TARGET_ROWS) -> tuple[np.ndarray, float]:
    """(log p_target - log p_raw per bin, share of good documents among the labelled)."""
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = scratch.save(marks.filter(F.col("quality").isNotNull()), "labels")
    n, good = marks.agg(F.count("*"), F.coalesce(F.sum((F.col("quality") == 1).cast("long")), F.lit(0))).first()
    chosen = (marks.filter(F.col("quality") == 1).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
              .limit(target_rows).select("doc_id", F.lit(True).alias("good")))
    # at most target_rows ids: 16 bytes each
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left").select("text", "good")
    counts = (marked.mapInArrow(count_bins, "bin long, raw long, target long")
              .groupBy("bin").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.ones(BINS), np.ones(BINS)
    for r in counts:
        raw[r["bin"]] += r["raw"]
        target[r["bin"]] += r["target"]
    if not good:
        return np.zeros(BINS), 1.0
    ratio = np.zeros(BINS)
    for part in (slice(0, BINS // 2), slice(BINS // 2, BINS)):
        ratio[part] = np.log(target[part] / target[part].sum()) - np.log(raw[part] / raw[part].sum())
    return ratio, good / n


def kth_largest(keys: DataFrame, k: int, n: int) -> float:
    """The k-th largest value of the column ``key``: quantiles close a bracket
    around it until few values are left between its ends."""
    if k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    lo, hi, above, inside = float("-inf"), float("inf"), 0, n
    while inside > FEW:
        share = 1 - (k - above) / inside
        band = keys.filter((F.col("key") > lo) & (F.col("key") <= hi))
        a, b = band.agg(F.percentile_approx("key", [max(0.0, share - 0.002), min(1.0, share + 0.002)], 10_000)).first()[0]
        c = band.agg(F.sum((F.col("key") > b).cast("long")), F.sum((F.col("key") > a).cast("long")),
                     F.min("key"), F.max("key")).first()
        if c[2] == c[3]:
            return c[2]
        if above + c[0] >= k:  # it lies above b
            lo, above, left = b, above, c[0]
        elif above + c[1] >= k:  # between a and b
            lo, hi, above, left = a, b, above + c[0], c[1] - c[0]
        else:
            hi, above, left = a, above + c[1], inside - c[1]
        if left == inside:  # most values are equal to one end
            equal = band.filter(F.col("key") == hi).count()
            if above + equal >= k:
                return hi
            hi, above, left = band.filter(F.col("key") < hi).agg(F.max("key")).first()[0], above + equal, inside - equal
        inside = left
    rest = keys.filter((F.col("key") > lo) & (F.col("key") <= hi)).orderBy(F.desc("key")).limit(k - above)
    return rest.agg(F.min("key")).first()[0]


def importance_resample(docs: DataFrame, labels: DataFrame, keep_share: float | None = None,
                        target_rows: int = TARGET_ROWS) -> DataFrame:
    """Score all documents and sample; see the module text.

    ``docs`` needs ``doc_id, text``, ``labels`` needs ``doc_id, quality``.
    Returns ``doc_id, n_words, log_weight, key, kept``.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    ratio, share = fit(docs, labels, scratch, target_rows)
    draw = (F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED + 1)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    scores = docs.select("doc_id", "text", draw.alias("draw")).mapInArrow(
        scorer(ratio), "doc_id long, n_words long, log_weight double, draw double")
    scores = scratch.save(scores.select("doc_id", "n_words", "log_weight",
                                        (F.col("log_weight") - F.log(-F.log("draw"))).alias("key")), "scores")
    n = scores.count()
    k = int(np.ceil(n * (share if keep_share is None else keep_share)))
    cut = kth_largest(scores.select("key"), k, n)
    return scores.withColumn("kept", F.col("key") >= F.lit(cut))
