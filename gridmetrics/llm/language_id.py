"""Operator 12: language identification by a byte convolutional network.

The network reads the UTF-8 bytes of a text in windows of fixed length. Every
byte has a learned vector; filters of several widths slide over them; the
greatest response of each filter in a window (max pooling, after a rectifier)
goes into a softmax over the languages. Windows overlap by one byte less than
the widest filter, so every run of bytes that a filter can see lies in one
window, and every window of the whole text is read. A document's probabilities
are those of its windows, weighted by their letters.

It is trained in numpy, with Adam, on the driver, from a bounded sample: of
each language at most ``DOCS_PER_LANG`` different texts (chosen by a hash of
the text) with at most ``WINDOWS_PER_DOC`` windows each, spread evenly over the
text. The sample is cut on the executors, so only windows reach the driver. The
languages are all values of ``lang`` among the rows learned from. Documents
whose ``crc32(doc_id as text) mod 5`` is 0 are held out and never learned from;
prediction reads the text alone.

Defined cases: null text and text without a letter is ``und`` with score 0, and
so is everything if no row can be learned from; with a single language all
other text has it with score 1; a null doc_id is held out, as no crc32 can be
taken of it; repeated rows are predicted each; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, small_batches
from .texthash import chunks

UNKNOWN = "und"
FOLDS = 5
DOCS_PER_LANG, WINDOWS_PER_DOC = 3000, 4

#: Window length, vector of a byte, and filter widths with filters each.
LENGTH, DEPTH, WIDTHS, FILTERS = 128, 6, (2, 3, 4, 5), 16
WIDEST = max(WIDTHS)
REACH = LENGTH + WIDEST - 1
STEPS, BATCH, RATE, SEED = 1500, 128, 0.004, 7
#: Windows whose responses are held at once, and bytes of text cut into windows at once.
BLOCK, TEXT_BYTES = 96, 4 << 20

#: A-Z read as a-z; 0, which no text but one with a NUL holds, fills the last window.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
LETTER = np.zeros(256, np.float32)
LETTER[97:123] = LETTER[65:91] = LETTER[128:] = 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


@dataclass
class Network:
    langs: list[str]
    vectors: np.ndarray   # 256 x DEPTH
    filters: np.ndarray   # WIDEST * DEPTH x filters; rows beyond a filter's width are 0
    bias: np.ndarray
    out: np.ndarray       # filters x languages
    out_bias: np.ndarray

    def sliding(self, windows: np.ndarray) -> np.ndarray:
        """The vectors of WIDEST bytes from every place of every window on."""
        flat = self.vectors[windows].reshape(len(windows), REACH * DEPTH)
        return np.lib.stride_tricks.sliding_window_view(flat, WIDEST * DEPTH, axis=1)[:, ::DEPTH]

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        return np.maximum(self.responses(self.sliding(windows)).max(axis=1) + self.bias, 0)

    def responses(self, seen: np.ndarray) -> np.ndarray:
        """Of every filter at every place. One product for each window: small
        enough that the linear algebra library keeps to the task's own thread."""
        return np.matmul(np.ascontiguousarray(seen), self.filters)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [self.pooled(windows[i:i + BLOCK]) @ self.out + self.out_bias for i in range(0, len(windows), BLOCK)]
        return softmax(np.concatenate(parts)) if parts else np.zeros((0, len(self.langs)), np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def filter_mask() -> np.ndarray:
    reach = np.repeat(WIDTHS, FILTERS)
    return (np.arange(WIDEST * DEPTH)[:, None] < reach[None, :] * DEPTH).astype(np.float32)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], steps: int = STEPS) -> Network:
    """Fit the network to windows (rows of REACH bytes) with their languages."""
    rng = np.random.default_rng(SEED)
    draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    mask, wide = filter_mask(), len(WIDTHS) * FILTERS
    net = Network(langs, draw(256, DEPTH, by=0.5), draw(WIDEST * DEPTH, wide, by=0.3) * mask, np.zeros(wide, np.float32),
                  draw(wide, len(langs), by=0.1), np.zeros(len(langs), np.float32))
    names = ("vectors", "filters", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    deck = np.zeros(0, np.int64)
    for step in range(steps):
        if len(deck) < BATCH:
            deck = np.concatenate([deck, rng.permutation(len(windows))])
        at, deck = deck[:BATCH], deck[BATCH:]
        for k, g in gradients(net, windows[at], labels[at], mask).items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            rate = RATE * (1 - step / steps) * np.sqrt(1 - 0.999 ** (step + 1)) / (1 - 0.9 ** (step + 1))
            getattr(net, k).__isub__(rate * first[k] / (np.sqrt(second[k]) + 1e-8))
    return net


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    n = len(windows)
    seen = net.sliding(windows)
    responses = net.responses(seen)
    place = responses.argmax(axis=1)
    best = np.take_along_axis(responses, place[:, None, :], axis=1)[:, 0] + net.bias
    hidden = np.maximum(best, 0)
    slope = softmax(hidden @ net.out + net.out_bias)
    slope[np.arange(n), labels] -= 1
    slope /= n
    back = (slope @ net.out.T) * (best > 0)
    at_best = seen[np.arange(n)[:, None], place]  # window x filter x WIDEST * DEPTH
    filters = np.einsum("nfk,nf->kf", at_best, back) * mask
    into = (back[:, :, None] * net.filters.T[None]).reshape(-1, DEPTH)
    bytes_at = windows[np.arange(n)[:, None, None], place[:, :, None] + np.arange(WIDEST)]
    vectors = np.stack([np.bincount(bytes_at.ravel(), into[:, k], 256) for k in range(DEPTH)], axis=1)
    return {"vectors": vectors.astype(np.float32), "filters": filters, "bias": back.sum(axis=0),
            "out": hidden.T @ slope, "out_bias": slope.sum(axis=0)}


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all windows of the texts, text of each window); an empty text has none."""
    count = -(-np.diff(offsets) // LENGTH)
    text = np.repeat(np.arange(len(count)), count)
    start = offsets[:-1][text] + LENGTH * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
    padded = np.concatenate([FOLD[data], np.zeros(REACH, np.uint8)])
    place = start[:, None] + np.arange(REACH)
    out = padded[place]
    out[place >= offsets[1:][text][:, None]] = 0
    return out, text


def some_windows(most: int):
    """(lang, hash, window) of the texts: at most ``most`` windows of each, spread evenly."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, key = batch.column("lang"), batch.column("h")
            for i, _, data, offsets in chunks(batch.column("text"), TEXT_BYTES):
                cells, text = windows_of(data, offsets)
                count = np.bincount(text, minlength=len(offsets) - 1)
                first = np.cumsum(count) - count
                pick = np.unique(np.concatenate([(first + count * (2 * k + 1) // (2 * most))[count > 0] for k in range(most)]))
                pick = pick[LETTER[cells[pick]].sum(axis=1) > 0]
                row = pa.array(i + text[pick])
                yield pa.RecordBatch.from_arrays([lang.take(row), key.take(row), pa.array([w.tobytes() for w in cells[pick]], pa.binary())],
                                                 names=["lang", "h", "w"])
    return cut


def training_rows(docs: DataFrame, docs_per_lang: int) -> DataFrame:
    """At most ``docs_per_lang`` different texts of each language, those with the least hash."""
    rows = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 52)).alias("h"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()  # a row per language
    if not sizes:
        return rows
    # twice the texts asked for, by hash: the rest stays where it is
    bounds = {r["lang"]: min(1 << 52, int(2 * docs_per_lang / max(r["n"], 1) * (1 << 52))) for r in sizes}
    bound = F.element_at(F.create_map(*(F.lit(x) for item in bounds.items() for x in item)), F.col("lang"))
    near = rows.filter(F.col("h") < bound).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return near.withColumn("r", rank).filter(F.col("r") <= docs_per_lang).select("lang", "text", "h")


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> Network | None:
    """Train on the rows that are not held out; None if there are none."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    cut = training_rows(docs, docs_per_lang).mapInArrow(some_windows(windows_per_doc), "lang string, h long, w binary")
    sample = cut.toArrow().sort_by([("lang", "ascending"), ("h", "ascending"), ("w", "ascending")])
    if not sample.num_rows:
        return None
    coded = sample["lang"].combine_chunks().dictionary_encode()
    windows = np.frombuffer(b"".join(sample["w"].to_pylist()), np.uint8).reshape(-1, REACH)
    return train(windows, coded.indices.to_numpy(), coded.dictionary.to_pylist())


def predictor(net: Network):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros((batch.num_rows, len(net.langs)))
            for i, _, data, offsets in chunks(batch.column("text"), TEXT_BYTES):
                cells, text = windows_of(data, offsets)
                letters = LETTER[cells[:, :LENGTH]].sum(axis=1)
                used = np.flatnonzero(letters)
                weighted = net.probabilities(cells[used]) * letters[used, None]
                for k in range(len(net.langs)):
                    total[i:i + len(offsets) - 1, k] += np.bincount(text[used], weighted[:, k], len(offsets) - 1)
            best, mass = total.argmax(axis=1), total.sum(axis=1)
            score = total[np.arange(len(best)), best] / np.where(mass > 0, mass, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("letters"),
                 pa.array(net.langs, pa.string()).take(pa.array(best)), pa.array(np.minimum(score, 1.0))],
                names=["doc_id", "held_out", "letters", "lang_pred", "score"])
    return predict


def language_id(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> DataFrame:
    """The language of every text; see the module text. ``docs`` needs
    ``doc_id, text, lang``. Returns ``doc_id, held_out, lang_pred, score``."""
    net = fit(docs.select("doc_id", "text", "lang"), docs_per_lang, windows_per_doc)
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), has_letter, "text")
    unknown = (F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        return rows.select("doc_id", "held_out", *unknown)
    rated = rows.withColumn("text", F.when(F.col("letters"), F.col("text"))).mapInArrow(
        predictor(net), "doc_id long, held_out boolean, letters boolean, lang_pred string, score double")
    return rated.select("doc_id", "held_out", F.when(F.col("letters"), F.col("lang_pred")).otherwise(unknown[0]).alias("lang_pred"),
                        F.when(F.col("letters"), F.col("score")).otherwise(F.lit(0.0)).alias("score"))
