"""Operators 11 to 13 against brute-force versions."""
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmetrics.llm import divergence, language_id, whitening
from llm_fixtures import SCHEMA, clashing, none, odd, odd_rows  # noqa: F401

DATA = "/root/testdata/sf0.01"


# --- operator 11 -------------------------------------------------------------------------

def brute_divergence(rows, least, top=divergence.TOP_TERMS):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, counts, df = set(), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for k, s in groups if k == lang]
        everywhere = Counter()
        for s in sources:
            everywhere.update(counts[lang, s])

        def p(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        mine, q = p(counts[lang, source]), p(everywhere)
        pairs = [(sum(abs(mine[t] - other[t]) for t in kept), s) for s in sources if s != source
                 for other in [p(counts[lang, s])]]
        terms = [(mine[t] - q[t], t) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, i, v, k + 1) for k, (v, i) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def shuffled_words():
    r = np.random.default_rng(3)
    words = ["Straße", "straße", "éa", "ÉA", "x", "Ab", "aB", "日本", "z-z", "don't", "q9w"]
    pick = lambda: " ".join(r.choice(words, r.integers(0, 12)))
    return [(pick(), r.choice(["en", "de"]).item(), "hot" if r.random() < 0.4 else f"s{r.integers(5)}") for _ in range(300)]


@pytest.mark.parametrize("least, shard_rows", [(1, 50_000), (2, 3), (30, 7), (10_000, 5)])
def test_divergence_equals_brute_force(spark, least, shard_rows):
    rows = shuffled_words() + [(None, "en", "silent"), ("", None, "a"), ("word", None, None), ("a\x00b\x7fc", "", "b")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert rows_of(divergence.source_divergence(df, least, shard_rows)) == brute_divergence(rows, least)


def test_divergence_of_odd_rows(odd, none, clashing):  # noqa: F811
    want = brute_divergence([(t, lang, s) for _, t, lang, s, _ in odd_rows()], 2)
    assert rows_of(divergence.source_divergence(odd, 2)) == want
    assert rows_of(divergence.source_divergence(clashing, 2)) == want
    assert rows_of(divergence.source_divergence(none)) == []


def test_rates_are_exact_beyond_32_bits():
    totals = [7, 10**6 + 3, 9 * 10**15]
    for total in totals:
        counts = [0, 5, total // 3, total]
        assert divergence.scaled(np.array(counts), total).tolist() == [1 + 10**9 * c // total for c in counts]


def test_task_counts_are_the_same_however_they_are_gathered(monkeypatch):
    import pyarrow as pa
    rows = shuffled_words()
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": lang, "source": s} for t, lang, s in rows])
    def total():
        out = Counter()
        for b in divergence.count_terms(iter([batch, batch])):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["n"]
                out[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return out
    want = total()
    monkeypatch.setattr(divergence, "GATHER_ROWS", 10)
    monkeypatch.setattr(divergence, "TEXT_BYTES", 64)
    assert total() == want


# --- operator 12 -------------------------------------------------------------------------

def tiny_network(langs=("a", "b", "c")):
    r = np.random.default_rng(1)
    f = lambda *s: r.standard_normal(s).astype(np.float32)
    wide = len(language_id.WIDTHS) * language_id.FILTERS
    return language_id.Network(list(langs), f(256, language_id.DEPTH), f(language_id.WIDEST * language_id.DEPTH, wide) * language_id.filter_mask(),
                               f(wide), f(wide, len(langs)), f(len(langs)))


def brute_pooled(net, window):
    out = []
    for k, width in enumerate(np.repeat(language_id.WIDTHS, language_id.FILTERS)):
        shape = net.filters[:width * language_id.DEPTH, k].reshape(width, language_id.DEPTH)
        best = max(float((net.vectors[window[i:i + width]] * shape).sum()) for i in range(language_id.LENGTH))
        out.append(max(best + net.bias[k], 0))
    return out


def test_filters_and_pooling_equal_loops():
    net, r = tiny_network(), np.random.default_rng(2)
    windows = r.integers(0, 256, (3, language_id.REACH)).astype(np.uint8)
    assert np.allclose(net.pooled(windows), [brute_pooled(net, w) for w in windows], atol=1e-3)


def test_gradients_equal_differences():
    net, r = tiny_network(), np.random.default_rng(4)
    windows, labels = r.integers(0, 256, (6, language_id.REACH)).astype(np.uint8), r.integers(0, 3, 6)
    for k in ("vectors", "filters", "bias", "out", "out_bias"):
        setattr(net, k, getattr(net, k).astype(np.float64) * (0.1 if k == "out" else 1))
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(6), labels]).mean()
    found = language_id.gradients(net, windows, labels, language_id.filter_mask())
    for k, g in found.items():
        values = getattr(net, k)
        for at in np.argsort(-np.abs(g).ravel())[:4]:
            kept, moved = values.flat[at], []
            for d in (1e-4, -1e-4):
                values.flat[at] = kept + d
                moved.append(loss())
            values.flat[at] = kept
            assert (moved[0] - moved[1]) / 2e-4 == pytest.approx(g.flat[at], rel=0.02, abs=1e-6), k


def test_windows_hold_every_run_of_bytes():
    texts = [b"", b"x", b"Ab" * 64, bytes(range(1, 200)) * 5, b"q" * 129]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    cells, text = language_id.windows_of(data, offsets)
    for k, t in enumerate(texts):
        t = bytes(language_id.FOLD[np.frombuffer(t, np.uint8)])
        mine = [bytes(w) for w in cells[text == k]]
        assert len(mine) == -(-len(t) // language_id.LENGTH)
        for i in range(len(t) - language_id.WIDEST + 1):
            assert any(t[i:i + language_id.WIDEST] in w for w in mine[i // language_id.LENGTH:i // language_id.LENGTH + 1])
        assert b"".join(w[:language_id.LENGTH] for w in mine)[:len(t)] == t


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    found = language_id.language_id(docs).toPandas()
    docs = docs.toPandas()
    assert len(found) == len(docs) and found.score.between(0, 1).all()
    both = found.merge(docs, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    known = both[both.held_out & both.lang.notna()]
    assert (known.lang == known.lang_pred).mean() >= 0.95


def test_prediction_does_not_read_language_or_number(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").limit(200)
    net = language_id.fit(docs, 50)
    assert net is not None and language_id.fit(docs.filter("false")) is None
    rate = lambda d: sorted(map(tuple, d.select(
        F.lit(0).cast("long").alias("doc_id"), F.lit(True).alias("held_out"), F.lit(True).alias("letters"), "text")
        .mapInArrow(language_id.predictor(net), "doc_id long, held_out boolean, letters boolean, lang_pred string, score double")
        .select("lang_pred", "score").collect()))
    assert rate(docs) == rate(docs.repartition(3))


def test_language_of_odd_rows(spark, odd, none, clashing):  # noqa: F811
    found = language_id.language_id(odd).collect()
    assert len(found) == len(odd_rows())
    texts = {d: t for d, t, *_ in odd_rows()}
    for r in found:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
        assert r.lang_pred in ("und", "en", "de") and 0 <= r.score <= 1
        assert r.doc_id is not None or r.held_out
    assert len(language_id.language_id(clashing).collect()) == len(found)
    assert language_id.language_id(none).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.language_id(unlabelled).collect()} == {("und", 0.0)}
    single = language_id.language_id(odd.withColumn("lang", F.lit("xx"))).collect()
    assert {(r.lang_pred, r.score) for r in single} == {("und", 0.0), ("xx", 1.0)}


# --- operator 13 -------------------------------------------------------------------------

def spectrum(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(3, 1, 20), np.r_[np.full(8, 5.0), np.ones(12)], np.r_[5 + 1e-9 * np.arange(6), np.ones(4), 1e-3 + 1e-12 * np.arange(5)],
    np.r_[np.ones(5), np.zeros(10)], 10.0 ** -np.arange(12), np.zeros(4), np.ones(1)])
def test_eigenvectors_to_double_precision(values):
    m = spectrum(values)
    e, x = whitening.eigen(m)
    wide = x.astype(np.longdouble)
    top = max(values.max(), 1e-300)
    assert (np.diff(e) <= 1e-15 * top).all() and np.allclose(e, np.linalg.eigvalsh(m)[::-1], atol=1e-14 * top)
    assert np.abs(wide.T @ wide - np.eye(len(m))).max() < 1e-15
    assert np.abs(m @ wide - wide * e).max() < 1e-15 * top


def vectors(n, dim, seed=0):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, dim)) * np.geomspace(1, 0.05, dim)).tolist()


def brute_whitened(rows):
    x = np.floor(64 * np.array(rows, float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    deviation = [int(sum(int(n * a - b) ** 2 for a, b in zip(r, total))) for r in x]
    c = x - total / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return deviation, c @ u / np.sqrt(e), e / e.sum()


def check_whitened(out, rows, ids, dim):
    out = out.toPandas()
    deviation, want, share = brute_whitened(rows)
    k = min(dim, whitening.COMPONENTS)
    assert len(out) == len(rows) * k and out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-8
    assert (out.n == len(rows)).all()
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((got * want[:, :k]).sum(axis=0))
    assert np.abs(got * sign - want[:, :k]).max() < 1e-8
    first = out.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[ids].tolist()
    assert first == deviation
    assert np.allclose(out.drop_duplicates("component").sort_values("component").explained, share[:k], rtol=1e-9)


@pytest.mark.parametrize("n, dim, parts", [(300, 40, 4), (50, 3, 7), (200, 1, 2)])
def test_whitened_equals_numpy(spark, n, dim, parts):
    rows = vectors(n, dim)
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>").repartition(parts)
    check_whitened(whitening.whiten(df), rows, list(range(n)), dim)


def test_whitening_drops_unusable_vectors_only(spark):
    rows = vectors(80, 4, 1)
    rows[5] = rows[6]
    bad = [None, [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [float("inf"), 0.0, 0.0, 0.0], [], [1e300, 0.0, 0.0, 0.0], [1.0, 2.0]]
    table = list(enumerate(rows)) + [(100 + k, b) for k, b in enumerate(bad)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash")).withColumn("n", F.lit(1))
    check_whitened(whitening.whiten(df), rows, list(range(80)), 4)


def test_whitening_of_large_entries_stays_exact(spark):
    rows = [[float(a) * 2.0**33, float(b)] for a, b in np.random.default_rng(5).normal(size=(30, 2))]
    out = whitening.whiten(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")).toPandas()
    deviation = [d if d < 1 << 63 else None for d in brute_large(rows)]
    got = out.drop_duplicates("vec_id").sort_values("vec_id").deviation
    assert [None if np.isnan(g) else d for g, d in zip(got, deviation)] == deviation
    assert out.identity_error[0] < 1e-4


def brute_large(rows):
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in r] for r in rows]
    total = [sum(c) for c in zip(*x)]
    return [sum((len(x) * a - b) ** 2 for a, b in zip(r, total)) for r in x]


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (None, 1, 0, None, None, None), (None, 2, 0, None, None, None)]
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 3.0]) for k in range(9)], schema)).toPandas()
    assert flat[flat.component == 2].whitened.isna().all() and flat[flat.component == 1].whitened.notna().all()
    assert flat.identity_error[0] < 1e-12
