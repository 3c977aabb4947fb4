import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_fixtures import clashing, none, odd, odd_rows, words  # noqa: F401
from gridmetrics.llm import mixing, packing, quality_rules

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = SPLIT.findall(text or "")
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if SPLIT.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_figures(spark, odd):
    got = Counter((r["doc_id"], *(r[c] for c in COLS), r["base_failed"]) for r in quality_rules.quality_rules(odd).collect())
    want = Counter()
    for d, t, *_ in odd_rows():
        b = base(t)
        want[(d, *b, b[0] < 50 or 100 * b[4] > 50 * b[0])] += 1
    assert got == want


def test_thresholds_adapt_to_groups(spark):
    """Junk stands out against its own language and source; clean text stays."""
    rows = []
    for i in range(600):
        lang = "en" if i % 2 else "xx"  # words of the other language are twice as long
        w = words(150, i).split()
        text = " ".join(w) if lang == "en" else " ".join(a + b for a, b in zip(w, w[1:]))
        if i % 50 == 7:
            text = " ".join(x + "***" for x in w)
        rows.append((i, text, lang, f"s{i % 3}"))
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert [i for i, k in kept.items() if not k] and all(kept[i] != (i % 50 == 7) for i in kept)


def test_sketch_quartiles_are_near(spark):
    rows = spark.range(20_000).select(F.lit("a").alias("lang_key"), F.lit("b").alias("source_key"), F.lit(100).alias("n_words"),
                                      (F.col("id") / 10).alias("word_chars"), *(F.lit(0).alias(c) for c in (
                                          "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")))
    q = {r["feature"]: r for r in quality_rules.quartiles(quality_rules.sketches(rows), ["lang_key"]).collect()}
    assert q["word_length"]["q25"] == pytest.approx(5.0, rel=0.02) and q["word_length"]["q75"] == pytest.approx(15.0, rel=0.02)
    assert q["symbols"]["q75"] == 0.0


def test_empty_and_clashing(spark, none, clashing):
    assert quality_rules.quality_rules(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert packing.pack(none).count() == 0
    for f in (quality_rules.quality_rules, mixing.mix_sources, packing.pack):
        out = f(clashing, carry=clashing.columns)
        assert out.count() == len(odd_rows())
        assert out.select("row.*").columns == clashing.columns
        assert {r["kept"] for r in out.select("row.kept").collect()} == {"extra"}


def fill(sizes):
    """Targets by brute force: share, stop at three times, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    done, left = {}, float(sum(sizes.values()))
    while True:
        rest = [s for s in order if s not in done]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return done | {s: left * weight[s] / total for s in rest}
        for s in over:
            done[s] = 3.0 * sizes[s]
        left = sum(sizes.values()) - sum(done.values())


def test_mix(spark):
    rows = [(i, words(5 + (i * 37) % 200, i), None if i % 9 == 0 else f"s{i % 9}" if i % 2 else "s2") for i in range(900)]
    rows += [(5000, "a b c", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    a, b = ({r["doc_id"]: r for r in mixing.mix_sources(df).collect()} for _ in range(2))
    assert {k: r["taken"] for k, r in a.items()} == {k: r["taken"] for k, r in b.items()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, t, s in rows:
        assert a[d]["size"] == len(t.split()) and a[d]["taken"] <= 3 * a[d]["size"]
        sizes[s] += a[d]["size"]
        taken[s] += a[d]["taken"]
    want = fill(sizes)
    for d, t, s in rows:
        assert a[d]["source_size"] == sizes[s] and a[d]["target"] == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], 3)
    # rates are an exponential tilt: longer documents further from 1, all on one side of it
    for s in ("s2", "s1"):
        r = sorted((x["size"], x["rate"]) for x in a.values() if x["source_size"] == sizes[s])
        assert r == sorted(r, key=lambda x: (x[0], x[1])) and (max(x[1] for x in r) <= 3.0)
        assert all((x[1] - 1) * (r[-1][1] - 1) >= 0 for x in r)


def test_bounds_are_optimal():
    import itertools
    values, counts = [1, 3, 4, 7, 9, 12], [5, 1, 8, 2, 2, 1]
    cost = lambda bounds: sum(c * (min(b for b in bounds if b >= v) - v) for v, c in zip(values, counts))
    for k in range(1, 7):
        best = min(cost((*c, 12)) for c in itertools.combinations(values[:-1], k - 1))
        got = packing.best_bounds(values, counts, k)
        assert len(got) <= k and got[-1] == 12 and cost(got) == best


def test_pack(spark, odd):
    out = packing.pack(odd, buckets=4, batch_tokens=512).collect()
    assert len(out) == len(odd_rows())
    sizes = Counter((r["doc_id"], len(SPLIT.findall(t or ""))) for r, t in [({"doc_id": d}, t) for d, t, *_ in odd_rows()])
    assert Counter((r["doc_id"], r["n_tokens"]) for r in out) == sizes
    per = defaultdict(list)
    for r in out:
        assert r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0
        per[r["batch"]].append(r)
    assert sorted(per) == list(range(len(per)))
    for rows in per.values():
        assert len({r["bucket"] for r in rows}) == 1
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or sum(r["bucket_len"] for r in rows) <= 512


def test_candidate_bounds(spark):
    df = spark.range(0, 5000).select("id", packing.candidate(F.col("id")).alias("v"))
    for r in df.collect():
        assert r["id"] <= r["v"] <= r["id"] * (1 + 1 / 128) + 1 and (r["id"] > 256 or r["v"] == r["id"])
