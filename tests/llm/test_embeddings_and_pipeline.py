import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import SCHEMA, odd_rows, words  # noqa: F401
from gridmetrics.llm import embedding_dedup
from test_text_operators import brute_components, brute_spans

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n=600, dim=16, seed=2):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    for i in range(n // 2):  # families at the border of the threshold
        x[n // 2 + i] = x[i % 40] + r.normal(size=dim) * r.choice([0.0, 0.1, 0.25, 0.3])
    return x.astype(np.float32)


def brute_links(rows):
    ok = {i: np.asarray(v, np.float64) for i, (_, v, *_) in enumerate(rows)
          if v and None not in v and np.isfinite(v).all() and np.any(v)}
    names, links, root = [d for d, *_ in rows], Counter(), {i: i for i in range(len(rows))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = list(ok)
    for a, i in enumerate(keys):
        for j in keys[:a]:
            u, v = ok[i], ok[j]
            if len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.95:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(names[i])
    return Counter((names[i], links[i], names[i] if i not in ok else min((x for x in least[find(i)] if x is not None), default=None))
                   for i in range(len(rows)))


def odd_vectors():
    one = [1.0, 0.0, 2.0]
    return [(9001, None, 0), (9002, [], 1), (9003, [0.0, 0.0], None), (9004, [1.0, None], 1), (9005, [1.0, float("nan")], 1),
            (9006, [float("inf"), 1.0], 1), (9007, one, 1), (9008, one, 2), (9008, one, 2), (9009, [2.0, 0.0, 4.0], 3), (None, one, 1),
            (9010, [1.0], 0), (9011, [-1.0], 0)]


@pytest.mark.parametrize("shard", [embedding_dedup.SHARD_ROWS, 40])
def test_links_by_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", shard)
    rows = [(i, v.tolist(), i % 5) for i, v in enumerate(vectors())] + odd_vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect())
    want = brute_links(rows)
    if shard != 40:
        assert got == want
    else:  # cells cut across the families: recall is audited, not certain
        true, found = (sum(n * c for (_, n, _), c in x.items()) for x in (want, got))
        assert found <= true and found >= 0.95 * true


def test_blocks_of_a_large_cell(spark, monkeypatch):
    """One cell with most vectors is dealt to blocks, and nothing is lost between them."""
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 20)
    monkeypatch.setattr(embedding_dedup, "MOST_CELLS", 1)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors(300))]
    got = Counter((r["vec_id"], r["n_links"], r["component_id"])
                  for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, VECTORS)).collect())
    assert got == brute_links(rows)


def test_empty_vectors(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    assert embedding_dedup.near_vectors(spark.createDataFrame(odd_vectors()[:6], VECTORS)).count() == 6


def test_prune_keeps_the_nearest_and_drops_the_hidden():
    x = embedding_dedup.unit(np.array([[1, 0.0], [1, 0.1], [1, 0.12], [1, -0.2]], np.float64))
    cand = np.array([[1, 2, 3]], np.int32)
    sims = x[[0]] @ x[[1, 2, 3]].T
    out = embedding_dedup.prune(x, cand, sims.astype(np.float32), 3)
    assert out[0].tolist() == [1, 3, -1]  # 2 is hidden behind 1, 3 lies the other way


# ---- pipeline --------------------------------------------------------------

def pipeline_rows():
    rows = []
    for i in range(260):
        text = words(60 + i % 90, i)
        if i % 20 == 3:
            text = " ".join(x + "###" for x in text.split())
        if i % 10 == 4:
            text += f" write to user{i}@mail.example now"
        rows.append((i, text, "en" if i % 3 else "de", f"s{i % 3}", len(text)))
    for i in range(60):
        w = rows[i][1].split()
        w[len(w) // 2] = "edited"
        rows.append((1000 + i, " ".join(w), rows[i][2], rows[i][3], None))
    # without the 30,000-word text: one copy of it is a whole source's target
    return rows + [(d and d + 5000, *x) for d, *x in odd_rows() if x[0] is None or len(x[0]) < 50_000]


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as cp
    from gridmetrics.llm.common import Scratch
    rows = pipeline_rows()
    scratch = Scratch(spark, "pipeline-test")
    docs = scratch.save(spark.createDataFrame(rows, SCHEMA), "docs")
    kept = []
    for name, stage in cp.STAGES:
        docs = scratch.save(stage(spark, docs, ""), "stage")
        kept.append(docs.collect())
    quality, unique, clean, mixed, packed = kept
    ids = {r["doc_id"] for r in quality}
    assert all((i % 20 == 3) != (i in ids) for i in range(260))          # junk goes, clean text stays
    assert not {5005, 5006, 5007, 5008, 5013} & ids                     # too short or repeating itself
    comps = brute_components([(r["doc_id"], r["text"]) for r in quality])
    want = {d for d, _, c in comps if c == d} | {d for d, _, c in comps if c is None}
    assert Counter(r["doc_id"] for r in unique) == Counter(want)        # one of each group
    assert all(not brute_spans(r["text"]) for r in clean) and any("[EMAIL]" in r["text"] for r in clean)
    assert all(r["n_chars"] == len(r["text"]) for r in clean if "[EMAIL]" in r["text"])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    before, after = Counter(), Counter()
    for r in clean:
        before[r["source"]] += size(r["text"])
    for r in mixed:
        after[r["source"]] += size(r["text"])
    total, weight = sum(before.values()), {s: i % 3 + 1 for i, s in enumerate(sorted(before))}
    for s in before:  # no source is short enough to stop at three times its size
        target = total * weight[s] / sum(weight.values())
        assert target > 3 * before[s] or abs(after[s] - target) < 0.02 * target + 200
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    assert Counter((r["doc_id"], r["text"]) for r in packed) == Counter((r["doc_id"], r["text"]) for r in mixed)
    assert [f.name for f in docs.schema.fields][:2] == ["doc_id", "n_tokens"]


def test_pipeline_run_and_empty(spark, tmp_path):
    import corpus_pipeline as cp
    spark.createDataFrame(pipeline_rows()[:80], SCHEMA).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert cp.run(spark, str(tmp_path / "a")).count() > 40
    assert cp.run(spark, str(tmp_path / "b")).count() == 0


# ---- vectors dealt to many cells -------------------------------------------

def border_pairs(n=500, dim=32, seed=4):
    """Isotropic vectors, each with one partner just above the threshold."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = r.normal(size=(n, dim))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = r.uniform(0.951, 0.955, (n, 1))
    return [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, c * x + np.sqrt(1 - c * c) * y]).astype(np.float32))]


@pytest.fixture
def rough_cells(monkeypatch):
    """Centroids fitted on so few vectors that they cut between partners."""
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 20)
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 40)


def test_audit_miss_searches_more_cells(spark, rough_cells, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELLS", 1)
    df = spark.createDataFrame(border_pairs(300), VECTORS).repartition(4)
    assert sum(r["n_links"] for r in embedding_dedup.near_vectors(df).collect()) >= 0.97 * 600


def test_low_recall_fails(spark, rough_cells, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELLS", 1)
    monkeypatch.setattr(embedding_dedup, "TRIES", 1)
    df = spark.createDataFrame(border_pairs(300), VECTORS).repartition(4)
    with pytest.raises(RuntimeError, match="audited links"):
        embedding_dedup.near_vectors(df)


def test_audit_holds_enough_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "AUDIT_LINKS", 200)
    scratch = embedding_dedup.Scratch(spark, "audit-test")
    rows = [(i, 1, v) for i, v, _ in border_pairs()]
    schema = "node long, m long, vec array<float>"
    truth, due = embedding_dedup.audit_truth(scratch, spark.createDataFrame(rows, schema), len(rows))
    assert due >= 200
    heavy = spark.createDataFrame([(i, 3, v) for i, _, v in rows], schema)  # links of rows: every vector three times
    assert embedding_dedup.row_pairs(embedding_dedup.sample_truth(scratch, heavy, len(rows))) == 9 * embedding_dedup.row_pairs(
        embedding_dedup.sample_truth(scratch, spark.createDataFrame(rows, schema), len(rows)))


def test_edges_between_shards_are_followed(spark, rough_cells, monkeypatch):
    """One search, no audit: what lies one edge away in another cell is found."""
    monkeypatch.setattr(embedding_dedup, "RECALL", 0)
    monkeypatch.setattr(embedding_dedup, "LEAST_RECALL", 0)
    r = np.random.default_rng(8)
    centre = np.repeat(r.normal(size=(30, 32)), 20, axis=0)
    x = centre + 0.2 * r.normal(size=centre.shape)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]
    true = sum(n * c for (_, n, _), c in brute_links(rows).items())
    got = sum(r["n_links"] for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, VECTORS).repartition(4)).collect())
    assert 0.99 * true <= got <= true


# ---- shingle width ---------------------------------------------------------

def brute_five(rows):
    """Components at 0.8 on 5-word shingles: the least place in each."""
    sets = [[w[i:i + 5] for i in range(max(1, len(w) - 4))] if (w := tuple(t.lower().split())) else [] for _, t in rows]
    sets, root = [set(s) for s in sets], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {d: (len(sets[i]), rows[find(i)][0]) for i, (d, _) in enumerate(rows)}


def revised_rows():
    """Texts with 1 to 6 % of the words changed, and texts of few words."""
    rows = []
    for f in range(8):
        base = words(200, 700 + f).split()
        for c in range(8):
            w = list(base)
            for k in range(2 * c):
                w[7 + 13 * k] = f"rev{f}x{c}x{k}"
            rows.append((len(rows), " ".join(w)))
    for t in ("one", "one two", "one two three", "one two three four", "one two three four five", "one two three four five six"):
        rows += [(len(rows), t), (len(rows) + 1, t.upper())]
    return rows


def test_pipeline_dedup_takes_five_words(spark):
    import corpus_pipeline as cp
    rows = revised_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_five(rows)
    two = {d for d, _, c in brute_components(rows) if c == d}
    kept = {d for d, (_, c) in want.items() if c == d}
    assert kept != two and {r["doc_id"] for r in cp.deduplicate(spark, df, "").collect()} == kept


def test_near_duplicates_of_five_words(spark):
    from gridmetrics.llm import minhash
    rows = revised_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, width=5).collect()}
    assert got == brute_five(rows)


def test_double_vectors_are_compared_as_doubles(spark):
    """Cosines next to the threshold that single precision rounds across it, and entries it has no number for."""
    over, under = 0.95 + 1e-12, 0.95 - 1e-12
    rows = [(1, [1.0, 0.0]), (2, [over, (1 - over**2) ** 0.5]), (3, [under, -((1 - under**2) ** 0.5)]),
            (4, [0.0, 1e-60]), (5, [0.0, 2e-60]), (6, [1e300, -1e300]), (7, [-1.0, 1.0]), (8, [1e-200, -1e-200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df).collect()}
    assert {k: (r["n_links"], r["component_id"]) for k, r in out.items()} == {
        1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (0, 7), 8: (1, 6)}
