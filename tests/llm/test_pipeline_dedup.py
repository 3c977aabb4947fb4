from collections import Counter

from llm_fixtures import words


def test_one_row_of_each_group_where_ids_repeat(spark):
    """Similar texts with the same doc_id are one group; other texts with that doc_id are not."""
    import corpus_pipeline as cp
    a, b, c = words(150, 1), words(150, 2), words(150, 3)
    rows = [(7, a), (7, a + " more"), (8, a + " again"), (9, b), (9, c), (9, c), (10, None), (10, ""), (7, b + " end"), (None, words(90, 4))]
    got = cp.deduplicate(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    per = Counter((r["doc_id"], (r["text"] or "")[:9]) for r in got)
    assert per == Counter({(7, a[:9]): 1, (7, b[:9]): 1, (9, c[:9]): 1, (10, ""): 2, (None, words(90, 4)[:9]): 1})


def test_one_row_of_a_group_without_any_id(spark):
    import corpus_pipeline as cp
    a, b = words(150, 5), words(150, 6)
    rows = [(None, a, "x"), (None, a + " more", "y"), (None, a + " more", "z"), (None, b, "x"), (3, b + " end", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [sorted(map(tuple, cp.deduplicate(spark, df.repartition(n), "").collect()), key=str) for n in (2, 5)]
    assert got[0] == got[1] and [r[0] for r in got[0]] == [3, None] and got[0][1][1].startswith(a)


def test_filter_grows_with_the_texts():
    from gridmetrics.llm import minhash
    assert minhash.filter_size(0) == minhash.filter_size(500_000) == minhash.FILTER_BITS
    assert 16 * 3_000_000 <= minhash.filter_size(3_000_000) <= 32 * 3_000_000
    assert minhash.filter_size(10**10) == minhash.MOST_BITS


def test_links_are_the_same_over_salted_groups(spark, monkeypatch):
    from gridmetrics.llm import minhash
    a = words(60, 7).split()
    texts = [" ".join(a[:i] + [f"n{i}"] + a[i + 1:] + ["z"] * (i % 3)) for i in range(50)] + [" ".join(a[k:] + a[:k]) for k in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lambda: sorted(map(tuple, minhash.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()))
    want = found()
    monkeypatch.setattr(minhash, "MOST_MIXED", -1)
    assert found() == want
