from collections import defaultdict

from gridmetrics.llm import packing


def test_no_bucket_is_longer_than_its_longest_member(spark):
    lengths = [300 + 7 * i for i in range(60)] + [1001, 2003, 4007, 5, 17]
    df = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    longest, bound, padded = defaultdict(int), {}, 0
    for r in packing.pack(df, buckets=6).collect():
        longest[r["bucket"]] = max(longest[r["bucket"]], r["n_tokens"])
        bound[r["bucket"]] = r["bucket_len"]
        padded += r["bucket_len"]
        assert r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0
    assert bound == dict(longest)
    values = sorted(set(lengths))
    best = packing.best_bounds(values, [lengths.count(v) for v in values], 6)
    least = sum(min(b for b in best if b >= n) for n in lengths)
    assert least <= padded <= least * (1 + 1 / 128)
