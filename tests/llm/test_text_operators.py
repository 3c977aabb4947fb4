import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import clashing, none, odd, odd_rows, words  # noqa: F401
from gridmetrics.llm import importance, minhash, pii, sharding, suffix_dedup, token_output
from gridmetrics.llm import common
from gridmetrics.llm.common import Scratch

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")

# ---- personal data ---------------------------------------------------------

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        s = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and s % 10 == 0
    return kind != "phone" or 10 <= len(d) <= 15


def brute_spans(text):
    out = [(m.start(), k, m.end()) for k, (name, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if valid(name, m[0])]
    return ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(out))


def pii_texts():
    r = random.Random(5)
    fixed = ["a@b.c+x@y.z", "a@b@c.d e@f", "x@y..z @q.r a@b.-c", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "é日 4111 1111-1111 1111😀 +1 (555) 555-5555",
             "4111111111111111 4111111111111112", "+1 2 +12345678901234567890", "1" * 3000 + "." + "2" * 50, "a" * 20_000 + "@" + "b." * 5000 + "c",
             "1-2-" * 4000, "9!" * 9000, ",".join(["a@b.co"] * 500), None, "", "+" * 5000]
    soup = ["".join(r.choice("ab1290.@+-() ,éß日") for _ in range(r.randrange(60))) for _ in range(1500)]
    return fixed + soup


def test_base_spans_by_brute_force(spark):
    texts = pii_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in pii.personal_data(df).collect():
        want = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (texts[r["doc_id"]], want, r["spans"])
        kinds = Counter(x.split(":")[0] for x in want.split(",") if x)
        assert [r[f"n_{k}"] for k, _ in PATTERNS] == [kinds[k] for k, _ in PATTERNS]
        assert set(want.split(",")) - {""} <= set(r["spans"].split(","))


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"{words(5, i)} write to user{i}@mail.example please {words(5, i + 900)}") for i in range(30)]
    rows += [(100 + i, f"{words(5, i)} write to id-{i}-99{i}77x please {words(5, i + 500)}") for i in range(3)]
    rows += [(200 + i, f"{words(8, i)} chapter 1{i}0{i}7b4 {words(8, i)}") for i in range(20)]
    out = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        found = [x for x in out[i].split(",") if x.startswith("found")]
        if 100 <= i < 200:
            _, a, b = found[0].split(":")
            assert text[int(a):int(b)].startswith("id-")
        else:
            assert not found  # what no trusted pattern extracts stays


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.co, call +1 555 555 5555 now"), (2, None), (3, "plain")], "doc_id long, text string")
    out = pii.personal_data(df, carry=["text"]).withColumn("clean", pii.redact(F.coalesce("row.text", F.lit("")), F.col("items")))
    got = {r["doc_id"]: r["clean"] for r in out.collect()}
    assert got == {1: "mail [EMAIL], call [PHONE] now", 2: "", 3: "plain"}


# ---- shards ----------------------------------------------------------------

def test_shards(spark):
    texts = [words(20, i) for i in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i % 40]) for i in range(400)]
    rows += [(3000 + i, "the hot text") for i in range(500)] + [(5000 + i, None) for i in range(20)]
    out = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = {r["doc_id"]: r for r in out.collect()}
    per, groups = defaultdict(list), defaultdict(set)
    for d, t in rows:
        assert got[d]["size"] == len((t or "").encode()) + 1 and got[d]["text_crc32"] == zlib.crc32((t or "").encode())
        per[got[d]["shard"]].append(got[d]["slot"])
        if t is not None:
            groups[t].add(got[d]["shard"])
    sizes = [len(per[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in per.values())
    assert {r["law"] for r in got.values()} == {"rows"} and {r["grown_shard"] for r in got.values()} == {None}
    whole = sum(len(s) == 1 for t, s in groups.items() if t != "the hot text")
    assert whole >= 0.95 * (len(groups) - 1)     # links are kept together ...
    hot = sorted(Counter(got[d]["shard"] for d, t in rows if t == "the hot text").values())
    assert sum(hot[-4:]) >= 0.9 * 500            # ... and a group beyond a shard's room fills few shards
    assert sharding.cut_links(out).first()["cut"] < 0.78 * sharding.cut_links(out).first()["links"]


# ---- near-duplicates -------------------------------------------------------

def shingles(text):
    w = SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    return [(d, len(sets[i]), d if not sets[i] else min((x for x in ids[find(i)] if x is not None), default=None))
            for i, (d, _) in enumerate(rows)]


def near_rows(seed=1):
    """Families of near copies: many at the border of 0.8, chains, exact copies."""
    r, rows = random.Random(seed), []
    for f in range(12):
        base = words(40 + 20 * f, 100 + f).split()
        for _ in range(25):
            w = list(base)
            for _ in range(r.randrange(max(1, len(w) // 8))):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            rows.append((len(rows), " ".join(w).upper() if r.random() < 0.2 else " ".join(w)))
            base = w if f % 3 == 0 else base
    return rows


@pytest.mark.parametrize("block", [minhash.BLOCK_SHINGLES, 300])
def test_near_duplicates_by_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(minhash.across, "__defaults__", (block,))
    rows = near_rows() + [(d, t) for d, t, *_ in [(x[0] and x[0] + 2000, x[1]) for x in odd_rows()]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect())
    assert got == Counter(brute_components(rows))


def test_circulant_signature_estimates_similarity():
    r = np.random.default_rng(0)
    a = r.integers(0, 2 ** 63, 4000).astype(np.uint64)
    s = np.concatenate([a[:3000], a[1000:]])
    hits = []
    for band in range(0, 64):
        base = minhash.sigma(s.astype(np.uint32)) - np.uint32(band)
        low = np.minimum.reduceat(minhash.pi_inplace(base, np.empty_like(base)), [0, 3000])
        hits.append(low[0] == low[1])
    assert abs(np.mean(hits) - 0.5) < 0.2
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65521)
    assert len(np.unique(minhash.sigma(x))) == len(x) == len(np.unique(minhash.pi_inplace(x.copy(), np.empty_like(x))))


# ---- repeated strings ------------------------------------------------------

def brute_cut(texts, n=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for i in range(len(d) - n + 1):
            if count[d[i:i + n]] > 1:
                gone[i] += 1
                gone[i + n] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(d) else 0
        rest = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def repeat_texts():
    r = random.Random(9)
    passage = [words(80, 50 + i) for i in range(6)]
    texts = [t for _, t, *_ in odd_rows() if t is None or len(t) < 20_000]
    for i in range(120):
        parts = [words(r.randrange(60), 1000 + i)]
        for _ in range(r.randrange(3)):
            p = r.choice(passage)
            a = r.randrange(100)
            parts += [p[a:a + r.choice([150, 199, 200, 201, 230, 300])], words(r.randrange(40), 3000 + i + r.randrange(99))]
        texts.append(" ".join(parts))
    texts += ["ab" * 300, "é" * 250, passage[0] * 3, passage[1] + "é" * 90]
    near = words(400, 77).split()
    for i in range(20):
        w = list(near)
        w[r.randrange(400)] = "edit" + "x" * i
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("block", [suffix_dedup.BLOCK, 2])
def test_repeats_by_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)  # 2: most cores are compared across buckets
    texts = repeat_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == dict(enumerate(brute_cut(texts)))


def test_suffixes_are_sorted_by_bytes():
    """The multikey sort gives the byte order of all suffixes, and finds the equal ones."""
    r = random.Random(11)
    left, right, n = suffix_dedup.LEFT, suffix_dedup.RIGHT, suffix_dedup.LENGTH
    base = [bytes(r.choice(b"\x00\x01a\xff") for _ in range(left + right)) for _ in range(4)]
    parts, before = [], []
    for _ in range(120):
        x = bytearray(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 3])):
            x[r.randrange(len(x))] = r.choice(b"\x00\x80\xff")
        lo, hi = r.choice([0, 0, 5, left]), len(x) - r.choice([0, 0, 3, right])
        parts.append(bytes(x[lo:max(hi, lo + 41)]))
        before.append(left - lo)
    before = np.array(before)
    after = np.array([len(x) for x in parts]) - before
    tokens = suffix_dedup.token_table(before, parts)
    for start in (0, 1, 7, 80, 159):
        rows = np.flatnonzero((before >= start) & (after >= n - start))
        order, same = suffix_dedup.multikey_sort(tokens, rows, left - start)
        found = [parts[i][before[i] - start:before[i] - start + n] for i in order]
        assert sorted(order) == sorted(rows) and found == sorted(found)
        assert same.tolist() == [i > 0 and found[i] == found[i - 1] for i in range(len(found))]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_is_the_join(spark, how):
    """Heavy, light, unmatched and null keys; the heavy group is dealt to many salts."""
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 5 == 0 else f"k{i % 700}") for i in range(6000)],
                                 "i long, k string").repartition(4)
    groups = (rows.filter("k IS NOT NULL AND k <> 'k1'").groupBy("k").agg(F.count("*").alias("c"))
              .withColumn("v", F.length("k")))
    got = common.spread_join(rows, groups, ["k"], 6000, how)
    assert got.columns == ["k", "i", "c", "v"]
    assert sorted(got.collect(), key=str) == sorted(rows.join(groups, "k", how).collect(), key=str)
    assert common.spread_join(rows.limit(0), groups.limit(0), ["k"], 0, how).count() == 0


def test_anchors_are_local():
    """Any 200 bytes hold an anchor at the same offset of at most 159, wherever they stand."""
    r = np.random.default_rng(3)
    for _ in range(30):
        s = r.integers(97, 101, 200).astype(np.uint8)
        sets = []
        for _ in range(2):
            pre, post = (r.integers(97, 101, r.integers(0, 300)).astype(np.uint8) for _ in range(2))
            at = suffix_dedup.anchor_places(np.concatenate([pre, s, post])) - len(pre)
            sets.append({int(x) for x in at if 0 <= x < suffix_dedup.SPAN})
        assert sets[0] & sets[1]


# ---- token files -----------------------------------------------------------

def library():
    """The tokenizer as its file has it."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(token_output.vocabulary())


def test_token_files_round_trip(spark, odd):
    tokenizer = library()
    rows = sorted(odd_rows(), key=lambda x: (x[0] is not None, x[0])) + [(99, "a <|endoftext|> b<|endoftext|><|endoftext|", "en", "s0", None)]
    odd = odd.unionByName(spark.createDataFrame(rows[-1:], odd.schema))
    scratch = Scratch(spark, "token-test")
    folder = scratch.path("files")
    manifest = token_output.write_tokens(odd, folder, scratch, sequence=64, file_ids=5000)
    out = token_output.read_tokens(manifest, folder).orderBy("start").collect()
    at = 0
    for r, (d, text, *_) in zip(out, rows):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    files = {r["file"] for r in manifest.select("file").collect()}
    assert len(files) > 1
    for name in files:
        f = token_output.TokenFile(folder, name)
        batch = f.reader.get_batch(0)
        assert pa.types.is_fixed_size_list(batch.schema.field("ids").type) and batch.schema.field("mask").type.list_size == 64
    last = f.reader.get_batch(f.reader.num_record_batches - 1)
    ids, mask = (last.column(c).values.to_numpy(zero_copy_only=c == "ids") for c in ("ids", "mask"))
    assert ids[mask][-1] == 2 and not ids[~mask].any()


def test_pieces_equal_whole_texts():
    encoder, tokenizer = token_output.Encoder(token_output.vocabulary()), library()
    r = random.Random(3)
    alphabet = ["a", "b", "The", " ", "\n", ".", ",", "'s", "é", "ß", "”", "×", "1", " ", " ", "\t", "x", "日", " ", "’", "word", " ", "<|endoftext|>"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(30))) for _ in range(4000)]
    encoder.KNOWN = 500  # begins afresh now and then
    for _, _, data, offsets in token_output.chunks(pa.array(texts), 1 << 12):
        got = encoder(data, offsets)
        want = [tokenizer.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids for a, b in zip(offsets, offsets[1:])]
        assert [x.tolist() for x in got] == want


def test_long_texts_are_encoded_in_sections(monkeypatch):
    """Sections of a long text give the ids of the whole text, wherever they are cut."""
    encoder, tokenizer = token_output.Encoder(token_output.vocabulary()), library()
    r = random.Random(5)
    for alphabet in (["a", "The", " ", " ", "\n", ".", ",", "'s", "é", "日", "word", "1", "'", "-"],
                     ["ab", "x", " ", "\n", "\t", "\u3000", "\u00a0", "\r\n", "!", "<|endoftext|>", "日本", "'re"]):
        for size in (16, 61, 300):
            monkeypatch.setattr(token_output, "PART", size)
            text = "".join(r.choice(alphabet) for _ in range(3000)) + "z" * 700 + " end"
            data = np.frombuffer(text.encode(), np.uint8)
            bounds = list(token_output.sections(data, size, encoder.visible))
            assert len(bounds) > 3 and [a for a, _ in bounds[1:]] == [b for _, b in bounds[:-1]] and bounds[-1][1] == len(data)
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert encoder(data, np.array([0, len(data)]))[0].tolist() == ids
            both = encoder(np.concatenate([data, data[:40]]), np.array([0, len(data), len(data), len(data) + 10]))
            assert both[0].tolist() == ids and not len(both[1])


def test_encoder_memory_is_bounded():
    """Neither a long text nor ever new words take an encoder beyond its bounds."""
    import tracemalloc

    encoder, r = token_output.Encoder(token_output.vocabulary()), np.random.default_rng(6)
    tracemalloc.start()
    try:
        for size in (1 << 20, 6 << 20):
            data = r.integers(97, 123, size).astype(np.uint8)
            data[np.cumsum(r.integers(3, 9, size // 10))] = 32
            assert len(encoder(data, np.array([0, size]))[0]) > size // 5
        assert tracemalloc.get_traced_memory()[1] < 128 << 20
        assert len(encoder.keys) < 3 * encoder.KNOWN // 2
    finally:
        tracemalloc.stop()


def test_texts_are_read_and_sent_in_small_batches(spark, odd):
    """While the files are written; then the session has its own settings again."""
    keys = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    seen, settings = [], lambda: [int(spark.conf.get(k)) for k in keys]

    class Seen(Scratch):
        def save(self, df, name):
            seen.append(settings())
            return super().save(df, name)

    before, scratch = settings(), Seen(spark, "token-test")
    token_output.write_tokens(odd, scratch.path("files"), scratch)
    assert len(seen) == 1 and seen[0][0] <= 64 and seen[0][1] <= 256
    assert settings() == before


def test_special_tokens_as_text():
    encoder, tokenizer = token_output.Encoder(token_output.vocabulary(), special_as_text=True), library()
    tokenizer.encode_special_tokens = True
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y"):
        data = np.frombuffer(text.encode(), np.uint8)
        assert encoder(data, np.array([0, len(data)]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    """With a hash that tells next to nothing, the ids are still those of the texts."""
    monkeypatch.setattr(token_output, "mix64", lambda x: x % np.uint64(7))
    encoder, tokenizer = token_output.Encoder(token_output.vocabulary()), library()
    r = random.Random(8)
    for _ in range(20):
        texts = [" ".join(r.choice(["one", "two", "three", "é", "日本", "word"]) for _ in range(r.randrange(6))) for _ in range(30)]
        _, _, data, offsets = next(token_output.chunks(pa.array(texts)))
        assert [x.tolist() for x in encoder(data, offsets)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# ---- importance resampling -------------------------------------------------

def corpus(spark, n=1200):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        rows.append((i, words(100, i) if good else " ".join("zz" + x for x in words(100, i).split())))
        if i % 3 == 0:
            labels.append((i, int(good)))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
            spark.createDataFrame(labels + labels[:5], "doc_id long, quality int"))


def test_resampling_prefers_target_text(spark):
    docs, labels = corpus(spark)
    out = importance.importance_resample(docs, labels).collect()
    assert sum(r["kept"] for r in out) == 900  # the share of good documents among the labelled
    held_out = [r for r in out if r["doc_id"] % 3]
    assert np.mean([r["kept"] == (r["doc_id"] % 4 != 0) for r in held_out]) > 0.93
    again = importance.importance_resample(docs, labels).collect()
    assert {(r["doc_id"], r["kept"]) for r in out} == {(r["doc_id"], r["kept"]) for r in again}


def test_weights_by_brute_force(spark):
    docs, labels = corpus(spark, 200)
    scratch = Scratch(spark, "importance-test")
    ratio, share = importance.fit(docs, labels, scratch)
    raw, target = np.ones(importance.BINS), np.ones(importance.BINS)
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    bins = {}
    for r in docs.collect():
        d = np.frombuffer(r["text"].encode(), np.uint8)
        bins[r["doc_id"]] = np.concatenate([b for b, _ in importance.ngram_bins(d, np.array([0, len(d)]))])
        for x in bins[r["doc_id"]]:
            raw[x] += 1
            target[x] += r["doc_id"] in good
    h = importance.BINS // 2
    want = np.concatenate([np.log(target[s] / target[s].sum()) - np.log(raw[s] / raw[s].sum()) for s in (slice(0, h), slice(h, None))])
    assert np.allclose(ratio, want) and share == pytest.approx(0.75, abs=0.03)
    got = {r["doc_id"]: r["log_weight"] for r in importance.importance_resample(docs, labels).collect()}
    assert all(got[k] == pytest.approx(want[v].sum(), abs=1e-6) for k, v in bins.items())


def test_weights_and_keys_do_not_depend_on_partitions(spark):
    docs, labels = corpus(spark, 300)
    docs = docs.unionByName(docs.filter("doc_id < 40").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.unionByName(spark.createDataFrame([(None, "same text here")] * 20 + [(None, ""), (None, None)], docs.schema))
    rows = [sorted(importance.importance_resample(docs.repartition(n), labels, keep_share=0.5).collect(), key=str) for n in (3, 7)]
    assert rows[0] == rows[1]
    unnumbered = [r for r in rows[0] if r["doc_id"] is None]
    assert len({r["key"] for r in unnumbered if r["n_words"] == 3}) == 1  # equal rows tie
    noise = {r["key"] - r["log_weight"] for r in unnumbered if r["n_words"] > 3}
    assert len(noise) == 40


@pytest.mark.parametrize("k", [1, 7, 500, 4999, 5000])
def test_kth_largest(spark, k, monkeypatch):
    monkeypatch.setattr(importance, "FEW", 20)
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(900)) * 1.0).alias("key")).repartition(4)
    want = sorted((r["key"] for r in df.collect()), reverse=True)[k - 1]
    got = importance.kth_largest(df, k, 5000)
    assert got == want or (k == 5000 and got == float("-inf"))


# ---- odd input -------------------------------------------------------------

def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (pii.personal_data(none), sharding.balanced_shards(none), minhash.near_duplicates(none), suffix_dedup.remove_repeats(none),
                token_output.token_output(none), importance.importance_resample(none, labels)):
        assert out.count() == 0


def test_odd_rows_and_clashing_names(spark, clashing):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (8, 0)], "doc_id long, quality int")
    n = len(odd_rows())
    for out in (pii.personal_data(clashing, carry=clashing.columns), sharding.balanced_shards(clashing), minhash.near_duplicates(clashing),
                suffix_dedup.remove_repeats(clashing), token_output.token_output(clashing),
                importance.importance_resample(clashing, labels)):
        assert out.count() == n
