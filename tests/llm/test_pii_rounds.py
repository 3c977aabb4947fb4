"""The contextual spans against a plain version of the rounds, and long texts."""
import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridmetrics.llm import pii

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
WORD = r"[^\x20\x09-\x0D]+"


def passes(kind, v):
    d = [int(c) for c in v if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def neighbours(found, text, i):
    """Words beside the i-th of the matches (start, end) of one pattern."""
    s, e = found[i]
    before = text[found[i - 1][1] if i else 0:s]
    before = re.sub(r"[\"'(\[{<]+$", "", before)
    ends_in = lambda t: (re.search(rf"({WORD})[\x20\x09-\x0D]*$", t) or [None, ""])[1]
    left = ends_in(before) or (ends_in(text[slice(*found[i - 1])]) if i else "")
    after = text[e:found[i + 1][0] if i + 1 < len(found) else len(text)]
    if re.fullmatch(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+", after):
        following = text[slice(*found[i + 1])] if i + 1 < len(found) else ""
        right = (re.match(WORD, following) or [""])[0]
    else:
        right = (re.match(rf"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+({WORD})", after) or [None, ""])[1]
    key = lambda w: hashlib.sha256(w.encode()).hexdigest() if len(w) > 64 else w
    return tuple(key(re.sub("[1-9]", "0", w.lower())) for w in (left, right))


def brute(rows):
    """{doc_id: all spans} by the rounds over plain lists."""
    base, items, tokens = {}, [], []
    for doc, text in rows:
        text = text or ""
        base[doc], taken = [], []
        for kind, pattern in BASE:
            found = [m.span() for m in re.finditer(pattern, text)]
            for i, (s, e) in enumerate(found):
                v = text[s:e]
                if kind == "card" and not 14 <= len(re.sub("[^0-9]", "", v)) <= 19:
                    continue
                taken.append((s, e))
                if passes(kind, v):
                    base[doc].append((s, [k for k, _ in BASE].index(kind), e))
                    items.append((v.lower(), True, *neighbours(found, text, i)))
        found = [m.span() for m in re.finditer(WORD, text) if re.search("[0-9@]", m[0])]
        for i, (s, e) in enumerate(found):
            v = text[s:e]
            short = re.sub(r"^[\"'(\[{<]+", "", v)
            s += len(v) - len(short)
            v = re.sub(r"[\"')\]}>.,;:!?]+$", "", short)
            e = s + len(v)
            if len(v) >= 6 and (len(re.findall("[0-9]", v)) >= 3 or re.match("[^@]+@", v)) and not any(a < e and b > s for a, b in taken):
                left, right = neighbours(found, text, i)
                items.append((v.lower(), False, left, right))
                tokens.append((doc, s, e, v.lower()))
    edges = defaultdict(dict)
    for v, seed, left, right in items:
        for p in ([f"l {left}"] if left else []) + ([f"r {right}"] if right else []) + ([f"b {left} {right}"] if left and right else []):
            edges[p][v] = edges[p].get(v, False) or seed
    known, last = {}, None
    while True:
        rated = {}
        for p, vs in edges.items():
            score = [max(float(seed), known.get(v, 0.0)) for v, seed in vs.items()]
            support = sum(x > 0 for x in score)
            if support >= pii.LEAST_SUPPORT and sum(score) / len(score) >= pii.LEAST_CONFIDENCE:
                rated[p] = (sum(score) / len(score), support)
        by_value = defaultdict(list)
        for p, r in rated.items():
            for v, seed in edges[p].items():
                if not seed:
                    by_value[v].append(r)
        known = {}
        for v, rs in by_value.items():
            score = 1 - math.prod(max(1 - c, 1e-9) for c, _ in rs)
            alone = any(n >= pii.ALONE_SUPPORT and c >= pii.LEAST_SCORE for c, n in rs)
            if alone or len(rs) >= 2 and score >= pii.LEAST_SCORE:
                known[v] = score
        now = (set(known), set(rated), round(sum(known.values()), 3))
        if now == last:
            break
        last = now
    for doc, s, e, v in tokens:
        if v in known:
            base[doc].append((s, 4, e))
    return {doc: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(x)) for doc, x in base.items()}


def card(r):
    while True:
        v = "".join(r.choice("0123456789") for _ in range(16))
        if passes("card", v):
            return v


def records(seed, n=160):
    r = random.Random(seed)
    number = lambda: f"AB{r.randrange(10**6):06d}"
    kinds = [lambda: f"u{r.randrange(30)}@mail.example.org", lambda: card(r), lambda: f"10.0.{r.randrange(300)}.{r.randrange(256)}",
             lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(10**4):04d}", number, number, lambda: "12,345.678", lambda: "x@y"]
    labels = ["Contact:", "ID:", "ref", "(see", "mail <", "Über", "account no.", "w" * 70]
    rows = []
    for doc in range(n):
        bits = []
        for _ in range(r.randrange(0, 7)):
            if r.random() < 0.5:  # a label that stands before personal data, and now and then before something unseen
                value = number() if r.random() < 0.06 else f"p{r.randrange(10**4)}@{r.choice('abc')}.net"
                bits += [r.choice(["Contact:", "Über"]), " ", value, r.choice([" ", " please "]), "\n"]
                continue
            bits += [r.choice(labels[1:5] + labels[6:]), r.choice(["", " ", "\n"]), r.choice(kinds)(), r.choice(["", " ", "). ", "\t", "@", ";"]),
                     r.choice(["please", "thanks", "", "日本"]), " "]
        rows.append((doc, "".join(bits)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contextual_spans_equal_plain_rounds(spark, seed):
    rows = records(seed)
    want = brute(rows)
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.spans for r in out} == want
    assert any("found" in s for s in want.values())


def test_redaction_equals_cutting(spark):
    rows = records(5, 60) + [(1000, "日" * 3000 + " a@b.cd " + "x" * 2500 + " 10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii.personal_data(df, carry=["text"]).select("items", "row.text", pii.redact(F.col("row.text"), F.col("items")).alias("clean"))
    for r in out.collect():
        want, at = [], 0
        for s, k, e in r["items"]:
            if s >= at:
                want += [r.text[at:s], f"[{pii.KINDS[k].upper()}]"]
            at = max(at, e)
        assert r.clean == "".join(want) + r.text[at:]


def long_text(size):
    out, n, i = [], 0, 0
    while n < size:
        out.append(f"item{i:07d} ok id: u@y{i % 50}.com (q{i}) 10.0.0.{i % 300} ")
        n += len(out[-1])
        i += 1
    return "".join(out)


def test_one_long_text_takes_time_in_proportion(spark):
    def seconds(size):
        df = spark.createDataFrame([(1, long_text(size))], "doc_id long, text string")
        begin = time.time()
        out = pii.personal_data(df, carry=["text"])
        clean = out.select("n_email", F.length(pii.redact(F.col("row.text"), F.col("items"))).alias("n")).first()
        assert clean.n_email == long_text(size).count("u@y")
        return time.time() - begin
    seconds(20_000)
    start, one, three = seconds(20_000), seconds(500_000), seconds(1_500_000)
    assert three - start <= 8 * max(one - start, 1)
