"""Operator 4: near-duplicates by circulant MinHash.

A document is the set of its distinct shingles of 2 words (or another width; a
shorter text is one shingle). Two permutations of the
32-bit universe make the whole signature: ``sigma`` scatters the shingles, and
coordinate k is the least ``pi(sigma(shingle) - k)``, that is ``pi`` shifted
circularly by k. Signatures are cut into ``BANDS`` bands of ``ROWS`` rows; a
pair at similarity 0.8 misses all bands with probability (1 - 0.8^5)^32 = 3e-6.

Documents with equal sets are one node (their links need no check). Each band
bucket compares its members with one of them, its hub: first the least node,
then the one with most links so far, which in a group of near copies is the
text that all of them stem from. Linked nodes are united. What is left are
pairs that share a bucket, and so a hub, but lie in different components. They
are compared hub by hub: the members outside the largest component of a hub's
group against all members, in blocks of bounded size, each block pair a task
that gives out only the links it finds. So each pair of nodes that shares a
band is compared on full sets or already connected; there is no cap, and no
pairs are listed.

Defined cases: null or empty text, or text without words, has an empty set, is
its own component and is kept; repeated rows and ties fall into one component;
rows without doc_id take part in links, and their component is named by the
least doc_id in it (null if there is none, kept false); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components
from .texthash import chunks, mix64, run_hashes, word_hashes

BANDS, ROWS = 32, 5
PERCENT = 80
#: Text bytes signed at once: the shingles of a part stay in a core's cache.
PART = 1 << 20
#: Bits of the filter for texts that are read again: at least, for each of these texts, and at most (1 MB, 2 bytes, 128 MB).
FILTER_BITS, BITS_EACH, MOST_BITS = 1 << 23, 16, 1 << 30
#: Groups of several components whose rows (four numbers) are broadcast; beyond, they are joined over salted keys.
MOST_MIXED, SALTS = 200_000, 32
#: Shingles of one block of a group whose members are compared.
BLOCK_SHINGLES = 250_000


def sigma(x: np.ndarray) -> np.ndarray:
    """First permutation of the 32-bit integers."""
    x = x ^ (x >> np.uint32(17))
    x *= np.uint32(0xED5AD4BB)
    x ^= x >> np.uint32(11)
    x *= np.uint32(0xAC4C1B51)
    x ^= x >> np.uint32(15)
    return x


def pi_inplace(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Second permutation, overwriting ``x``."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    return np.bitwise_xor(x, spare, out=x)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of each row, ascending; row bounds)."""
    w, at = word_hashes(data, offsets, lower=True)
    p, pat = run_hashes(w, at, width)
    for i, j in zip(pat[:-1].tolist(), pat[1:].tolist()):
        if j - i > 1:
            p[i:j].sort()
    new = np.ones(len(p), bool)
    if len(p):
        new[1:] = p[1:] != p[:-1]
        new[pat[:-1][np.diff(pat) > 0]] = True
    return p[new], np.concatenate([[0], np.cumsum(new)])[pat]


def fingerprints(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a row's whole set (0, 0 for an empty one)."""
    out = []
    full = np.diff(at) > 0
    for c in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        f = np.zeros(len(at) - 1, np.uint64)
        if full.any():
            f[full] = np.add.reduceat(mix64(s ^ np.uint64(c)), at[:-1][full])
        out.append(f.view(np.int64))
    return out[0], out[1]


def signatures(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Band keys (rows x BANDS) of the non-empty rows."""
    starts = at[:-1][np.diff(at) > 0]
    base = sigma(s.astype(np.uint32))
    x, spare = np.empty_like(base), np.empty_like(base)
    keys = np.empty((len(starts), BANDS), np.int64)
    for band in range(BANDS):
        key = np.full(len(starts), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            np.subtract(base, np.uint32(k), out=x)
            low = np.minimum.reduceat(pi_inplace(x, spare), starts)
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low)
        keys[:, band] = key.view(np.int64)
    return keys


def signer(width: int):
    """mapInArrow function: doc_id, text_key, n, f1, f2, bands (null for an empty set)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column("text"), PART):
                s, at = shingle_sets(data, offsets, width)
                n = np.diff(at)
                f1, f2 = fingerprints(s, at)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                keys = signatures(s, at).ravel() if len(s) else np.zeros(0, np.int64)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys), mask=pa.array(n == 0))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(n.astype(np.int64)), pa.array(f1),
                     pa.array(f2), bands], names=["doc_id", "text_key", "n", "f1", "f2", "bands"])
    return sign


def full_sets(wanted: np.ndarray, width: int):
    """mapInArrow function: f1, f2 and the whole set of each text whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            chosen = (wanted[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)
            texts = batch.column("text").take(pa.array(np.flatnonzero(chosen)))
            for _, _, data, offsets in chunks(texts, PART):
                s, at = shingle_sets(data, offsets, width)
                f1, f2 = fingerprints(s, at)
                sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(s.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(f1), pa.array(f2), sets], names=["f1", "f2", "shingles"])
    return run


def filter_size(n: int) -> int:
    """Bits of the filter for n texts: a power of two, in proportion to them."""
    return min(MOST_BITS, max(FILTER_BITS, 1 << (BITS_EACH * n - 1).bit_length()))


def bit_of(doc_id: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(bits))


def filter_words(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """A set of ``bits`` bits that has the bit of every id. Where it is too full
    to tell (from half a billion ids on) it merely lets more texts pass."""
    bit = bit_of(F.col(column), bits)
    words = (ids.select(F.shiftright(bit, 6).alias("w"), F.expr("1L").alias("one"), F.pmod(bit, F.lit(64)).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(F.call_function("shiftleft", "one", "b")).alias("x")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[words["w"].to_numpy()] = words["x"].to_numpy()
    return out.view(np.uint64)


def confirmed(scratch: Scratch, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar on their full sets."""
    na, nb = F.size("sa"), F.size("sb")
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    sized = both.filter(100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb))
    return scratch.save(sized.filter(100 * common >= PERCENT * (na + nb - common)).select("a", "b"), "links")


def compare_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between the askers and the members of one pair of blocks that lie
    in different components: common shingles by an inverted index."""
    ask, base = pdf[pdf["ask"]], pdf[pdf["base"]]
    out_a, out_b = [], []
    if len(ask) and len(base):
        node, comp, n = (base[c].to_numpy() for c in ("node", "comp", "n"))
        post = np.concatenate(base["shingles"].to_list())
        owner = np.repeat(np.arange(len(base)), n)
        order = np.argsort(post, kind="stable")
        post, owner = post[order], owner[order]
        for a, c, size, s in zip(ask["node"], ask["comp"], ask["n"], ask["shingles"]):
            lo, hi = np.searchsorted(post, s, "left"), np.searchsorted(post, s, "right")
            length = hi - lo
            at = np.repeat(hi - np.cumsum(length), length) + np.arange(int(length.sum()))
            common = np.bincount(owner[at], minlength=len(base))
            hit = np.flatnonzero((100 * common >= PERCENT * (n + size - common)) & (comp != c))
            out_a += [a] * len(hit)
            out_b += node[hit].tolist()
    return pd.DataFrame({"a": np.asarray(out_a, np.int64), "b": np.asarray(out_b, np.int64)})


def across(scratch: Scratch, sets: DataFrame, groups: DataFrame, labels: DataFrame,
           block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links between different components of the same group (hub, node)."""
    held = (groups.join(labels, "node", "left").select("hub", "node", F.coalesce("comp", "node").alias("comp"))
            .join(sets.select("node", F.size("shingles").alias("n")), "node"))
    held = scratch.save(held, "held")
    mains = (held.groupBy("hub", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
             .groupBy("hub").agg(F.count("*").alias("comps"), F.sum("s").alias("all"),
                                 F.max(F.struct("c", "comp", "s")).alias("m")).filter("comps > 1")
             .select("hub", F.col("m.comp").alias("main"),
                     F.ceil(F.col("all") / block_shingles).alias("nb"),
                     F.ceil((F.col("all") - F.col("m.s")) / block_shingles).alias("na")))
    mains = scratch.save(mains, "mains")
    if mains.count() <= MOST_MIXED:
        mixed = held.join(F.broadcast(mains), "hub")
    else:  # a group may hold most of the texts: its rows are dealt by salt as well
        salts = mains.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mixed = held.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(2)), F.lit(SALTS)).cast("int")).join(salts, ["hub", "salt"]).drop("salt")
    mixed = mixed.withColumn("is_ask", F.col("comp") != F.col("main"))
    i, j = F.pmod(F.xxhash64("node"), F.col("na")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("nb"))
    cell = lambda x, y, ask: F.struct(x.alias("i"), y.alias("j"), F.lit(ask).alias("ask"), F.lit(not ask).alias("base"))
    to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    roles = F.concat(F.transform(to(F.col("na")), lambda x: cell(x, j, False)),
                     F.when(F.col("is_ask"), F.transform(to(F.col("nb")), lambda y: cell(i, y, True)))
                     .otherwise(F.array().cast("array<struct<i:long,j:long,ask:boolean,base:boolean>>")))
    parts = (mixed.select("hub", "node", "comp", "n", F.explode(roles).alias("r"))
             .select("hub", "node", "comp", "n", "r.*").join(sets, "node"))
    links = parts.groupBy("hub", "i", "j").applyInPandas(compare_block, "a long, b long")
    links = scratch.save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    scratch.drop(held, mains)
    return links


def near_duplicates(docs: DataFrame, width: int = 2) -> DataFrame:
    """Components of similar documents; see the module text.

    ``docs`` needs ``doc_id, text``; shingles have ``width`` words. Returns
    ``doc_id, n_shingles, component_id, kept``, ``text_key`` (a 64-bit hash of the text, to tell rows with the same
    doc_id apart) and ``group`` (a number of the component, also apart where two
    have the same name; null for an empty set).
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    signed = scratch.save(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
        .mapInArrow(signer(width), "doc_id long, text_key long, n long, f1 long, f2 long, bands array<long>"), "signed")
    nodes = scratch.save(
        signed.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    narrow = nodes.drop("bands")
    cells = nodes.select("node", F.explode("bands").alias("key"))
    shared = cells.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("hub")).filter("c > 1")
    cells = scratch.save(cells.join(shared.select("key", "hub"), "key"), "cells")

    wanted = scratch.save(cells.select("node").distinct().join(narrow, "node").select("node", "rep", "f1", "f2"), "wanted")
    # second look at the texts: only the wanted ones (and a few more) leave the scan, as sets
    bits = filter_size(wanted.count())
    words = filter_words(wanted, "rep", bits)
    sets = (docs.select("text", bit_of(F.col("doc_id"), bits).alias("bit"))
            .mapInArrow(full_sets(words, width), "f1 long, f2 long, shingles array<long>")
            .join(wanted, ["f1", "f2"]).select("node", "shingles").dropDuplicates(["node"]))
    sets = scratch.save(sets, "sets")

    stars = scratch.save(cells.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
                         .distinct(), "stars")
    links = confirmed(scratch, sets, stars)
    degree = (links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links")))
    hubs = (cells.drop("hub").join(degree, "node", "left").groupBy("key")
            .agg(F.max(F.struct(F.coalesce("links", F.lit(0)).alias("links"), "node"))["node"].alias("hub")))
    groups = scratch.save(cells.drop("hub").join(hubs, "key").select("hub", "node").distinct(), "groups")
    again = (groups.filter("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
             .distinct().join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    links = scratch.save(links.unionByName(confirmed(scratch, sets, again)), "links")
    labels = components(scratch, links)
    more = across(scratch, sets, groups, labels)
    if not more.isEmpty():  # they join whole components
        top = labels.select("node", "comp")
        ends = more
        for c in ("a", "b"):
            ends = ends.join(top.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")), c, "left").withColumn(
                f"c{c}", F.coalesce(f"c{c}", c))
        joined = components(scratch, ends.select("ca", "cb"), "ca", "cb")
        labels = (labels.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("least")), "comp", "left")
                  .select("node", F.coalesce("least", "comp").alias("comp"))
                  .unionByName(joined.join(labels.select("node"), "node", "left_anti").select("node", "comp")))
        labels = scratch.save(labels, "labels")
    scratch.drop(cells, wanted, sets, stars, groups)

    classes = narrow.join(labels, "node", "left").select("f1", "f2", "rep", F.coalesce("comp", "node").alias("comp"))
    names = classes.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = classes.join(names, "comp").select("f1", "f2", "component_id", F.col("comp").alias("group"))
    out = signed.drop("bands").join(named, ["f1", "f2"], "left").withColumnRenamed("n", "n_shingles")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (out.withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "text_key", "group"))


def oracle() -> str:
    """DuckDB: all pairs that share a shingle, compared on full sets."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
        SELECT doc_id, ws[i] || ' ' || ws[i + 1] AS sh FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w)
        UNION ALL SELECT doc_id, ws[1] FROM w WHERE len(ws) = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS m FROM documents UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.v),
k AS (SELECT v, min(m) AS component_id FROM r GROUP BY v)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN k ON k.v = doc_id"""
