"""Operator 6: near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one node with a count. Centroids, fitted on a bounded sample,
deal every node to its two nearest cells; a cell that is too large for one task
is dealt to blocks. Inside each such shard a flat graph is built: the nearest
candidates and a few distant ones of each node, robustly pruned (a candidate
goes if an already chosen neighbour is ``ALPHA`` times nearer to it than the
node is), with reverse edges. A node's adjacency lists from all its shards are
united. Every node is then searched for in its shards: a greedy beam search
from the shard's medoids, and, from every node found in range, expansion to
all its neighbours until nothing new is in range. Pairs in range are verified
in double precision. In a cell of several blocks, the queries of each block
search the graphs of all blocks, so nothing is dropped there. Edges that leave
a shard are followed after that: a search hands out the neighbours of what it
found that lie outside, these are verified, and the neighbours of new pairs are
looked at in turn until no pair is new.

Recall is audited: a sample of query vectors, drawn larger until it holds
``AUDIT_LINKS`` links, is compared with all vectors, and links are counted as
often as their vectors occur. A sample without links is reported as such. Below ``RECALL`` every
node is also searched for in twice as many of its nearest cells, with a wider
beam, up to ``TRIES`` times. What is then found goes out with a warning, and
below ``LEAST_RECALL`` the operator fails.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different length do not link; rows
without vec_id take part, and their component is named by the least vec_id in
it; repeated rows are links of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components

THRESHOLD = 0.95
#: Rows the centroids are fitted on, and the most centroids; rows of a shard.
SAMPLE, MOST_CELLS, SHARD_ROWS = 20_000, 4096, 1500
CELLS = 2
#: Candidates (near, random), degree, pruning factor, medoids, beam width.
NEAR, FAR, DEGREE, ALPHA, MEDOIDS, BEAM = 48, 16, 24, 1.2, 64, 48
#: Audited rows (first, most), links the audit is to hold; recall that ends the
#: search, recall below which it fails, and how often it is tried.
AUDIT_ROWS, AUDIT_MOST, AUDIT_LINKS = 256, 16_384, 400
RECALL, LEAST_RECALL, TRIES = 0.98, 0.9, 6
#: Queries searched at once in a task; nodes expanded at once of each.
QUERIES, AT_ONCE = 512, 4
#: Nearest neighbours of a node that always lead to it.
ENTRANCES = 6
#: Slack of single precision in range tests; the verdict is in double.
SLACK = 1e-4

LOG = logging.getLogger(__name__)


def matrix(col) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in col])


def normed(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, also of very large and very small ones."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def unit(x: np.ndarray) -> np.ndarray:
    return normed(x).astype(np.float32)


def fit_cells(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means on a bounded sample."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(sample @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1e-12)[:, None], c).astype(np.float32)
    return c


def dealer(cells: dict[int, np.ndarray], first: int, end: int):
    """mapInArrow function: each node to its nearest cells, from place ``first``
    to before ``end``; vectors of each length have cells of their own."""
    def deal(batches):
        for b in batches:
            vecs = b.column("vec").to_pylist()
            rows, out = [], []
            by_len: dict[int, list[int]] = {}
            for i, v in enumerate(vecs):
                by_len.setdefault(len(v), []).append(i)
            base = {n: sum(len(cells[m]) for m in sorted(cells) if m < n) for n in cells}
            for n, idx in by_len.items():
                c = cells[n]
                s = unit(matrix([vecs[i] for i in idx])) @ c.T
                near = np.argsort(-s, axis=1, kind="stable")[:, first:end]
                rows += np.repeat(idx, near.shape[1]).tolist()
                out += (near + base[n]).ravel().tolist()
            part = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), *part.columns], names=["cell", *b.schema.names])
    return deal


def prune(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning of sorted candidates (n x L): neighbours n x degree, -1 where fewer."""
    n, width = cand.shape
    out = np.full((n, degree), -1, np.int32)
    for lo in range(0, n, 512):
        c, s = cand[lo:lo + 512], sims[lo:lo + 512]
        v = x[c]
        far = 2 - 2 * s  # squared distance to the node
        alive = c >= 0
        alive &= far > -1
        kept = np.zeros(len(c), np.int64)
        row = np.arange(len(c))
        for j in range(width):
            take = alive[:, j] & (kept < degree)
            r = row[take]
            if not len(r):
                continue
            out[lo + r, kept[r]] = c[r, j]
            kept[r] += 1
            between = 2 - 2 * np.einsum("rd,rld->rl", v[r, j], v[r])
            alive[r] &= ~(ALPHA * between <= far[r])
            alive[r, :j + 1] = False
    return out


def build_graph(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Adjacency (n x up to 2 * DEGREE, -1 padded) of a shard's unit vectors."""
    n = len(x)
    if n == 1:
        return np.full((1, 1), -1, np.int32)
    near, far = min(NEAR, n - 1), min(FAR, n - 1)
    cand = np.empty((n, near + far), np.int32)
    sims = np.empty((n, near + far), np.float32)
    for lo in range(0, n, 512):
        s = x[lo:lo + 512] @ x.T
        row = np.arange(len(s))
        s[row, lo + row] = -3  # not its own neighbour
        top = np.argpartition(-s, near - 1, axis=1)[:, :near]
        rand = rng.integers(0, n, (len(s), far))
        both = np.concatenate([top, rand], axis=1)
        val = np.take_along_axis(s, both, axis=1)
        order = np.argsort(-val, axis=1, kind="stable")
        cand[lo:lo + 512] = np.take_along_axis(both, order, axis=1)
        sims[lo:lo + 512] = np.take_along_axis(val, order, axis=1)
    sims[sims < -2] = np.nan
    cand[np.isnan(sims)] = -1
    sims = np.nan_to_num(sims, nan=-1)
    out = prune(x, cand, sims, DEGREE)
    # reverse edges, as many as there is room for; the nearest first
    a, k = np.nonzero(out >= 0)
    b = out[a, k]
    order = np.lexsort((k, b))
    a, b = a[order], b[order]
    place = np.arange(len(b)) - np.searchsorted(b, b, "left")
    back = np.full((n, DEGREE), -1, np.int32)
    fits = place < DEGREE
    back[b[fits], place[fits]] = a[fits]
    return np.concatenate([out, back], axis=1)


def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    node = pdf["node"].to_numpy()
    order = np.argsort(node)
    node = node[order]
    adj = build_graph(unit(matrix(pdf["vec"].iloc[order])), np.random.default_rng(int(node[0]) & 0xFFFF))
    more: dict[int, list[int]] = {}
    for b, a in entrances(adj):
        more.setdefault(b, []).append(a)
    return pd.DataFrame({"node": node, "nbrs": [np.unique(node[[*r[r >= 0], *more.get(i, [])]]) for i, r in enumerate(adj)]})


def entrances(adj: np.ndarray) -> list[tuple[int, int]]:
    """Edges (from, to) that are missing from the nearest neighbours of a node to
    it. In a tight cluster the lists of all are taken up by the same members, and
    the rest could not be found from anywhere in range, so these edges are there
    whatever the bound of a list."""
    near = adj[:, :ENTRANCES]
    to = np.repeat(np.arange(len(adj)), near.shape[1])
    there = near.ravel() >= 0
    edges = zip(near.ravel()[there].tolist(), to[there].tolist())
    have = [set(r.tolist()) for r in adj]
    return [(b, a) for b, a in edges if a not in have[b]]


def medoids(x: np.ndarray, k: int) -> np.ndarray:
    """The members nearest to k centres of the shard, and to its mean."""
    centres = np.concatenate([fit_cells(x, min(k, len(x)), rounds=3), x.mean(axis=0, keepdims=True)])
    return np.unique(np.argmax(centres @ x.T, axis=1))


def search(x: np.ndarray, adj: np.ndarray, q: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) in range: beam search, then range expansion."""
    n, nq = len(x), len(q)
    width = min(beam, n)
    seen = np.zeros((nq, n), bool)
    found: list[np.ndarray] = []
    limit = THRESHOLD - SLACK

    def visit(qi: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Similarities of the pairs not seen before."""
        flat = np.unique(qi[node >= 0].astype(np.int64) * n + node[node >= 0])
        flat = flat[~seen.ravel()[flat]]
        seen.ravel()[flat] = True
        qi, node = flat // n, flat % n
        sim = np.empty(len(flat), np.float32)
        for i in range(0, len(flat), 1 << 16):
            sim[i:i + (1 << 16)] = np.einsum("ij,ij->i", q[qi[i:i + (1 << 16)]], x[node[i:i + (1 << 16)]])
        found.append(flat[sim >= limit])
        return qi, node, sim

    ids = np.full((nq, width), -1, np.int64)
    sims = np.full((nq, width), -2, np.float32)
    open_ = np.zeros((nq, width), bool)

    def merge(qi: np.ndarray, node: np.ndarray, sim: np.ndarray) -> None:
        nonlocal ids, sims, open_
        if not len(qi):
            return
        first = np.searchsorted(qi, np.arange(nq))
        place = np.arange(len(qi)) - first[qi]
        more = int(place.max()) + 1
        i2, s2 = np.full((nq, more), -1, np.int64), np.full((nq, more), -2, np.float32)
        i2[qi, place], s2[qi, place] = node, sim
        ids, sims = np.concatenate([ids, i2], axis=1), np.concatenate([sims, s2], axis=1)
        open_ = np.concatenate([open_, s2 > -2], axis=1)
        top = np.argsort(-sims, axis=1, kind="stable")[:, :width]
        ids, sims, open_ = (np.take_along_axis(y, top, axis=1) for y in (ids, sims, open_))

    merge(*visit(np.repeat(np.arange(nq), len(entries)), np.tile(entries, nq)))
    while open_.any():
        # the nearest open nodes of each query: the beam is sorted
        rank = np.cumsum(open_, axis=1)
        pick = open_ & (rank <= AT_ONCE)
        qi, k = np.nonzero(pick)
        open_[qi, k] = False
        nbrs = adj[ids[qi, k]]
        merge(*visit(np.repeat(qi, nbrs.shape[1]), nbrs.ravel()))
    edge = np.concatenate(found) if found else np.zeros(0, np.int64)
    while len(edge):  # every node in range opens all its neighbours
        mark = len(found)
        for i in range(0, len(edge), 1 << 15):
            part = edge[i:i + (1 << 15)]
            nbrs = adj[part % n]
            visit(np.repeat(part // n, nbrs.shape[1]), nbrs.ravel())
        edge = np.concatenate(found[mark:])
    all_ = np.concatenate(found) if found else np.zeros(0, np.int64)
    return all_ // n, all_ % n


PAIRS = "a long, b long, ma long, mb long"
#: A query and a node with their counts, or (not ``sure``) a neighbour to verify.
FOUND = f"{PAIRS}, sure boolean"


def in_range(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which rows are similar, in double precision."""
    u, v = (x / np.abs(x).max(axis=1, keepdims=True) for x in (u, v))
    return np.einsum("ij,ij->i", u, v) / (np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1)) >= THRESHOLD


def outside(qi: np.ndarray, ni: np.ndarray, begin: np.ndarray, out_at: np.ndarray, names: np.ndarray,
            asks: np.ndarray) -> np.ndarray:
    """The neighbours outside the shard of what each query found, once for each query."""
    seen = np.zeros((len(asks), len(names)), bool)
    for j in range(0, len(qi), 1 << 15):
        a, b = qi[j:j + (1 << 15)], ni[j:j + (1 << 15)]
        size = begin[b + 1] - begin[b]
        at = np.repeat(begin[b + 1] - np.cumsum(size), size) + np.arange(int(size.sum()))
        seen[np.repeat(a, size), out_at[at]] = True
    a, b = np.nonzero(seen)
    a, b = asks[a], names[b]
    none = np.zeros(len(a), np.int64)
    return np.stack([a, b, none, none, none])[:, a != b]


def verify(batches):
    """mapInArrow function: the pairs in range."""
    for t in batches:
        size = pa.compute.list_value_length(t.column("va")).to_numpy()
        for n in np.unique(size):
            part = t.take(pa.array(np.flatnonzero(size == n)))
            u, v = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n) for c in ("va", "vb"))
            yield part.select(["a", "b", "ma", "mb"]).filter(pa.array(in_range(u, v)))


def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    end = lambda c: nodes.select(F.col("node").alias(c), F.col("m").alias(f"m{c}"), F.col("vec").alias(f"v{c}"))
    both = pairs.join(end("a"), "a").join(end("b"), "b").filter(F.size("va") == F.size("vb"))
    return both.select("a", "b", "ma", "mb", "va", "vb").mapInArrow(verify, PAIRS)


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def across_shards(scratch: Scratch, found: DataFrame, united: DataFrame, nodes: DataFrame) -> DataFrame:
    """All links: those of the searches, and those that the united graph adds.

    Whenever a node is found in range of a query, its neighbours are compared
    with the query. A search has done so inside its shard and given out the
    neighbours beyond; pairs found in one direction only, and new ones, have
    their neighbours looked up here.
    """
    sure = found.filter("sure").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.max(F.when(F.col("a") < F.col("b"), F.col("ma")).otherwise(F.col("mb"))).alias("ma"),
        F.max(F.when(F.col("a") < F.col("b"), F.col("mb")).otherwise(F.col("ma"))).alias("mb"),
        F.max(F.col("a") < F.col("b")).alias("ab"), F.max(F.col("a") > F.col("b")).alias("ba"))
    sure = scratch.save(sure, "found")
    links = sure.select("a", "b", "ma", "mb")
    swapped = lambda t: t.select(F.col("b").alias("a"), F.col("a").alias("b"))
    lone = sure.filter("NOT ab").select("a", "b").unionByName(swapped(sure.filter("NOT ba")))
    reach = lambda pairs: pairs.join(united.withColumnRenamed("node", "b"), "b").select(
        "a", F.explode("nbrs").alias("b")).filter("a <> b")
    due = ordered(found.filter("NOT sure").select("a", "b").unionByName(reach(lone))).distinct()
    tested = None
    while True:
        due = due.join(links, ["a", "b"], "left_anti")
        due = scratch.save(due if tested is None else due.join(tested, ["a", "b"], "left_anti"), "due")
        new = scratch.save(verified(due, nodes), "new")
        if new.isEmpty():
            return links
        tested = due if tested is None else tested.unionByName(due)
        links = links.unionByName(new)
        due = ordered(reach(new.select("a", "b").unionByName(swapped(new)))).distinct()


def searcher(beam: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        base = pdf[pdf["base"]]
        ask = pdf[pdf["ask"]]
        if not len(base) or not len(ask):
            return pd.DataFrame({"a": [], "b": [], "ma": [], "mb": []}).astype("int64").assign(sure=True)
        base = base.sort_values("node")
        node, raw, m = base["node"].to_numpy(), matrix(base["vec"]), base["m"].to_numpy()
        x = unit(raw)
        lists = base["nbrs"].tolist()
        size = np.array([len(v) for v in lists])
        flat = np.concatenate([np.asarray(v, np.int64) for v in lists]) if size.sum() else np.zeros(0, np.int64)
        at = np.searchsorted(node, flat).clip(max=len(node) - 1)
        local = np.where(node[at] == flat, at, -1)
        adj = np.full((len(node), max(1, int(size.max()))), -1, np.int64)
        row = np.repeat(np.arange(len(node)), size)
        adj[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = local
        # edges out of the shard: places in ``names`` by node
        out_row = row[local < 0]
        names, out_at = np.unique(flat[local < 0], return_inverse=True)
        begin = np.searchsorted(out_row, np.arange(len(node) + 1))
        entries = medoids(x, MEDOIDS)
        ask_node, ask_raw, ask_m = ask["node"].to_numpy(), matrix(ask["vec"]), ask["m"].to_numpy()
        q, out, beyond = unit(ask_raw), [], []
        for i in range(0, len(q), QUERIES):
            qi, ni = search(x, adj, q[i:i + QUERIES], entries, beam)
            beyond.append(outside(qi, ni, begin, out_at, names, ask_node[i:i + QUERIES]))
            qi = qi + i
            other = ask_node[qi] != node[ni]
            qi, ni = qi[other], ni[other]
            for j in range(0, len(qi), 1 << 16):
                a, b = qi[j:j + (1 << 16)], ni[j:j + (1 << 16)]
                ok = in_range(ask_raw[a], raw[b])
                a, b = a[ok], b[ok]
                out.append(np.stack([ask_node[a], node[b], ask_m[a], m[b], np.ones(len(a), np.int64)]))
        rows = np.concatenate([np.zeros((5, 0), np.int64), *out, *beyond], axis=1)
        return pd.DataFrame(dict(zip(("a", "b", "ma", "mb"), rows))).assign(sure=rows[4] == 1)
    return run


def audit_truth(scratch: Scratch, nodes: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Links (a, b) of a sample of nodes and their number, by comparing with all
    nodes. The sample grows until it holds ``AUDIT_LINKS`` links."""
    rows = AUDIT_ROWS
    while True:
        truth = sample_truth(scratch, nodes, rows)
        due = row_pairs(truth)
        if due >= AUDIT_LINKS or rows >= min(total, AUDIT_MOST):
            return truth, due
        scratch.drop(truth)
        rows = min(4 * rows, AUDIT_MOST)


def row_pairs(pairs: DataFrame) -> int:
    """Pairs of rows that pairs of nodes (with their counts ma, mb) stand for."""
    return pairs.agg(F.coalesce(F.sum(F.col("ma") * F.col("mb")), F.lit(0))).first()[0]


def sample_truth(scratch: Scratch, nodes: DataFrame, rows: int) -> DataFrame:
    ask = nodes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(rows).select("node", "m", "vec").collect()
    groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in {len(r["vec"]) for r in ask}:
        own = [r for r in ask if len(r["vec"]) == n]
        v = matrix([r["vec"] for r in own])
        groups[n] = np.array([(r["node"], r["m"]) for r in own]), normed(v)

    def compare(batches):
        for b in batches:
            ids, vecs = np.stack([b.column(c).to_numpy() for c in ("node", "m")], axis=1), b.column("vec").to_pylist()
            pairs = [np.zeros((0, 4), np.int64)]
            for n, (names, v) in groups.items():
                idx = [i for i, y in enumerate(vecs) if len(y) == n]
                step = max(1, (1 << 20) // len(names))
                for lo in range(0, len(idx), step):
                    part = idx[lo:lo + step]
                    y = matrix([vecs[i] for i in part])
                    i, j = np.nonzero(normed(y) @ v.T >= THRESHOLD)
                    p = np.concatenate([ids[np.asarray(part)[i]], names[j]], axis=1)[:, [0, 2, 1, 3]]
                    p = np.where((p[:, 0] > p[:, 1])[:, None], p[:, [1, 0, 3, 2]], p)
                    pairs.append(p[p[:, 0] != p[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(pairs).T], names=["a", "b", "ma", "mb"])

    return scratch.save(nodes.select("node", "m", "vec").mapInArrow(compare, PAIRS).distinct(), "audit")




def dealt_schema(nodes: DataFrame) -> str:
    return f"cell long, node long, m long, vec {dict(nodes.dtypes)['vec']}"


def role(g: Column, q: Column, base: bool, ask: bool) -> Column:
    return F.struct(g.cast("long").alias("g"), q.cast("long").alias("q"), F.lit(base).alias("base"), F.lit(ask).alias("ask"))


def in_roles(rows: DataFrame, roles: Column) -> DataFrame:
    return rows.select("cell", "node", "m", "vec", "nbrs", F.explode(roles).alias("r")).select(
        "cell", "r.g", "r.q", "r.base", "r.ask", "node", "m", "vec", "nbrs")


def more_askers(scratch: Scratch, nodes: DataFrame, graph: DataFrame, blocks: DataFrame, cells: dict[int, np.ndarray],
                probes: int) -> DataFrame:
    """The search of every node in its next cells, up to ``probes``: query
    blocks of bounded size after a cell's own, each with all its graphs."""
    asks = scratch.save(nodes.mapInArrow(dealer(cells, CELLS, probes), dealt_schema(nodes)), "asks")
    sizes = scratch.save(asks.groupBy("cell").agg(F.ceil(F.count("*") / (4 * SHARD_ROWS)).alias("nx")).join(blocks, "cell"), "sizes")
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    base = in_roles(graph.drop("nb").join(sizes, "cell"),
                    F.transform(every(F.col("nx")), lambda k: role(F.col("block"), F.col("nb") + k, True, False)))
    own = F.col("nb") + F.pmod(F.xxhash64("node"), F.col("nx"))
    return base.unionByName(in_roles(asks.join(sizes, "cell").withColumn("nbrs", F.lit(None).cast("array<long>")),
                                     F.transform(every(F.col("nb")), lambda k: role(k, own, False, True))))


def embedding_links(nodes: DataFrame, scratch: Scratch, beam: int = BEAM) -> DataFrame:
    """All pairs found: a table (a, b, ma, mb) of nodes and their counts."""
    lens = {r["n"]: r["c"] for r in nodes.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).collect()}
    cells = {}
    for n, count in lens.items():
        sample = (nodes.filter(F.size("vec") == n).orderBy(F.xxhash64("node"), "node").limit(SAMPLE)
                  .select("vec").collect())
        k = min(MOST_CELLS, max(1, round(count / SHARD_ROWS)))
        cells[n] = fit_cells(unit(matrix([r["vec"] for r in sample])), k)
    dealt = scratch.save(nodes.mapInArrow(dealer(cells, 0, CELLS), dealt_schema(nodes)), "cells")
    blocks = dealt.groupBy("cell").agg(F.count("*").alias("rows")).select(
        "cell", F.when(F.col("rows") > 4 * SHARD_ROWS, F.ceil(F.col("rows") / (2 * SHARD_ROWS))).otherwise(1).alias("nb"))
    blocks = scratch.save(blocks, "blocks")
    dealt = dealt.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")))
    dealt = scratch.save(dealt, "shards")
    lists = dealt.groupBy("cell", "block").applyInPandas(build_shard, "node long, nbrs array<long>")
    united = scratch.save(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs")), "united")
    graph = scratch.save(dealt.join(united, "node"), "graph")
    # (cell, block of the graph, block of the queries): one row in both roles where a cell is one block
    one = F.col("nb") == 1
    every = F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)
    roles = F.when(one, F.array(role(F.lit(0), F.lit(0), True, True))).otherwise(F.concat(
        F.transform(every, lambda k: role(F.col("block"), k, True, False)),
        F.transform(every, lambda k: role(k, F.col("block"), False, True))))
    shards = in_roles(graph, roles)
    truth, due = audit_truth(scratch, nodes, sum(lens.values()))
    most, probes, parts = max((len(c) for c in cells.values()), default=0), CELLS, shards
    for left in reversed(range(TRIES)):
        found = scratch.save(parts.groupBy("cell", "g", "q").applyInPandas(searcher(beam), FOUND), "searched")
        links = across_shards(scratch, found, united, nodes)
        hit = row_pairs(truth.join(links, ["a", "b"], "left_semi")) if due else 0
        LOG.info("recall %d of %d audited links: %d cells, beam %d", hit, due, probes, beam)
        if not due:
            LOG.warning("near vectors: the audited sample of %d vectors has no link, so recall is not measured", AUDIT_MOST)
        if hit >= RECALL * due or not left:
            break
        scratch.drop(found)
        beam, probes = 2 * beam, min(2 * probes, most)
        parts = shards if probes <= CELLS else shards.unionByName(more_askers(scratch, nodes, graph, blocks, cells, probes))
    if hit < LEAST_RECALL * due:
        raise RuntimeError(f"near vectors: {hit} of {due} audited links found after {TRIES} searches")
    if hit < RECALL * due:
        LOG.warning("near vectors: %d of %d audited links found after %d searches", hit, due, TRIES)
    scratch.drop(graph, dealt, found, united)
    return links


def near_vectors(table: DataFrame) -> DataFrame:
    """Links and components of all vectors; see the module text.

    ``table`` needs ``vec_id, embedding``. Returns ``vec_id, n_links,
    component_id, kept``.
    """
    scratch = Scratch(table.sparkSession, "embeddings")
    single = table.schema["embedding"].dataType.elementType.simpleString() == "float"
    vec = F.col("embedding").cast("array<float>" if single else "array<double>")
    good = (F.coalesce(F.size(vec) > 0, F.lit(False))
            & F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False)))
    key = F.when(good, F.concat_ws("-", F.xxhash64(vec), F.xxhash64(F.lit(9), vec)))
    rows = scratch.save(table.select("vec_id", key.alias("key"), F.when(good, vec).alias("vec")), "rows")
    nodes = (rows.filter(F.col("key").isNotNull()).groupBy("key")
             .agg(F.count("*").alias("m"), F.min("vec_id").alias("rep"), F.any_value("vec").alias("vec"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = scratch.save(nodes, "nodes")
    links = embedding_links(nodes.select("node", "m", "vec"), scratch)
    degree = (links.select(F.col("a").alias("node"), F.col("mb").alias("o"))
              .unionByName(links.select(F.col("b").alias("node"), F.col("ma").alias("o")))
              .groupBy("node").agg(F.sum("o").alias("others")))
    labels = components(scratch, links.select("a", "b"))
    named = (nodes.drop("vec").join(degree, "node", "left").join(labels, "node", "left")
             .withColumn("comp", F.coalesce("comp", "node")))
    names = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = named.join(names, "comp").select(
        "key", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.drop("vec").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def oracle() -> str:
    """DuckDB: all pairs."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= {THRESHOLD}),
r AS (SELECT vec_id AS v, vec_id AS m FROM embeddings UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.v),
k AS (SELECT v, min(m) AS component_id FROM r GROUP BY v),
d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN k ON k.v = vec_id LEFT JOIN d ON d.a = vec_id"""
