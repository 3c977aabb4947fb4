"""Operator 3: repeated 200-byte strings by sampled, sorted suffixes.

Every byte covered by a 200-byte string that also starts anywhere else goes.
Sorting all suffixes of the corpus is out of reach, and not needed: only
suffixes at *anchors* are handled. A position is an anchor if the hash of its
8 bytes is least among 160 consecutive positions. Two equal 200-byte strings
hold the same anchor at the same offset of at most 159, so they agree on the
``CORE`` (41) bytes after it, and everything can be decided from the context
of an anchor: 159 bytes before, 200 after.

1. One pass over the texts gives (hash of the core, hash of the context, text,
   place) of every anchor. Cores that occur once are dropped: they cannot be
   part of a repeat. Counts are aggregated before the shuffle.
2. Equal contexts are one entry with a count. With two or more, all 200-byte
   strings through the anchor are repeats.
3. Entries with an equal core but different contexts are range-partitioned by
   their leading bytes (the core) with sampled splitters, so an equal core lies
   in one bucket and no repeat crosses a boundary. Each bucket sorts the suffixes
   that start up to 159 bytes before its anchors by multikey quicksort in byte
   order, to a depth of 200 bytes in tokens of 8: only what is equal in a token
   looks at the next. Equal neighbours are repeats. Starts at which an entry
   shares too few bytes on either side with any other of its core are left out
   beforehand. An entry yields its outermost repeats.
4. A core with more contexts than fit a bucket is compared across buckets: its
   range of starts is split again and again, and only entries that share the
   bytes common to all suffixes of a range, but not all bytes of the range, go
   on. Each split counts groups with partial aggregation, so no group meets.
5. The spans, gathered per distinct text, are cut out of all documents.

Rows that share a core, a context or a whole text with many others are salted
in every join by these (``spread_join``).

Texts, cores and contexts are told apart by 64-bit hashes (texts also by their
length), sorted suffixes by their bytes.

Defined cases: null text is empty; texts under 200 bytes keep all; equal texts
of 200 bytes or more lose everything; repeated rows are equal texts; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches, spread_join
from .texthash import chunks, mix64

LENGTH = 200
GRAM, SPAN = 8, 160
CORE = LENGTH - SPAN + 1
LEFT, RIGHT = SPAN - 1, LENGTH
TOKEN = 8
#: Entries of a core that one bucket sorts (50 MB of tokens), and entries that
#: whole cores are gathered to before they are sorted.
BLOCK, BATCH = 16_384, 2048
#: Parts that a range of starts is split into when a core is too large for a bucket.
SPLITS = 5
PART = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n (or more) powers of the base of the polynomial hash."""
    have = _POWERS.get(int(inverse))
    if have is None or len(have) < n:
        x = np.full(max(n, 1 << 16), _INVERSE if inverse else _BASE, np.uint64)
        x[0] = 1
        have = _POWERS[int(inverse)] = np.cumprod(x)
    return have


def sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """out[i] = least or greatest of x[i:i + width] (shorter by width - 1)."""
    step, out = 1, x
    while step * 2 <= width:
        out = of(out[:-step], out[step:])
        step *= 2
    return of(out[:len(out) - (width - step)], out[width - step:]) if width > step else out


def anchor_places(data: np.ndarray) -> np.ndarray:
    """Places whose 8 bytes have the least hash of some 160 in a row."""
    n = len(data) - GRAM + 1
    if n < SPAN:
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(GRAM, np.uint8)])
    h = np.empty((len(data) // GRAM + 1) * GRAM, np.uint64)
    for r in range(GRAM):
        part = padded[r:r + (len(padded) - r) // GRAM * GRAM].view("<u8")
        h[r::GRAM][:len(part)] = part[:len(h[r::GRAM])]
    h = ((h[:n] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    low = sliding(h, SPAN, np.minimum)
    edge = np.zeros(SPAN - 1, np.uint32)
    best = sliding(np.concatenate([edge, low, edge]), SPAN, np.maximum)
    return np.flatnonzero(best == h)


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """t, size, place, core, context of the anchors of each text."""
    for batch in batches:
        t = batch.column("t").to_numpy()
        for i, _, data, offsets in chunks(batch.column("text"), PART):
            at = anchor_places(data)
            row = np.searchsorted(offsets, at, "right") - 1
            begin, end = offsets[row], offsets[row + 1]
            ok = (at + CORE <= end) & (end - begin >= LENGTH)
            at, row, begin, end = at[ok], row[ok], begin[ok], end[ok]
            if not len(at):
                continue
            p = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[:len(data)], out=p[1:])
            back = powers(len(data), True)
            core = mix64((p[at + CORE] - p[at]) * back[at])
            lo, hi = np.maximum(begin, at - LEFT), np.minimum(end, at + RIGHT)
            shape = ((at - lo) * 1024 + (hi - at)).astype(np.uint64)
            context = mix64(mix64((p[hi] - p[lo]) * back[lo]) + shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(t[i + row]), pa.array((end - begin).astype(np.int32)), pa.array((at - begin).astype(np.int32)),
                 pa.array(core.view(np.int64)), pa.array(context.view(np.int64))],
                names=["t", "size", "place", "core", "context"])


ENTRY = "core long, context long, before int, after int, bytes binary, lead binary"
MARKED = ENTRY + ", huge boolean"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Small parts of the batches, where rows become Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the wanted places of each text."""
    for part in slices(batches):
        want = part.column("want")
        fields = want.flatten()
        place, core, context, huge = (fields.field(k) for k in ("place", "core", "context", "huge"))
        parts, lead, before = [], [], []
        places = iter(place.to_pylist())
        for text, n in zip(part.column("text").to_pylist(), want.value_lengths().to_pylist()):
            data = text.encode()
            for _ in range(n):
                at = next(places)
                lo = max(0, at - LEFT)
                parts.append(data[lo:at + RIGHT])
                lead.append(data[at:at + CORE])
                before.append(at - lo)
        left = pa.array(before, pa.int32())
        size = pa.array([len(x) for x in parts], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [core, context, left, pc.subtract(size, left), pa.array(parts, pa.binary()), pa.array(lead, pa.binary()), huge],
            names=["core", "context", "before", "after", "bytes", "lead", "huge"])


def aligned(before: np.ndarray, parts: list[bytes], kind, plus: int) -> np.ndarray:
    """The contexts (rows x 359) with their anchors at column 159, so that equal
    columns of two rows compare directly; ``plus`` is added to bytes, not to gaps."""
    size = np.array([len(x) for x in parts])
    grid = np.zeros((len(parts), LEFT + RIGHT), kind)
    row = np.repeat(np.arange(len(parts)), size)
    col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(LEFT - before, size)
    grid[row, col] = np.frombuffer(b"".join(parts), np.uint8).astype(kind) + kind(plus)
    return grid


def prefix_table(before: np.ndarray, parts: list[bytes]) -> np.ndarray:
    """Running polynomial hash of the aligned contexts (rows x 360)."""
    width = LEFT + RIGHT
    grid = aligned(before, parts, np.uint64, 1)
    grid *= powers(width)[:width]
    out = np.zeros((len(parts), width + 1), np.uint64)
    np.cumsum(grid, axis=1, out=out[:, 1:])
    return out


def token_table(before: np.ndarray, parts: list[bytes]) -> np.ndarray:
    """The 8 bytes from each column of the aligned contexts as a number that
    orders like them (columns x rows)."""
    b = np.ascontiguousarray(aligned(before, parts, np.uint8, 0).T)
    two = (b[:-1].astype(np.uint16) << np.uint16(8)) | b[1:]
    four = (two[:-2].astype(np.uint32) << np.uint32(16)) | two[2:]
    return (four[:-4].astype(np.uint64) << np.uint64(32)) | four[4:]


def multikey_sort(tokens: np.ndarray, rows: np.ndarray, col: int) -> tuple[np.ndarray, np.ndarray]:
    """``rows`` in byte order of their 200 bytes from ``col``, and which of them
    equal the one before.

    Multikey quicksort, all runs of one depth at once: a run of rows equal so
    far is sorted by its next token, and what is equal in that too goes on.
    """
    first = tokens[col, rows]
    by = np.argsort(first)
    order, first = rows[by], first[by]
    same = np.concatenate([[False], first[1:] == first[:-1]])
    at = None
    for k in range(col + TOKEN, col + LENGTH, TOKEN):
        if at is None:  # runs of two or more
            at = np.flatnonzero(same | np.append(same[1:], False))
            if not len(at):
                break
            here, inside = order[at], same[at]
        token = tokens[k, here]
        split = (token[1:] != token[:-1]) & inside[1:]
        if not split.any():
            continue
        run = np.cumsum(~inside)
        todo = np.zeros(run[-1] + 1, bool)
        todo[run[1:][split]] = True
        todo = todo[run]
        part, token = at[todo], token[todo]
        by = np.lexsort((token, run[todo]))
        order[part] = order[part[by]]
        token = token[by]
        same[part[1:]] &= token[1:] == token[:-1]
        at = None
    return order, same


def shared_bytes(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the bytes before and after its anchor that each aligned context
    shares with another one of its core: a repeat needs that many on both sides."""
    n, found = len(grid), []
    core, rest = grid[:, LEFT:LEFT + CORE], (grid[:, :LEFT][:, ::-1], grid[:, LEFT + CORE:])
    for side in rest:
        x = np.ascontiguousarray(np.concatenate([core, side], axis=1))
        order = np.argsort(x.view(f"V{x.shape[1]}").ravel())
        differ = x[order[1:]] != x[order[:-1]]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
        most = np.zeros(n, np.int64)
        most[order[1:]] = common
        most[order[:-1]] = np.maximum(most[order[:-1]], common)
        found.append(most)
    return np.where(found[0] >= CORE, found[0] - CORE, -1), found[1]


def outermost_repeats(before: np.ndarray, after: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) start before the anchor of a suffix whose 200 bytes
    another entry has; -1 if none."""
    tokens = token_table(before, parts)
    least, greatest = np.full(len(parts), -1, np.int32), np.full(len(parts), -1, np.int32)
    left, right = shared_bytes(aligned(before, parts, np.uint8, 0))
    left, right = np.minimum(left, before), np.minimum(right, after)
    for start in range(SPAN):
        rows = np.flatnonzero((left >= start) & (right >= LENGTH - start))
        if len(rows) < 2:
            continue
        order, same = multikey_sort(tokens, rows, LEFT - start)
        hit = order[same | np.append(same[1:], False)]
        greatest[hit] = start
        least[hit] = np.where(least[hit] < 0, start, least[hit])
    return least, greatest


RANGE = "core long, context long, least int, greatest int"


def sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries come in order of their lead; whole cores are sorted together."""
    def solve(held: list[tuple]) -> pa.RecordBatch:
        core, context, before, after, parts = (list(x) for x in zip(*held))
        least, greatest = outermost_repeats(np.array(before), np.array(after), parts)
        hit = np.flatnonzero(least >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(core, np.int64)[hit]), pa.array(np.array(context, np.int64)[hit]),
             pa.array(least[hit]), pa.array(greatest[hit])], names=["core", "context", "least", "greatest"])

    held: list[tuple] = []
    seen: set[int] = set()
    last = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("core", "context", "before", "after", "bytes", "lead"))):
            if row[5] != last:
                if len(held) >= BATCH:
                    yield solve(held)
                    held = []
                last, seen = row[5], set()
            if row[1] not in seen:  # rows repeated with their doc_id bring an entry twice
                seen.add(row[1])
                held.append(row[:5])
    if held:
        yield solve(held)


SPLIT = ENTRY + ", lo int, hi int"


def range_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the bytes that all suffixes of a range of starts share, and of
    all their bytes (null where the entry does not have them)."""
    for batch in batches:
        parts = batch.column("bytes").to_pylist()
        before, after, lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("before", "after", "lo", "hi"))
        keep = np.flatnonzero((before >= lo) & (after >= LENGTH - hi))
        if not len(keep):
            continue
        p = prefix_table(before[keep], [parts[i] for i in keep])
        before, after, lo, hi = before[keep], after[keep], lo[keep], hi[keep]
        r = np.arange(len(keep))
        common = p[r, LEFT - lo + LENGTH - (hi - lo)] - p[r, LEFT - lo]
        whole = np.zeros(len(keep), np.uint64)
        full = (before >= hi) & (after >= LENGTH - lo)
        f = r[full]
        whole[f] = p[f, LEFT - lo[f] + LENGTH] - p[f, LEFT - hi[f]]
        yield pa.RecordBatch.from_arrays(
            [*batch.take(pa.array(keep)).columns, pa.array(mix64(common).view(np.int64)),
             pa.array(mix64(whole).view(np.int64), mask=~full)], names=[*batch.schema.names, "common", "whole"])


def across_buckets(scratch: Scratch, entries: DataFrame) -> DataFrame:
    """Repeats among entries of cores that are too large for a bucket."""
    rows = scratch.save(entries.dropDuplicates(["core", "context"])
                        .withColumn("lo", F.lit(0)).withColumn("hi", F.lit(SPAN - 1)), "split")
    found = None
    while not rows.isEmpty():
        hashed = scratch.save(rows.mapInArrow(range_hashes, SPLIT + ", common long, whole long"), "hashed")
        near = hashed.groupBy("core", "lo", "common").agg(F.count("*").alias("c")).filter("c > 1")
        same = (hashed.filter("whole IS NOT NULL").groupBy("core", "lo", "whole")
                .agg(F.count("*").alias("c"), F.min("context").alias("speaker")).filter("c > 1")
                .withColumn("repeat", F.lit(True)))
        total = hashed.count()
        live = spread_join(hashed, scratch.save(near, "near"), ["core", "lo", "common"], total).drop("c")
        live = spread_join(live, scratch.save(same, "same"), ["core", "lo", "whole"], total, "left")
        live = scratch.save(live, "live")
        done = live.filter("repeat").select("core", "context", F.col("lo").alias("least"), F.col("hi").alias("greatest"))
        found = done if found is None else found.unionByName(done)
        old, size = rows, F.col("hi") - F.col("lo") + 1
        cut = lambda i: (F.col("lo") + F.floor(size * i / SPLITS)).cast("int")
        pieces = F.filter(F.transform(F.sequence(F.lit(0), F.lit(SPLITS - 1)), lambda i: F.struct(
            cut(i).alias("lo"), (cut(i + 1) - 1).alias("hi"))), lambda x: x["lo"] <= x["hi"])
        cols = [c.split()[0] for c in ENTRY.split(", ")]
        # of entries with equal bytes one goes on, for others that share some of its suffixes
        rows = scratch.save(live.filter("(repeat IS NULL OR context = speaker) AND lo < hi").select(*cols, F.explode(pieces).alias("h"))
                            .select(*cols, "h.lo", "h.hi"), "split")
        scratch.drop(old, hashed)
    if found is None:
        return scratch.spark.createDataFrame([], RANGE)
    return found.groupBy("core", "context").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def repeated_spans(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(t, size, spans, c): the bytes to remove, per distinct text, and the
    number of its rows.

    ``texts`` has (doc_id, t, size, text); t is null where the text is too short
    for a repeat.
    """
    long = texts.filter(F.col("t").isNotNull())
    marks = scratch.save(long.select("t", "text").mapInArrow(
        anchors, "t long, size int, place int, core long, context long"), "anchors")
    often = scratch.save(marks.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1"), "often")
    total = marks.count()
    kept = scratch.save(spread_join(marks, often, ["core"], total), "candidates")
    scratch.drop(marks, often)
    classes = scratch.save(kept.groupBy("core", "context").agg(
        F.count("*").alias("c"), *(F.first(x).alias(x) for x in ("t", "size", "place"))), "classes")
    kinds = scratch.save(classes.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1"), "kinds")
    names = scratch.save(long.groupBy("t", "size").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")), "names")
    several = spread_join(classes.drop("c"), kinds, ["core"], classes.count())
    want = (several.groupBy("t", "size")
            .agg(F.collect_list(F.struct("place", "core", "context", (F.col("c") > BLOCK).alias("huge"))).alias("want"))
            .join(names.drop("c"), ["t", "size"]))
    d, w = long.alias("d"), want.alias("w")
    same = [F.col("d.t") == F.col("w.t"), F.col("d.size") == F.col("w.size"), F.col("d.doc_id").eqNullSafe(F.col("w.rep"))]
    entries = scratch.save(d.join(w, same).select("d.text", "w.want").mapInArrow(contexts, MARKED), "entries")
    solved = (entries.filter("NOT huge").drop("huge").repartitionByRange("lead").sortWithinPartitions("lead")
              .mapInArrow(sort_buckets, RANGE))
    huge = entries.filter("huge").drop("huge")
    if not huge.isEmpty():
        solved = solved.unionByName(across_buckets(scratch, huge))
    solved = scratch.save(solved, "solved")
    scratch.drop(entries)
    ranges = classes.select("core", "context", "c").join(solved, ["core", "context"], "left").filter("c > 1 OR least IS NOT NULL")
    all_least = F.greatest(F.lit(0), LENGTH - (F.col("size") - F.col("place")))
    all_most = F.least(F.lit(LEFT), F.col("place"))
    many = F.col("c") > 1
    spans = (spread_join(kept.drop("c"), scratch.save(ranges, "ranges"), ["core", "context"], total)
             .withColumn("least", F.when(many, all_least).otherwise(F.col("least")))
             .withColumn("greatest", F.when(many, all_most).otherwise(F.col("greatest"))).filter("least <= greatest")
             .select("t", "size", F.struct((F.col("place") - F.col("greatest")).alias("s"),
                                           (F.col("place") - F.col("least") + LENGTH).alias("e")).alias("x")))
    spans = spans.groupBy("t", "size").agg(F.collect_set("x").alias("spans"))
    return scratch.save(spans.join(names.drop("rep"), ["t", "size"]), "spans")


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cutter(digest: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                data = text.encode()
                left, at, runs, last = [], 0, 0, -1
                for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                    if s > last:  # touching spans are one run
                        runs += 1
                        left.append(data[at:s])
                    at = last = max(at, e)
                rest = b"".join([*left, data[at:]])
                out.append((doc, len(data), len(data) - len(rest), runs, hashlib.sha256(rest).hexdigest(),
                            None if digest else rest))
            cols = list(zip(*out)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return cut


def remove_repeats(docs: DataFrame, digest: bool = True) -> DataFrame:
    """Cut repeated 200-byte strings out of all documents; see the module text.

    ``docs`` needs ``doc_id, text``. Returns ``doc_id, n_bytes, n_removed,
    n_spans, kept_sha256`` and, without ``digest``, the remaining bytes ``kept``.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text)
    texts = docs.select("doc_id", F.when(size >= LENGTH, F.xxhash64(text)).alias("t"), size.alias("size"), text.alias("text"))
    spans = repeated_spans(texts, scratch)
    rows = spread_join(texts, spans, ["t", "size"], docs.count(), "left")
    out = rows.select("doc_id", "text", "spans").mapInArrow(cutter(digest), CUT)
    return out.drop("kept") if digest else out


def oracle() -> str:
    """DuckDB: all 200-byte strings, as hexadecimal text."""
    n = 2 * LENGTH
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), {n})) AS m
      FROM (SELECT rid, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - {LENGTH - 1})) AS i FROM d)),
r AS (SELECT rid, i FROM w JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) USING (m)),
s AS (SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS gap FROM r),
g AS (SELECT rid, i, sum(CASE WHEN gap IS NULL OR gap > {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS run FROM s),
u AS (SELECT rid, run, min(i) AS s, max(i) + {LENGTH} AS e FROM g GROUP BY rid, run),
v AS (SELECT rid, run, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY run), 0) AS before FROM u),
k AS (SELECT rid, sum(e - s) AS n_removed, count(*) AS n_spans,
      string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (s - before) AS BIGINT)), '' ORDER BY run) AS head, max(e) AS last
      FROM v JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, CAST(2 * last + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN k USING (rid)"""
