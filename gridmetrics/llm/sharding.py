"""Operator 2: shards by balanced label propagation.

Linked documents move towards the shard that holds most of their neighbours,
under capacity quotas, until the number of cut links no longer falls. Links are
given as groups (all members of a group are linked with each other), and a
group acts as a hub: members learn their neighbours' shards from the counts of
(group, shard), which are pre-aggregated, so that no pairs are ever listed and
a group with a third of all rows is a handful of counts.

One round: count members by (group, shard); each group's best open shard; the
8 x 8 matrix of wished moves; quotas from the free room and from exchanges; a
row moves with probability quota / wishes, drawn from a hash of the row. Groups
that need half a shard or more go first, while all shards have room. Rows
without links are not moved about: they only fill the shards up at the end,
when ranks spread over blocks make the law ``rows`` exact: row counts differ by
one at most.

Defined cases: a null text has size 1, crc32 0 and no links; empty texts are
equal texts; repeated rows are linked; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ranked

SHARDS = 8
MAX_ROUNDS = 12
#: The rounds end when the cut falls by less than this share.
LEAST_GAIN = 1e-3
#: A shard with less room than this share of its capacity takes no wishes.
FULL = 0.02


def draw(salt: int) -> Column:
    """A number in [0, 1) that depends on the row and the round."""
    return F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def table(values: dict[tuple[int, int], float], a: Column, b: Column) -> Column:
    """A small matrix as an expression; 0 where it has no entry."""
    entries = [x for (i, j), v in sorted(values.items()) for x in (F.lit(i * 1000 + j), F.lit(float(v)))]
    return F.coalesce(F.element_at(F.create_map(*entries), a * 1000 + b), F.lit(0.0)) if entries else F.lit(0.0)


def quotas(wishes: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], float]:
    """Share of the wished moves i -> j that may happen: equal exchanges between
    two shards, then moves into free room, in proportion to the wishes."""
    share = {}
    for j in range(len(room)):
        swap = {i: min(w, wishes.get((j, i), 0)) for (i, k), w in wishes.items() if k == j}
        rest = {i: wishes[i, j] - swap[i] for i in swap}
        fit = min(1.0, max(0, room[j]) / sum(rest.values())) if sum(rest.values()) else 0.0
        for i in swap:
            share[i, j] = (swap[i] + fit * rest[i]) / wishes[i, j]
    return share


def propagate(linked: DataFrame, capacity: list[int], scratch: Scratch) -> DataFrame:
    """Label propagation over ``linked`` (rid, group, ...); adds ``shard``."""
    n = len(capacity)
    state = scratch.save(linked.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")), "labels")
    last = None
    for turn in range(MAX_ROUNDS):
        counts = scratch.save(state.groupBy("group", "shard").agg(F.count("*").alias("n")), "counts")
        by_group = counts.groupBy("group").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
        cut = by_group.agg(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2)).first()[0] or 0.0
        if last is not None and cut > last * (1 - LEAST_GAIN):
            scratch.drop(counts)
            break
        last = cut
        held = {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [capacity[j] - held.get(j, 0) for j in range(n)]
        open_ = [j for j in range(n) if room[j] > FULL * capacity[j]] or list(range(n))
        tie = F.xxhash64("group", "shard")
        best = (counts.filter(F.col("shard").isin(open_)).groupBy("group")
                .agg(F.max(F.struct("n", tie.alias("t"), "shard")).alias("b"))
                .select("group", F.col("b.shard").alias("to"), F.col("b.n").alias("to_n"), F.col("b.t").alias("to_t")))
        wish = (counts.join(best, "group").filter(F.col("to") != F.col("shard"))
                .filter((F.col("to_n") > F.col("n")) | ((F.col("to_n") == F.col("n")) & (F.col("to_t") > tie)))
                .select("group", "shard", "to", "n"))
        wish = scratch.save(wish, "wishes")
        wishes = {(r["shard"], r["to"]): r["n"]
                  for r in wish.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
        share = {k: v for k, v in quotas(wishes, room).items() if v > 0}
        if not share:
            scratch.drop(counts, wish)
            break
        moved = F.when(draw(turn) < table(share, F.col("shard"), F.col("to")), F.col("to")).otherwise(F.col("shard"))
        old = state
        state = scratch.save(old.join(wish.drop("n"), ["group", "shard"], "left")
                             .withColumn("shard", F.when(F.col("to").isNull(), F.col("shard")).otherwise(moved))
                             .select(*old.columns), "labels")
        scratch.drop(old, counts, wish)
    return state


def deal(c: Column, parts: list[tuple[int, int, int]], what: str) -> Column:
    """Place ``c`` in consecutive parts (length, shard, first slot): the shard or the slot."""
    out, start = F.lit(None).cast("long"), 0
    for length, shard, slot in parts:
        value = F.lit(shard) if what == "shard" else c - F.lit(start) + F.lit(slot)
        out = F.when((c >= start) & (c < start + length), value.cast("long")).otherwise(out)
        start += length
    return out


#: A group of at least this part of all rows is heavy; there are no more heavy ones than that.
HEAVY = 1000


def with_sizes(rows: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Add ``group_rows`` (null for a row without a group of its own). Rows without
    text and those of heavy groups, which a join by group would send to one
    task, stay where they are."""
    heavy = F.col("group_rows") * HEAVY >= total
    none = F.lit(None).cast("long").alias("group_rows")
    some = rows.filter(F.col("group").isNotNull()).join(F.broadcast(sizes.filter(heavy)), "group", "left")
    light = some.filter(F.col("group_rows").isNull()).drop("group_rows").join(sizes.filter(~heavy), "group", "left")
    return (rows.filter(F.col("group").isNull()).select("*", none)
            .unionByName(some.filter(F.col("group_rows").isNotNull())).unionByName(light))


def balanced_shards(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Shard documents whose links are equal texts; the law is ``rows``.

    ``docs`` needs ``doc_id, text``. Returns ``doc_id, size, text_crc32, law,
    shard, slot, grown_shard`` and ``group_rows`` (documents with that text).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    group = F.when(F.col("text").isNotNull(),
                   F.concat_ws("-", F.xxhash64("text"), F.xxhash64(F.lit(7), "text")))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), group.alias("group"))
    rows = scratch.save(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")
    sizes = (rows.filter(F.col("group").isNotNull()).groupBy("group").agg(F.count("*").alias("group_rows"))
             .filter(F.col("group_rows") > 1))
    total = rows.count()
    rows = scratch.save(with_sizes(rows, scratch.save(sizes, "sizes"), total), "grouped")
    capacity = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    # Groups of half a shard or more first, while shards are empty: they cannot move as one later on.
    giant = F.col("group_rows") * 2 >= capacity[0]
    first = propagate(rows.filter(giant).select("rid", "group"), capacity, scratch)
    held = {r["shard"]: r["n"] for r in first.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    room = [max(0, capacity[j] - held.get(j, 0)) for j in range(n_shards)]
    linked = first.unionByName(propagate(rows.filter(~giant).select("rid", "group"), room, scratch))
    held = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    stay = [min(held.get(j, 0), capacity[j]) for j in range(n_shards)]
    surplus = {j: held.get(j, 0) - stay[j] for j in range(n_shards)}
    # Who fills what is left of each shard: linked rows beyond a capacity first, then rows without links.
    left = [capacity[j] - stay[j] for j in range(n_shards)]
    used, over, singles = list(stay), sum(surplus.values()), []
    moved_parts = []
    for j in range(n_shards):
        take = min(left[j], over)
        moved_parts.append((take, j, used[j]))
        used[j], over = used[j] + take, over - take
        singles.append((capacity[j] - used[j], j, used[j]))
    single = F.lit(n_shards)
    placed = rows.join(linked.select("rid", "shard"), "rid", "left").withColumn(
        "pool", F.coalesce(F.col("shard"), single)).drop("shard")
    placed = ranked(placed, ["pool"], [F.xxhash64("doc_id", "group"), F.col("doc_id"), F.col("rid")], total)
    stay_n = F.element_at(F.array(*(F.lit(x) for x in stay)), F.least(F.col("pool"), F.lit(n_shards - 1)) + 1)
    ahead, before = [], 0
    for j in range(n_shards):
        ahead.append(before)
        before += surplus[j]
    extra = (F.col("rank") - stay_n
             + F.element_at(F.array(*(F.lit(x) for x in ahead)), F.least(F.col("pool"), F.lit(n_shards - 1)) + 1))

    def place(what: str, own: Column) -> Column:
        return (F.when(F.col("pool") == single, deal(F.col("rank"), singles, what))
                .when(F.col("rank") < stay_n, own.cast("long")).otherwise(deal(extra, moved_parts, what)))

    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), place("shard", F.col("pool")).cast("int").alias("shard"),
        place("slot", F.col("rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.coalesce("group_rows", F.lit(1)).alias("group_rows"))


def cut_links(placed: DataFrame) -> DataFrame:
    """One row: links between equal texts, and how many cross shards."""
    per = placed.groupBy("text_crc32", "size", "shard").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("text_crc32", "size")
    g = per.withColumn("all", F.sum("n").over(whole)).groupBy("text_crc32", "size").agg(
        F.max("all").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
    return g.agg(F.sum(F.col("all") * (F.col("all") - 1) / 2).alias("links"),
                 F.sum((F.col("all") * F.col("all") - F.col("same")) / 2).alias("cut"))
