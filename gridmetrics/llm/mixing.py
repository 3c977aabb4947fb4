"""Operator 10: mix sources to target weights by entropy balancing.

Each source has a target number of words. Among all rates with that total, the
one closest (in relative entropy) to "every document once", with a rate of at
most ``MAX_COPIES``, is the exponential tilt ``min(MAX_COPIES, exp(l * size))``;
``l`` is the source's multiplier in the convex dual. All multipliers are found
together by Newton steps, each one Spark aggregation over the exact histogram
(source, size, documents), safeguarded by a bracket. Sums are decimal, so they
do not depend on the order of tasks and reruns agree.

Rates become whole copies by error diffusion: within blocks of about
``BLOCK_ROWS`` documents of a source, from long to short, each document takes
the rate rounded down or up, whichever keeps the words taken nearest to the
words due. A source that holds a third of all rows is many blocks.

Defined cases: null text has size 0; a null source is a source of its own,
after all others; documents of size 0 take 0 words; sources without words have
target 0; repeated rows are documents of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK_ROWS, Scratch, n_words, source_key, text_or_empty

MAX_COPIES = 3
MAX_STEPS = 100
#: Files of the table of multipliers, which has one row per source.
STATE_FILES = 4
#: Newton ends when every source is within this share of its target.
TOLERANCE = 1e-7


def targets(sources: DataFrame) -> DataFrame:
    """Add ``target`` to (source_key, total): weights 1, 2, 3 repeating in code
    point order share all words; a target above ``MAX_COPIES`` times its source
    stays there and the rest is shared anew.

    Water filling in closed form: sources sorted by cap / weight stop one after
    the other; the final level is the first one that fits what is left. The
    table has one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    place = Window.partitionBy(F.lit(0)).orderBy("source_key")
    w = (F.pmod(F.row_number().over(place) - 1, F.lit(3)) + 1).cast("double")
    cap = F.lit(float(MAX_COPIES)) * F.col("total")
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before, onward = (by_ratio.rowsBetween(Window.unboundedPreceding, -1),
                      by_ratio.rowsBetween(0, Window.unboundedFollowing))
    t = (sources.withColumn("weight", w).withColumn("cap", cap)
         .withColumn("level", (F.sum("total").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward))
         .withColumn("stop", F.col("cap") / F.col("weight"))
         .withColumn("final", F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "source_key", "level")))
                     .over(everything)["level"]))
    share = F.least(F.col("cap"), F.coalesce(F.col("final"), F.lit(float("inf"))) * F.col("weight"))
    return t.withColumn("target", share).drop("weight", "cap", "level", "stop", "final")


def exact_sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(38,9)")).cast("double")


def multipliers(scratch: Scratch, hist: DataFrame, sources: DataFrame) -> DataFrame:
    """Solve for the multiplier ``l`` of each source; sizes are scaled by the
    source's mean size. Returns sources with ``l`` (null where every document
    takes ``MAX_COPIES``)."""
    cap = float(MAX_COPIES)
    least = F.col("mean") / F.greatest(F.col("least_size"), F.lit(1))
    need = F.when(F.col("total") > 0, F.log(F.col("target") / F.col("total"))).otherwise(F.lit(0.0))
    state = sources.select(
        "*", F.lit(0.0).alias("l"), F.lit(1.0).alias("off"),
        (F.least(need, F.lit(0.0)) * least - 1e-9).alias("lo"),
        (F.when(need > 0, F.log(F.lit(cap)) * least).otherwise(F.lit(0.0)) + 1e-9).alias("hi"))
    state = scratch.save(state, "dual")
    rate = F.least(F.lit(cap), F.exp(F.col("l") * F.col("x")))
    free = F.col("l") * F.col("x") < F.log(F.lit(cap))
    for _ in range(MAX_STEPS):
        step = (hist.join(state, "source_key").withColumn("x", F.col("size") / F.col("mean"))
                .groupBy("source_key").agg(
                    exact_sum(F.col("n") * F.col("size") * rate).alias("words"),
                    exact_sum(F.when(free, F.col("n") * F.col("size") * F.col("x") * rate)).alias("slope")))
        gap = F.col("words") - F.col("target")
        lo = F.when(gap < 0, F.col("l")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("l")).otherwise(F.col("hi"))
        newton = F.col("l") - gap / F.col("slope")
        middle = (F.col("lo2") + F.col("hi2")) / 2
        off = F.when(F.col("target") > 0, F.abs(gap) / F.col("target")).otherwise(F.lit(0.0))
        old = state
        state = scratch.save(
            old.drop("off").join(step, "source_key", "left")
            .withColumn("lo2", lo).withColumn("hi2", hi)
            .withColumn("off", F.coalesce(off, F.lit(0.0)))
            .withColumn("l", F.when(F.col("off") <= TOLERANCE, F.col("l"))
                        .when((newton > F.col("lo2")) & (newton < F.col("hi2")), newton).otherwise(middle))
            .select(*(F.coalesce(F.col(c + "2"), F.col(c)).alias(c) if c in ("lo", "hi") else F.col(c)
                      for c in old.columns)).coalesce(STATE_FILES), "dual")
        scratch.drop(old)
        if state.filter(F.col("off") > TOLERANCE).isEmpty():
            return state
    worst = state.agg(F.max("off")).first()[0]
    raise ArithmeticError(f"the mix did not settle in {MAX_STEPS} rounds: {worst:.2g} of a source's target is missing")


def diffuse(pdf):
    """Copies of one block: sizes descending, each rate rounded down or up so
    that the words taken follow the words due. Docs of size 0 keep one copy."""
    copies, due, taken = [], 0.0, 0
    pdf = pdf.sort_values(["size", "place"], ascending=[False, True])
    for size, rate in zip(pdf["size"].tolist(), pdf["rate"].tolist()):
        due += size * rate
        low = int(rate)
        up = min(low + 1, MAX_COPIES)
        n = up if size and abs(taken + up * size - due) < abs(taken + low * size - due) else low
        copies.append(n if size else 1)
        taken += n * size
    pdf["copies"] = copies
    return pdf


def mix_sources(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Give each document its number of copies in the mix.

    ``docs`` needs ``doc_id, text, source``. Returns ``doc_id, size, source_size,
    target, taken, rate, copies`` and, if asked, the columns ``carry`` in the
    struct column ``row``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    row = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(None).cast("struct<doc_id:long>")
    base = scratch.save(docs.select(
        "doc_id", source_key(F.col("source")).alias("source_key"),
        n_words(text_or_empty()).alias("size"), F.xxhash64("doc_id", "text").alias("place"),
        F.monotonically_increasing_id().alias("rid"), row.alias("row")), "sizes")
    hist = scratch.save(base.groupBy("source_key", "size").agg(F.count("*").alias("n")), "histogram")
    sources = hist.groupBy("source_key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least_size"))
    sources = sources.withColumn("total", F.col("source_size").cast("double")).withColumn(
        "mean", F.greatest(F.col("total") / F.col("documents"), F.lit(1.0)))
    sources = scratch.save(targets(sources).withColumn("least_size", F.coalesce("least_size", F.lit(1))), "targets")
    state = multipliers(scratch, hist, sources)
    rate = (F.when(F.col("target") >= MAX_COPIES * F.col("total"), F.lit(float(MAX_COPIES)))
            .otherwise(F.least(F.lit(float(MAX_COPIES)), F.exp(F.col("l") * F.col("size") / F.col("mean")))))
    blocks = F.ceil(F.col("documents") / F.lit(BLOCK_ROWS))
    rated = (base.drop("row").join(state, "source_key")
             .select("rid", "doc_id", "source_key", "size", "place", "source_size", "target", F.round(rate, 12).alias("rate"),
                     F.pmod(F.xxhash64("doc_id", "place", F.lit(1)), blocks).alias("block")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rated.schema.fields) + ", copies int"
    done = (rated.groupBy("source_key", "block").applyInPandas(diffuse, schema)
            .withColumn("taken", F.col("copies") * F.col("size")))
    cols = ["doc_id", "size", "source_size", "target", "taken", "rate", "copies"]
    if not carry:
        return done.select(*cols)
    return done.select("rid", *cols).join(base.select("rid", "row"), "rid").drop("rid")
