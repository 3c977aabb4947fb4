"""Operator 1: personal data by bootstrapped contextual extraction.

Entities found by fixed patterns (email, ip, card, phone) are the seeds. The
words beside them are lexical patterns: the left word, the right word, and both
together. Patterns are scored on the pattern-instance graph by the share of
their instances that are known; instances (identifier-shaped tokens) by the
patterns that extract them. Instances with a high score by two patterns, or by
one that is trusted on many instances, become known, and the next round scores
all patterns anew, until neither the instances nor the trusted patterns change
and the scores have settled. An instance at the edge of its
text has only the patterns whose words it has. What is known at the end and is no seed is
added to the spans as kind ``found``.

Everything is DataFrame functions on the JVM. A regular expression gives the
matches of a text and the gaps between them; sums over their lengths (in code
points) are the positions, and the words beside a match come from the gaps on
either side (``beside``). Sums and maxima run block by block, and text is cut
from fixed parts, so a text takes time in proportion to its length. The patterns used are the fixed ones written without
backtracking, so they take time in proportion to the text: a run of characters
is entered at its first character only (or where the last match ended) and
never given back. The graph holds one row per identifier-shaped token and
pattern; scores are aggregated before every shuffle.

Defined cases: null text is empty text; repeated rows are searched each; rows
without doc_id keep it null; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let, text_or_empty

KINDS = ("email", "ip", "card", "phone", "found")
#: email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"\.[A-Za-z0-9-](?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+")
#: ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: card [0-9]([\x20-]?[0-9])+
CARD = r"[0-9](?:(?![ -](?![0-9]))[0-9 -])++"
#: phone \+[0-9][\x20().0-9-]+[0-9]
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: A token with a digit or an at sign: what the patterns may extract.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
IDENTIFIER = r"^(?=(?:[^0-9]*+[0-9]){3}|[^@]++@).{6,}"

SPAN = "array<struct<s:int,e:int,k:int,v:string,left:string,right:string>>"
#: One pattern alone is enough with this support and a confidence of LEAST_SCORE.
ALONE_SUPPORT = 10
LEAST_SUPPORT, LEAST_CONFIDENCE, LEAST_SCORE = 3, 0.8, 0.95
#: The rounds go on while the scores of all values together rise by more.
SETTLED = 0.001
#: A longer word stands in its patterns by its hash.
LONG_WORD = 64
#: Running values are taken block by block, so that a step copies no more than a block.
BLOCK = 512
#: Code points of the parts into which a text is cut before spans are taken out of it.
PART = 1024

OPENING = r"[\"'(\[{<]++"
CLOSING = r"(?<![\"')\]}>.,;:!?])[\"')\]}>.,;:!?]++$"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def running(values: Column, zero: int, join) -> Column:
    """Of every element of an int array what ``join`` makes of all before it, from
    ``zero`` on. Block by block: the first value of each block, then those inside it."""
    def along(block: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct(
            join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def by_block(blocks: Column) -> Column:
        whole = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), lambda acc, x: join(acc, x)))
        return F.flatten(F.zip_with(blocks, along(whole, F.lit(zero)), along))

    def split(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda i: F.slice(v, i * BLOCK + 1, F.lit(BLOCK)))

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(let(split(v), by_block)))


def add(a: Column, b: Column) -> Column:
    return a + b


def beside(x: Column, matches: Column, gaps: Column) -> Column:
    """A match with the words to its left and right (lower case, digits as 0).

    Words are cut at the matches of the same pattern: the left one is the last
    word between the match before and this one, without opening punctuation at
    its end, or if there is none, the last word of the match before. The right
    one is the first word after the white space that follows, up to the next
    match, or the first word of that match if only white space parts the two.
    """
    word = r"[^\x20\x09-\x0D]++"
    last, first = rf"({word})[\x20\x09-\x0D]*+$", rf"^({word})"
    at = lambda a, i: F.coalesce(F.get(a, i), F.lit(""))
    before, after = F.regexp_replace(at(gaps, x["i"]), OPENING + "$", ""), at(gaps, x["i"] + 1)
    left = F.regexp_extract(before, last, 1)
    left = F.when(left != "", left).otherwise(F.regexp_extract(at(matches, x["i"] - 1), last, 1))
    right = F.regexp_extract(after, rf"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]++({word})", 1)
    apart = after.rlike(r"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]++$")
    right = F.when(apart, F.regexp_extract(at(matches, x["i"] + 1), first, 1)).otherwise(right)
    plain = lambda w: F.translate(F.lower(w), "123456789", "000000000")
    key = lambda w: F.when(F.length(w) > LONG_WORD, F.sha2(w, 256)).otherwise(w)
    return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), F.lower(x["v"]).alias("v"),
                    key(plain(left)).alias("left"), key(plain(right)).alias("right"))


def spans(text: Column, pattern: str, kind: int, look, keep) -> Column:
    """Matches of a pattern: ``look`` may narrow a match (s, e, v), ``keep`` takes
    all of them to those wanted, as an array of (s, e, k, v, i); these get the
    words beside them. Places are in code points."""
    def all_matches(m: Column, gaps: Column) -> Column:
        def place(starts: Column) -> Column:
            rows = F.arrays_zip(m.alias("m"), F.slice(gaps, 1, F.size(m)).alias("g"), starts.alias("at"))

            def one(x: Column, i: Column) -> Column:
                s = x["at"] + F.length(x["g"])
                return look(F.struct(s.alias("s"), (s + F.length(x["m"])).alias("e"), F.lit(kind).alias("k"), x["m"].alias("v"), i.alias("i")))

            return F.transform(keep(F.transform(rows, one)), lambda x: F.when(x["k"] >= 0, beside(x, m, gaps)).otherwise(
                F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), x["v"].alias("v"), F.lit("").alias("left"), F.lit("").alias("right"))))

        steps = F.zip_with(F.slice(gaps, 1, F.size(m)), m, lambda g, x: F.length(g) + F.length(x))
        return let(running(steps, 0, add), place)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, no_spans()).otherwise(
        let(F.split(text, pattern, -1), lambda g: all_matches(m, g))))


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def plus(total: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, F.lit(2)).otherwise(F.lit(1))
        return total + F.when(x > 9, x - 9).otherwise(x)
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), plus) % 10 == 0


def byte_parts(v: Column) -> Column:
    return F.forall(F.split(v, r"\."), lambda p: p.rlike(r"^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


def base_spans(text: Column) -> Column:
    """Matches of the four kinds, by kind; those that fail their check (Luhn,
    parts over 255, number of digits) have kind -1."""
    def checked(ok):
        return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(ok(x["v"]), x["k"]).otherwise(F.lit(-1)).alias("k"),
                                  x["v"].alias("v"), x["i"].alias("i"))

    same = lambda x: x
    has = lambda c, x: F.when(c, x).otherwise(no_spans())
    email = has(text.contains("@"), spans(text, EMAIL, 0, same, same))
    ip = has(text.rlike("[0-9]") & text.contains("."), spans(text, IP, 1, checked(byte_parts), same))
    long = lambda m: F.filter(m, lambda x: F.length(digits(x["v"])).between(14, 19))
    card = has(text.rlike("[0-9][ -]?[0-9]"), spans(text, CARD, 2, same, lambda m: F.transform(long(m), checked(lambda v: luhn(digits(v))))))
    phone = has(text.contains("+"), spans(text, PHONE, 3, checked(lambda v: F.length(digits(v)).between(10, 15)), same))
    return F.concat(email, ip, card, phone)


def tokens(text: Column, base: Column) -> Column:
    """Identifier-shaped tokens without the punctuation around them, apart from
    those in a base match: a number that failed its check is no identifier."""
    def bare(x: Column) -> Column:
        s = x["s"] + F.length(x["v"]) - F.length(F.regexp_replace(x["v"], "^" + OPENING, ""))
        v = F.regexp_replace(F.regexp_replace(x["v"], "^" + OPENING, ""), CLOSING, "")
        return F.struct(s.alias("s"), (s + F.length(v)).alias("e"), x["k"].alias("k"), v.alias("v"), x["i"].alias("i"))

    def free(t: Column) -> Column:
        shaped = F.filter(t, lambda x: x["v"].rlike(IDENTIFIER))
        return F.when(F.size(base) == 0, shaped).otherwise(let(shaped, lambda x: clear_of(x, base)))

    return F.when(text.rlike("[0-9]|@"), spans(text, TOKEN, 4, bare, free)).otherwise(no_spans())


def clear_of(found: Column, base: Column) -> Column:
    """The tokens that no base match overlaps: both go in order of their starts,
    each beside the furthest end of the matches before it and the start of the next."""
    never = 2**31 - 1
    mark = lambda x, t: F.struct(x["s"].alias("s"), F.lit(t).alias("t"), x["e"].alias("e"),
                                 *((x["k"].alias("k"), x["v"].alias("v"), x["i"].alias("i")) if t else
                                   (F.lit(4).alias("k"), F.lit("").alias("v"), F.lit(0).alias("i"))))

    def pick(order: Column) -> Column:
        ends = running(F.transform(order, lambda x: F.when(x["t"] == 0, x["e"]).otherwise(F.lit(-1))), -1, F.greatest)
        starts = F.transform(order, lambda x: F.when(x["t"] == 0, x["s"]).otherwise(F.lit(never)))
        nexts = F.reverse(running(F.reverse(starts), never, F.least))
        rows = F.arrays_zip(order.alias("x"), ends.alias("before"), nexts.alias("after"))
        kept = F.filter(rows, lambda r: (r["x"]["t"] == 1) & (r["before"] <= r["x"]["s"]) & (r["after"] >= r["x"]["e"]))
        return F.transform(kept, lambda r: F.struct(*(r["x"][c].alias(c) for c in "sekvi")))

    marks = F.concat(F.transform(base, lambda x: mark(x, 0)), F.transform(found, lambda x: mark(x, 1)))
    return let(F.sort_array(marks), pick)


def known_instances(scratch: Scratch, items: DataFrame) -> DataFrame:
    """The values that the rounds add: a table (v).

    ``items`` has (k, v, left, right), one row per seed or token.
    """
    left, right = F.col("left") != "", F.col("right") != ""
    usable = F.array_compact(F.array(F.when(left, F.concat(F.lit("l "), "left")), F.when(right, F.concat(F.lit("r "), "right")),
                                     F.when(left & right, F.concat(F.lit("b "), "left", F.lit(" "), "right"))))
    edges = scratch.save(items.select("v", (F.col("k") < 4).alias("seed"), F.explode(usable).alias("p"))
                         .groupBy("p", "v").agg(F.max("seed").alias("seed")), "graph")
    known, size, total = None, None, 0.0
    while True:  # confidence only grows, so what is known stays known
        e = edges.withColumn("score", F.col("seed").cast("double"))
        if known is not None:
            e = e.join(known.withColumnRenamed("score", "new"), "v", "left").withColumn(
                "score", F.greatest("score", F.coalesce("new", F.lit(0.0))))
        rated = (e.groupBy("p").agg(F.avg("score").alias("confidence"), F.sum((F.col("score") > 0).cast("long")).alias("support"))
                 .filter((F.col("support") >= LEAST_SUPPORT) & (F.col("confidence") >= LEAST_CONFIDENCE)))
        rated = scratch.save(rated, "patterns")
        alone = (F.col("support") >= ALONE_SUPPORT) & (F.col("confidence") >= LEAST_SCORE)
        doubt = F.sum(F.log(F.greatest(F.lit(1.0) - F.col("confidence"), F.lit(1e-9))))
        new = (edges.filter(~F.col("seed")).join(rated, "p").groupBy("v")
               .agg(F.count("*").alias("patterns"), (F.lit(1.0) - F.exp(doubt)).alias("score"), F.max(alone).alias("alone"))
               .filter(((F.col("patterns") >= 2) & (F.col("score") >= LEAST_SCORE)) | F.col("alone")).select("v", "score"))
        old, known = known, scratch.save(new, "known")
        if old is not None:
            scratch.drop(old)
        before, risen = size, total
        n, total = known.agg(F.count("*"), F.coalesce(F.sum("score"), F.lit(0.0))).first()
        size = (n, rated.count())
        scratch.drop(rated)
        if size == before and total - risen <= SETTLED:
            return known.select("v")


def joined(items: Column) -> Column:
    """kind:start:end by start, then kind, with commas."""
    name = lambda x: F.element_at(F.array(*(F.lit(k) for k in KINDS)), x["k"] + 1)
    return F.concat_ws(",", F.transform(items, lambda x: F.concat_ws(":", name(x), x["s"].cast("string"), x["e"].cast("string"))))


def in_order(items: Column) -> Column:
    short = F.transform(items, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return F.sort_array(short)


def personal_data(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """All spans of personal data; see the module text.

    ``docs`` needs ``doc_id, text``. Returns ``doc_id``, counts by kind,
    ``base_sha256, spans``, ``items`` (array of start, kind number, end) and,
    if asked, the columns ``carry`` in the struct column ``row``.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    row = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(None).cast("struct<doc_id:long>")
    text = text_or_empty()
    found = let(base_spans(text), lambda b: F.struct(
        F.filter(b, lambda x: x["k"] >= 0).alias("base"), tokens(text, b).alias("tokens")))
    rows = docs.select("doc_id", row.alias("row"), let(found, lambda f: F.struct(
        in_order(f["base"]).alias("base"), f["base"].alias("seeds"), f["tokens"].alias("tokens"))).alias("f"))
    rows = rows.select("doc_id", "row", "f.*", F.monotonically_increasing_id().alias("rid"))
    rows = scratch.save(rows if carry else rows.drop("row"), "seeds")
    items = rows.select(F.explode(F.concat("seeds", "tokens")).alias("i")).select("i.k", "i.v", "i.left", "i.right")
    known = known_instances(scratch, items)
    # only rows with a token can gain a span; the rest, nearly all, is not shuffled
    some = F.size("tokens") > 0
    added = (rows.filter(some).select("rid", F.explode("tokens").alias("t"))
             .select("rid", F.col("t.v").alias("v"), F.struct(F.col("t.s").alias("s"), F.col("t.k").alias("k"), F.col("t.e").alias("e")).alias("x"))
             .join(known, "v", "left_semi").groupBy("rid").agg(F.collect_list("x").alias("more")))
    parts = rows.filter(some).join(added, "rid", "left").unionByName(
        rows.filter(~some).withColumn("more", F.lit(None)), allowMissingColumns=True)
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    parts = parts.withColumn("items", F.sort_array(F.concat("base", F.coalesce("more", none))))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return parts.select("doc_id", *(count(k) for k in range(4)), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("items")).alias("spans"), "items", *(["row"] if carry else []))


def taken(parts: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to ``end`` of a text in parts of ``PART``."""
    first = F.floor(start / PART).cast("int")
    some = F.slice(parts, first + 1, F.floor(end / PART).cast("int") - first + 1)

    def inside(part: Column, i: Column) -> Column:
        at = (first + i) * PART
        low = F.greatest(start - at, F.lit(0))
        return F.substring(part, low + 1, F.least(end - at, F.lit(PART)) - low)

    return F.when(start >= end, F.lit("")).otherwise(F.array_join(F.transform(some, inside), ""))


def redact(text: Column, items: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping
    spans are replaced together, by the kind of the first."""
    def whole(x: Column, parts: Column) -> Column:
        def label(r: Column) -> Column:
            name = F.concat(F.lit("["), F.upper(F.element_at(F.array(*(F.lit(k) for k in KINDS)), r["x"]["k"] + 1)), F.lit("]"))
            return F.when(r["x"]["s"] < r["at"], F.lit("")).otherwise(F.concat(taken(parts, r["at"], r["x"]["s"]), name))

        rows = F.arrays_zip(x.alias("x"), running(F.transform(x, lambda i: i["e"]), 0, F.greatest).alias("at"))
        rest = taken(parts, F.array_max(F.transform(x, lambda i: i["e"])), F.length(text))
        return F.concat(F.array_join(F.transform(rows, label), ""), rest)

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))
    return F.when(F.size(items) == 0, text).otherwise(let(F.transform(items, lambda i: i), lambda x: let(parts, lambda p: whole(x, p))))
