"""CSV files with line breaks in quoted values, read by many tasks.

Spark reads a file line by line in byte ranges, but a quoted value may hold
line breaks, so a range may begin inside a value. A record ends where the
quotes counted from the file's start are even (a quote in a value is doubled,
so it counts twice). The reader therefore makes an index first: the quotes of
every byte range, and from their running sum whether a range begins inside a
value. Every task then puts the lines of its ranges together to records on its
own; only the pieces of a record that crosses a range's edge are grouped. Files
without such values, which the index shows, go to Spark's own CSV reader.

NULL is written as ``\\N``, empty text as ``""``. Text that begins with a backslash
gets another one before it, which the reader takes away, so ``\\N`` as text
stays text. Records end with a line feed, or a carriage return and a line feed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "quote": '"', "escape": '"', "nullValue": "\\N", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Empty text: written as two quotes, read as empty.
CSV_WRITE, CSV_READ = {"emptyValue": '""'}, {"emptyValue": ""}
#: Byte ranges whose index rows (a path, a number, a flag) are broadcast; a table of more is joined by a shuffle.
MOST_BROADCAST_RANGES = 200_000

WHOLE, HEAD, TAIL = 0, 1, 2


def _strings(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _marked(c):
    return F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c)


def _unmarked(c):
    return F.when(c.startswith("\\\\"), F.substring(c, 2, 2**31 - 1)).otherwise(c)


def write_csv(df: DataFrame, path: str, sort_by: list[str] | None = None) -> str:
    """Overwrite a CSV folder (header, whitespace kept verbatim)."""
    out = _strings(df.orderBy(*sort_by) if sort_by else df, _marked)
    out.write.mode("overwrite").options(**CSV_OPTS, **CSV_WRITE).csv(path)
    return path


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of all files with the byte range they stand in."""
    return (spark.read.text(path, lineSep="\n")
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def quote_index(lines: DataFrame) -> DataFrame:
    """(file, block, inside, breaks): of each byte range, whether it begins inside a
    quoted value and whether any of its lines leaves a value open or closes one."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    ranges = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"), F.max(quotes % 2).alias("breaks"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"),
                         (F.col("breaks") == 1).alias("breaks"))


def _assembler():
    def assemble(batches: Iterator) -> Iterator:
        """(file, block, kind, header, record) of lines that come in order, range by range."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["file", "block", "kind", "header", "record"]
        now, opened, head, first, held = None, False, False, False, []

        def give(records, kinds, headers):
            n = len(records)
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * n), pa.array([now[1]] * n, pa.int64()), pa.array(kinds, pa.int32()),
                                               pa.array(headers, pa.bool_()), pa.array(records, pa.string())], names=names)

        def rest():
            """What a range leaves open: the whole of it inside a value, or the begin of a record."""
            return [give(["\n".join(held)], [1 if head else 2], [first and not head])] if held else []

        for batch in batches:
            if not batch.num_rows:
                continue
            block, file = batch.column("block").to_numpy(), batch.column("file").dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, batch.num_rows]):
                key = (batch.column("file")[int(i)].as_py(), int(block[i]))
                if key != now:
                    if now is not None:
                        yield from rest()
                    now, held = key, []
                    opened = head = bool(batch.column("inside")[int(i)].as_py())
                    first = now[1] == 0
                lines = batch.column("value").slice(i, j - i)
                odd = pc.count_substring(lines, '"').to_numpy() & 1
                after = (int(opened) + np.cumsum(odd)) & 1
                ends = np.flatnonzero(after == 0) + 1
                opened = bool(after[-1])
                if len(ends):
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    records = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.slice(0, int(ends[-1]))), "\n").to_pylist()
                    if held:
                        records[0] = "\n".join([*held, records[0]])
                    kinds, headers = [0] * len(records), [False] * len(records)
                    kinds[0], headers[0] = (1, False) if head else (0, first)
                    yield give(records, kinds, headers)
                    head, first, held = False, False, []
                    lines = lines.slice(int(ends[-1]))
                held += lines.to_pylist()
        if now is not None:
            yield from rest()
    return assemble


def _range_assembler():
    assemble = _assembler()

    def whole_range(rows):
        import pyarrow as pa

        return pa.Table.from_batches(assemble(rows.sort_by("line").combine_chunks().to_batches()), schema=pa.schema(
            [("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("header", pa.bool_()), ("record", pa.string())]))
    return whole_range


def csv_records(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """(record): every record of all files but their headers and blank lines."""
    lines = csv_lines(spark, path)
    index = quote_index(lines) if index is None else index
    few = index.count() <= MOST_BROADCAST_RANGES
    ranges = index.select("file", "block", "inside")
    schema = "file string, block long, kind int, header boolean, record string"
    if few:
        parts = lines.join(F.broadcast(ranges), ["file", "block"]).select("file", "block", "inside", "value").mapInArrow(_assembler(), schema)
    else:  # a shuffled range, never more than a task reads at once, is put in order again
        rows = lines.withColumn("line", F.monotonically_increasing_id()).join(ranges.hint("merge"), ["file", "block"])
        parts = rows.groupBy("file", "block").applyInArrow(_range_assembler(), schema)
    whole = parts.where((F.col("kind") == WHOLE) & ~F.col("header")).select("record")
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    opener = F.last(F.when(F.col("kind") == TAIL, F.col("block")), ignorenulls=True).over(in_order)
    across = (parts.where(F.col("kind") != WHOLE).withColumn("opener", opener).groupBy("file", "opener")
              .agg(F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
              .where(~F.col("header")).select(F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    ended = F.regexp_replace("record", "\r$", "").alias("record")
    return whole.unionByName(across).select(ended).where(F.col("record") != "")


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV scan; without a schema every column is text (no inference pass). The
    index is made, in one pass over the lines, when this is called."""
    reader = spark.read.options(**CSV_OPTS, **CSV_READ)
    if schema is None:
        header = reader.options(multiLine="true").csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    kept = scratch_path(spark, "csv_index")
    quote_index(csv_lines(spark, path)).write.parquet(kept)
    index = spark.read.schema("file string, block long, inside boolean, breaks boolean").parquet(kept)
    if index.where("breaks").isEmpty():
        return _strings(spark.read.options(**CSV_OPTS, **CSV_READ).schema(schema).csv(path), _unmarked)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = csv_records(spark, path, index).select(F.from_csv("record", ddl, {**CSV_OPTS, **CSV_READ, "multiLine": "true"}).alias("r"))
    return _strings(rows.select("r.*"), _unmarked)


def read_csv_in_order(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV folder without line breaks in values, with ``position``: the 0-based
    place of each row in the order of the files (by part number) and of the rows in them."""
    rows = spark.read.options(**CSV_OPTS, **CSV_READ).schema(schema).csv(path)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    rows = rows.select("*", part.alias("_part"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_line"))
    sizes = rows.groupBy("_part", "_block").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each byte range of the files
    before = Window.orderBy("_part", "_block").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_part", "_block").orderBy("_line")) - 1
    placed = rows.withColumn("_in", inside).join(first, ["_part", "_block"])
    return _strings(placed.withColumn("position", F.col("_first") + F.col("_in")).drop("_part", "_block", "_line", "_in", "_first"), _unmarked)
