"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import gridmetrics
from gridmetrics.session import drop_path, scratch_path

#: Characters that separate words: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Rows of one block of a distributed rank: small enough to sort in memory.
BLOCK_ROWS = 5_000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: their Python
    workers import the operators' functions, and need not have the repository
    on their path. Spark copies the archive to them."""
    sc = spark.sparkContext
    package = Path(gridmetrics.__file__).parent
    if sc.applicationId in _SHIPPED or not package.is_dir():  # already run from an archive
        return
    _SHIPPED.add(sc.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="gridmetrics-code-")) / "gridmetrics.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(archive))


class Scratch:
    """Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

    A written table cuts lineage and survives the loss of executors. Tables
    that nothing reads any more are dropped early; the rest goes when the
    session ends.
    """

    #: All of this process, in order of creation.
    made: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0
        Scratch.made.append(self)
        ship(spark)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            drop_path(self.spark, t._scratch_path)

    def clear(self) -> None:
        """Drop all tables; for when everything that reads them is written."""
        drop_path(self.spark, self.root)


#: Rows of an Arrow batch that holds whole texts, on either side of the Python boundary.
TEXT_BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts to a few megabytes (Spark's default of 10,000
    rows takes tens of megabytes several times over in each task)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


#: Settings under which tasks hold few whole texts at once: rows of a batch of Spark's
#: Parquet reader, and rows of an Arrow batch.
FEW_TEXTS = {"spark.sql.parquet.columnarReaderBatchSize": 64, "spark.sql.execution.arrow.maxRecordsPerBatch": 256}


@contextmanager
def few_texts(spark: SparkSession) -> Iterator[None]:
    """What is run within it reads and sends texts in batches of few rows.

    Spark's defaults of 4,096 and 10,000 rows take arrays of tens of megabytes
    of text in each task, for which the heap of an executor grows and stays
    large. The session's settings, better for narrow rows, come back afterwards.
    """
    before = {key: spark.conf.get(key) for key in FEW_TEXTS}
    try:
        for key, rows in FEW_TEXTS.items():
            if not 0 < int(before[key]) <= rows:
                spark.conf.set(key, str(rows))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Inside a higher-order function a plain expression would be evaluated anew
    for every element; as a lambda variable it is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; no words: an empty array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_key(c: Column) -> Column:
    """A never-null key of a nullable text column; null sorts after all texts."""
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


#: A group is salted so that no task must take more than this part of all rows for it.
HEAVY = 1000


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` (``total`` of them) with one row for each group, whose size
    is ``c``, without sending a large group to one task.

    A group of more than 1/``HEAVY`` of all rows is dealt to as many salts as it
    has such parts, and its row in ``groups`` is repeated for each, ``HEAVY``
    rows more in all. The numbers of salts of these groups, at most ``HEAVY``
    rows of the keys, are broadcast. Rows with a null key match nothing and are
    spread too. ``how``: ``inner`` or ``left``.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("c") * HEAVY / max(total, 1)).cast("int"))
    heavy = groups.select(*keys, parts.alias("_parts")).filter("_parts > 1")
    null = F.coalesce(*(F.when(F.col(k).isNull(), F.lit(HEAVY)) for k in keys))
    number = F.monotonically_increasing_id()
    salted = (rows.join(F.broadcast(heavy), keys, "left")
              .withColumn("_salt", F.pmod(number, F.coalesce(null, F.col("_parts"), F.lit(1))).cast("int")).drop("_parts"))
    dealt = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.join(dealt, [*keys, "_salt"], how).drop("_salt")


def ranked(df: DataFrame, keys: list[str], order: list[Column], n_rows: int, out: str = "rank",
           block: Column | None = None) -> DataFrame:
    """Add ``out``: the gapless 0-based place of each row within its ``keys``.

    Spread over blocks of about ``BLOCK_ROWS`` rows by a hash of the ordering
    columns, so a key that holds most rows is still ranked by many tasks; a
    small table of block sizes gives each block its first place. The place is
    a function of the rows alone (block, then ``order``). ``block`` overrides
    the block number where its order matters.
    """
    n_blocks = max(1, -(-n_rows // BLOCK_ROWS))
    b = block if block is not None else F.pmod(F.xxhash64(*order), F.lit(n_blocks))
    blocked = df.withColumn("_block", b.cast("long"))
    key = [F.col(k) for k in keys]
    sizes = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*key, F.col("_block")).orderBy(*order)
    return (blocked.withColumn("_in", F.row_number().over(inside) - 1)
            .join(first, [*keys, "_block"])
            .withColumn(out, (F.col("_first") + F.col("_in")).cast("long"))
            .drop("_block", "_first", "_in"))
