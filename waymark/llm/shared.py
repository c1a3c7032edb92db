"""Helpers the operators of this subpackage share: words, row keys, stored stages, offsets."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What separates words that consist of letters, digits and everything beyond ASCII; the second
# form is for text that keeps its capitals, the third separates by white space alone.
ITEM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEM_SEPARATORS_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"

# Texts that a task works on together.
SLICE_ROWS = 4_096
SLICE_BYTES = 4_000_000

# Rows up to which a side of a join counts as small whatever the input; its rows are counted
# before it is broadcast, and with more of them the join is left to Spark.
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column, separators: str) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by their whole names, whatever these contain."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def row_keys() -> list[Column]:
    """Two hashes that tell documents apart by id and whole text, and are never null.

    Rows that repeat both share their keys, which is right for whatever follows from the text.
    """
    return [
        F.xxhash64("text").alias("k1"),
        F.xxhash64("doc_id", F.length("text"), F.lit("row")).alias("k2"),
    ]


def with_words(documents: DataFrame, text: Column, separators: str) -> DataFrame:
    """``k1, k2, words, n_words`` per document.

    The words pass through a generator of one row, so that they are split once and not again
    in each expression that names them.
    """
    one = F.explode(F.array(words_of(text, separators))).alias("words")
    return documents.select(*row_keys(), one).withColumn("n_words", F.size("words"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; the warehouse where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, which goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: done once, safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over Arrow batches that hands back the memory it no longer uses when it is done.

    Python workers live on for the tasks of other stages, and Arrow and the C library would keep
    what the largest batches took for each of them.
    """

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def slices(
    batch: pa.RecordBatch, size: int | None = None, column: int = 1
) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``SLICE_ROWS`` rows and, but for a single text that has
    more, ``size`` bytes (``SLICE_BYTES`` if not given) of the text in a ``column``."""
    size = size or SLICE_BYTES
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    whole = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = whole[at - 1] if at else 0
        end = int(np.searchsorted(whole, before + size, "right"))
        end = min(max(end, at + 1), at + SLICE_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` allow one."""
    return F.broadcast(df) if rows <= limit else df


def text_sample(
    documents: DataFrame, usable: Column, limit: int, keys: Sequence[str] = ()
) -> DataFrame:
    """``keys, text, mark``: per ``keys`` the ``usable`` texts whose hash ``mark`` is among the
    ``limit`` least.

    Hashes are made distinct before they are ranked, so a text counts once however many copies
    it has. How many there are gives a threshold, and only hashes below it, some times the limit
    whatever the input, are ranked; a key that has fewer than the limit below it takes all its
    hashes. Texts themselves are not moved before it is known which few are wanted.
    """
    keys = list(keys)
    marked = documents.select(*keys, "text", F.xxhash64("text").alias("mark"), usable.alias("_use"))
    marks = stored(marked.where("_use").select(*keys, "mark").distinct(), "hashes")
    counts = stored(marks.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "counts")
    share = (F.col("mark") / 2.0**64 + 0.5) * F.col("_n")
    # Of hashes spread evenly about twice the limit lie below, and hardly ever less than it.
    below = F.col("_n").isNull() | (F.col("_n") <= 8 * limit) | (share < 2 * limit + 16)
    if keys:
        same = F.lit(True)
        for key in keys:
            same = same & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
        few = marks.alias("a").join(small(counts, counts.count()).alias("b"), same).where(below)
        few = few.select("a.*")
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("mark"))
        marks = few.withColumn("_nth", nth).where(F.col("_nth") <= limit).drop("_nth")
    else:
        total = counts.first()["_n"]
        few = marks.withColumn("_n", F.lit(total)).where(below).drop("_n")
        marks = few.orderBy("mark").limit(limit)
    marks = stored(marks, "marks")
    found = marked.join(small(marks, marks.count()), [*keys, "mark"])
    return found.select(*keys, "text", "mark").distinct()


def running_start(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows before, per ``keys`` (not null).

    Rows are dealt out by ranges of keys and order, summed per range, and only the sums of
    ranges are added up along a key. A key with a third of all rows is many ranges.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    along = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(*keys, "_range")
        .agg(F.sum(amount).alias("_sum"))
        .select(*keys, "_range", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_before"))
    )
    within = (
        Window.partitionBy(*keys, "_range").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_before") + F.coalesce(F.sum(amount).over(within), F.lit(0))
    return ranged.join(before, [*keys, "_range"]).withColumn(name, start).drop("_range", "_before")
