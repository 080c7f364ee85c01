"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packhorse.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of text per Arrow batch. Texts differ in length by orders of magnitude.
TEXT_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def by_small_batches(df: DataFrame) -> DataFrame:
    """`df`; its session sends texts to Python in batches of at most `TEXT_ROWS` rows from now on.

    Spark's default of 10,000 rows lets a batch of long texts fill a worker's
    memory. A lower setting of the session's stays.
    """
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(_ROWS)) <= TEXT_ROWS:
        spark.conf.set(_ROWS, str(TEXT_ROWS))
    return df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 50) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows: where copies of a long text come one after the other, a batch is large."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def give_back() -> None:
    """For the end of a task's work in Python: hand freed memory back to the system.

    Spark keeps its Python workers for later tasks, and they would keep what the
    largest of their tasks has used.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        # Only some C libraries have it.
        ctypes.CDLL(None).malloc_trim(0)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read back.

    Cuts the lineage, so that a lost executor costs a re-read and not the work
    behind it, and makes a random or partition-dependent column (a row number)
    the same for all readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_training(id_column: str) -> Column:
    """The rows that models may learn from: crc32 of the id as text, modulo 3, is not 1."""
    return ~held_out(id_column)


def held_out(id_column: str) -> Column:
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def bounded_broadcast(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """`df`, a stored table of short rows, marked for broadcast if it has no more than `rows`.

    Beyond that Spark shuffles, and splits the partitions of large keys at run time.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def running_start(df: DataFrame, order: Sequence[str], value: str, out: str, label: str) -> DataFrame:
    """Adds `out`: the sum of `value` over all rows before this one, in `order`.

    The order must be unique. Rows are range-partitioned along it, so that no
    key's rows meet in one task however many there are, and stored. Only one
    total per partition is summed up in a single task.
    """
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    rows = stored(dealt, label)
    totals = rows.groupBy("_part").agg(F.sum(value).alias("_total"))
    before = F.sum("_total").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per partition of the range exchange.
    carried = totals.select("_part", F.coalesce(before, F.lit(0)).alias("_carried"))
    within = F.sum(value).over(
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = rows.withColumn("_within", F.coalesce(within, F.lit(0)))
    return (
        summed.join(F.broadcast(carried), "_part")
        .withColumn(out, (F.col("_carried") + F.col("_within")).cast("long"))
        .drop("_part", "_within", "_carried")
    )
