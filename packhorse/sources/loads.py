"""Upserts and partitioned loads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import all_of
from packhorse.functions.skew import ROWS_PER_TASK, filter_join
from packhorse.operators.keys import dedupe_latest
from packhorse.session import delete_by_uri
from packhorse.session import stored as stored_copy

# The file of a stored row, as a URI.
FILE = "_file"


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    latest: Sequence[Column],
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """The target with changed rows replaced by key and new ones added.

    Of several changes to a key the first in the order `latest` wins; it replaces
    all rows of that key. A small set of changes is broadcast by its size, and
    the target is not shuffled.
    """
    newest = dedupe_latest(changes, keys, latest)
    replaced = newest.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
    same = all_of(F.col(key).eqNullSafe(F.col(f"_new_{key}")) for key in keys)
    kept = filter_join(target, replaced, same, "left_anti", keys, rows_per_task)
    return kept.unionByName(newest.select(*target.columns))


def load_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Write `df`, replacing the partitions it has rows for and no others.

    Rows are gathered by partition, so that each gets few files; adaptive
    execution splits a partition that is large and joins small ones.
    """
    (
        df.hint("rebalance", *[F.col(name) for name in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def upsert_partitions(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    latest: Sequence[Column],
    keys_stay: bool = False,
) -> None:
    """P17 into a table written by P18: read and rewrite touched partitions only.

    A key may move: the partitions that hold rows of changed keys now are found
    from the stored keys and rewritten too, and a partition that loses its last
    row is deleted. `keys_stay` spares that pass over the stored key columns where
    keys never move. The old files stay until the new ones are complete; Spark
    then swaps folders one by one, so readers should wait for the job to end.
    """
    # Folder names are read as the changes' type: what looks like a number may be text.
    found = spark.read.parquet(path).schema
    kinds = [T.StructField(f.name, (changes.schema if f.name in partitions else found)[f.name].dataType) for f in found.fields]
    stored = spark.read.schema(T.StructType(kinds)).parquet(path).withColumn(FILE, F.col("_metadata.file_path"))
    touched, pruned, merged = merge_plan(stored, changes, keys, partitions, latest, keys_stay)
    emptied = _emptied(pruned, merged, partitions)
    load_partitions(merged, path, partitions)
    for folder in emptied:
        delete_by_uri(spark, folder)


def merge_plan(
    stored: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    latest: Sequence[Column],
    keys_stay: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What an upsert of `changes` does to a partitioned table.

    The partitions it touches (with `_n`), their rows now, and their rows then,
    without a column `FILE` that `stored` may have.
    """
    types = {name: stored.schema[name].dataType for name in partitions}
    cast = changes.withColumns({name: _as_folder(F.col(name), t) for name, t in types.items()})
    newest = stored_copy(dedupe_latest(cast, keys, latest), "changes")
    touched = newest.select(*partitions)
    if not keys_stay:
        changed = newest.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
        same = all_of(F.col(key).eqNullSafe(F.col(f"_new_{key}")) for key in keys)
        holding = stored.select(*dict.fromkeys([*keys, *partitions])).join(changed, same, "left_semi")
        touched = touched.unionByName(holding.select(*partitions))
    touched = stored_copy(touched.groupBy(*partitions).agg(F.count(F.lit(1)).alias("_n")), "touched")
    pruned = of_partitions(stored, touched, partitions)
    return touched, pruned, upsert(pruned.drop(FILE), newest, keys, latest)


def _as_folder(value: Column, kind: T.DataType) -> Column:
    """A partition value as its folder gives it back: empty text is stored as null."""
    value = value.cast(kind)
    return F.nullif(value, F.lit("")) if isinstance(kind, T.StringType) else value


def of_partitions(stored: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The stored rows of touched partitions (with `_n`); only their folders are read.

    The join prunes the scan at run time, which Spark does for equality and a
    filtered side. Partitions with a null value are pruned by a plain filter.
    """
    names = {name: f"_in_{name}" for name in partitions}
    wanted = touched.withColumnsRenamed(names).filter("_n > 0")
    equal = all_of(F.col(name) == F.col(other) for name, other in names.items())
    alike = all_of(F.col(name).eqNullSafe(F.col(other)) for name, other in names.items())
    some_null = reduce(or_, [F.col(name).isNull() for name in partitions])
    return stored.join(wanted, equal, "left_semi").unionByName(
        stored.filter(some_null).join(wanted, alike, "left_semi")
    )


def _emptied(pruned: DataFrame, merged: DataFrame, partitions: Sequence[str]) -> list[str]:
    """Folders of partitions that hold rows now and will not: as many as keys move out of for good."""
    names = {name: f"_left_{name}" for name in partitions}
    left = merged.select(*partitions).distinct().withColumnsRenamed(names)
    alike = all_of(F.col(name).eqNullSafe(F.col(other)) for name, other in names.items())
    folder = F.regexp_replace(FILE, "/[^/]*$", "").alias("folder")
    return [row.folder for row in pruned.join(left, alike, "left_anti").select(folder).distinct().collect()]
