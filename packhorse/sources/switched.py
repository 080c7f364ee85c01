"""P18 with a switch: partitioned tables of which readers see whole loads only.

The files of a load lie in folders of their own, data/<partitions>/load_id=...,
and are never changed. A manifest lists which load each partition is taken from,
and a pointer names the newest manifest. A load writes its files, then its
manifest, and last moves one small file to the name of the next pointer. A load
that is killed before that leaves files which no manifest lists; readers, and
the next load, go by the pointer that is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.functions.columns import all_of
from packhorse.session import delete_by_uri
from packhorse.sources.loads import FILE, merge_plan, of_partitions

LOAD = "load_id"
ROWS = "_n"


class LoadConflict(RuntimeError):
    """Another load has moved the pointer since this one read the table."""


class Pointer(NamedTuple):
    """The newest complete load: its number, its manifest and the table's schema."""

    number: int
    manifest: str
    schema: T.StructType
    partitions: list[str]


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest_pointer(spark: SparkSession, path: str) -> Pointer | None:
    """The pointer with the highest number, or None before the first load."""
    folder, files = _path(spark, path, "pointers"), _files(spark, path)
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = sorted(int(name) for name in names if name.isdigit())
    if not numbers:
        return None
    told = json.loads(spark.read.text(f"{path}/pointers/{numbers[-1]:010d}", wholetext=True).first().value)
    schema = T.StructType.fromJson(told["schema"])
    return Pointer(numbers[-1], told["manifest"], schema, told["partitions"])


def _move_pointer(spark: SparkSession, path: str, pointer: Pointer) -> None:
    """Write the pointer beside its place, then rename it there, unless there is one."""
    files, name = _files(spark, path), f"{pointer.number:010d}"
    told = {"manifest": pointer.manifest, "schema": pointer.schema.jsonValue(), "partitions": pointer.partitions}
    beside, there = _path(spark, path, "pointers", f".{uuid.uuid4().hex}"), _path(spark, path, "pointers", name)
    out = files.create(beside, False)
    try:
        out.write(json.dumps(told).encode())
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    # This rename, unlike the one of FileSystem, never replaces a file.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(there).toUri(), conf)
    never = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(beside), files.makeQualified(there), never)
    except Exception as error:
        files.delete(beside, False)
        if files.exists(there):
            raise LoadConflict(f"load {pointer.number} of {path} was completed by another job") from error
        raise


def _stored(spark: SparkSession, path: str, pointer: Pointer) -> DataFrame:
    """The rows of all loads that left files, complete or not, with their load."""
    schema = T.StructType([*pointer.schema.fields, T.StructField(LOAD, T.StringType())])
    return spark.read.schema(schema).parquet(f"{path}/data")


def _live(spark: SparkSession, path: str, pointer: Pointer) -> DataFrame:
    """Partitions with the load each is taken from, and its number of rows."""
    kinds = [pointer.schema[name] for name in pointer.partitions]
    schema = T.StructType([*kinds, T.StructField(LOAD, T.StringType()), T.StructField(ROWS, T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/{pointer.manifest}")


def _opened(spark: SparkSession, path: str) -> Pointer:
    pointer = latest_pointer(spark, path)
    if pointer is None:
        raise FileNotFoundError(f"no load of {path} has been completed")
    return pointer


def read_switched(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The table as the newest complete load left it; only live folders are read."""
    pointer = _opened(spark, path)
    rows = of_partitions(_stored(spark, path, pointer), _live(spark, path, pointer), [*pointer.partitions, LOAD])
    return rows.select(*[F.col(f"`{name}`") for name in columns or pointer.schema.fieldNames()])


def load_switched(
    spark: SparkSession, path: str, df: DataFrame, partitions: Sequence[str], emptied: DataFrame | None = None
) -> None:
    """Replace the partitions that `df` has rows for, and remove those of `emptied` that it has none for."""
    _load(spark, path, df, partitions, emptied, latest_pointer(spark, path))


def _load(
    spark: SparkSession, path: str, df: DataFrame, partitions: Sequence[str], emptied: DataFrame | None, before: Pointer | None
) -> None:
    if LOAD in df.columns:
        raise ValueError(f"a column may not be named {LOAD}")
    load, partitions = uuid.uuid4().hex, list(partitions)
    if before is None:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        after = Pointer(1, f"manifests/{load}", schema, partitions)
    else:
        after = before._replace(number=before.number + 1, manifest=f"manifests/{load}")
        kinds = [(f.name, f.dataType) for f in df.select(*after.schema.fieldNames()).schema.fields]
        if partitions != after.partitions or kinds != [(f.name, f.dataType) for f in after.schema.fields]:
            raise ValueError(f"columns or partitions are not those of {path}")
    (
        df.select(*[F.col(f"`{name}`") for name in after.schema.fieldNames()])
        .hint("rebalance", *[F.col(name) for name in partitions])
        .withColumn(LOAD, F.lit(load))
        .write.mode("append").partitionBy(*partitions, LOAD).parquet(f"{path}/data")
    )
    # Counted in what was written; no column of the files is read for it. A load
    # without rows leaves no folder.
    written = (
        _stored(spark, path, after).filter(F.col(LOAD) == load)
        .groupBy(*partitions, LOAD).agg(F.count(F.lit(1)).alias(ROWS))
    )
    live = written
    if before is not None:
        # One short row per partition.
        replaced = written.select(*partitions)
        if emptied is not None:
            replaced = replaced.unionByName(emptied.select(*partitions))
        names = {name: f"_gone_{name}" for name in partitions}
        same = all_of(F.col(name).eqNullSafe(F.col(gone)) for name, gone in names.items())
        old = _live(spark, path, before)
        live = old.join(replaced.withColumnsRenamed(names), same, "left_anti").unionByName(written)
    live.write.parquet(f"{path}/{after.manifest}")
    _move_pointer(spark, path, after)


def upsert_switched(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    latest: Sequence[Column],
    keys_stay: bool = False,
) -> None:
    """`upsert_partitions` for such a table: readers see all of the upsert or nothing of it."""
    before = _opened(spark, path)
    stored = read_switched(spark, path)
    touched, _, merged = merge_plan(stored, changes, keys, before.partitions, latest, keys_stay)
    _load(spark, path, merged, before.partitions, touched, before)


def drop_unused(spark: SparkSession, path: str, before: str) -> int:
    """Delete folders of files that no reader of the newest load needs, and return how many.

    Only files that were last changed before the time `before` go: a load that is
    under way, and readers that began with an earlier pointer, still need theirs.
    """
    pointer = _opened(spark, path)
    names = {name: f"_live_{name}" for name in [*pointer.partitions, LOAD]}
    live = _live(spark, path, pointer).drop(ROWS).withColumnsRenamed(names)
    same = all_of(F.col(name).eqNullSafe(F.col(other)) for name, other in names.items())
    stored = _stored(spark, path, pointer).select(
        *names, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias("_at")
    )
    folder = F.regexp_replace(FILE, "/[^/]*$", "").alias("folder")
    unused = (
        stored.join(live, same, "left_anti").groupBy(folder).agg(F.max("_at").alias("_at"))
        .filter(F.col("_at") < F.lit(before).cast("timestamp"))
    )
    n = 0
    for row in unused.select("folder").collect():
        delete_by_uri(spark, row.folder)
        n += 1
    return n
