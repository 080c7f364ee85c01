"""Session defaults, and the shared folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime re-planning is what keeps the joins safe when one key holds a large
# share of the rows, so it is forced even where it costs a second shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    name: str = "packhorse", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with this library's defaults.

    Pass `master` only for local runs; under spark-submit the cluster names
    the master, the memory and the number of shuffle partitions. Keyword names
    use `__` for the dots of a Spark setting.
    """
    builder = SparkSession.builder.appName(name)
    settings = {
        **ADAPTIVE,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    if master is not None:
        builder = builder.master(master)
        cores = master.partition("[")[2].rstrip("]")
        cores = os.cpu_count() if cores in ("", "*") else cores
        settings["spark.sql.shuffle.partitions"] = str(cores)
        settings["spark.ui.showConsoleProgress"] = "false"
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder, visible to every executor, for a table a job writes.

    It lies under the folder that `spark.checkpoint.dir` names. Only a local
    session may do without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                f"set {CHECKPOINT_DIR} to a folder that all executors share"
            )
        root = _local_folder(spark.sparkContext.applicationId)
    path = f"{root.rstrip('/')}/packhorse/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to a fresh scratch folder and read back, the same for all that read it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete one folder that `scratch_path` gave, when no plan reads it any more."""
    delete_folder(spark, path)
    if path in _scratch:
        _scratch.remove(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark knows."""
    _delete(spark, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))


def delete_by_uri(spark: SparkSession, uri: str) -> None:
    """Delete a folder named as in `_metadata.file_path`, which is encoded as a URI; it must be there."""
    jvm = spark.sparkContext._jvm
    if not _delete(spark, jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))):
        raise FileNotFoundError(f"nothing to delete at {uri}")


def _delete(spark: SparkSession, folder) -> bool:
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete the folders `scratch_path` gave to this process.

    For the end of a job: results that read from them can no longer be used.
    """
    while _scratch:
        delete_folder(spark, _scratch.pop())
