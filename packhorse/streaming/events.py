"""Operators on a stream, and running it to a Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with settings for stateful streams.

    Watermarks need `timestamp`, so the zone is fixed to UTC. State is kept in
    RocksDB, on disk, as it may outgrow the heap. `spark.sql.shuffle.partitions`
    stays the caller's: it is fixed for the life of a checkpoint, and each
    partition holds a state store, so choose it for the stream's final size.
    """
    side = spark.newSession()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    side.conf.set("spark.sql.shuffle.partitions", partitions)
    side.conf.set("spark.sql.session.timeZone", "UTC")
    # Sessions are merged before the shuffle too, so a busy key sends few rows.
    side.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    side.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return side


def read_parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of the files at `path`, a folder or a pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def tumbling_counts(
    df: DataFrame, at: str, width: str, by: Sequence[str], value: Column, delay: str | None = None
) -> DataFrame:
    """Events and total of `value` per tumbling window and `by`.

    The same for a batch and a stream. A stream needs `delay`: rows older than
    the watermark are dropped, and a window is emitted once it has passed. Rows
    without a time are in no window. `row_account` counts what is lost.
    """
    if delay is not None:
        df = df.withWatermark(at, delay)
    return df.groupBy(F.window(at, width), *by).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total_value")
    ).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *by, "n_events", "total_value",
    )


def row_account(read: DataFrame, at: str, width: str, windows: DataFrame, watermark: str | None = None) -> DataFrame:
    """One row that says where the rows of `read` went: `n_read` is the sum of the others.

    `read` is what the stream has read, as a table, and `windows` what it has emitted.
    `n_kept` rows are in emitted windows, `n_undated` have no time, `n_open` are in
    windows that end after `watermark`, which `run_available` returns, and wait for
    more input; the rest came too late (`n_late`). Without a watermark, as for a
    batch, no window is open.
    """
    end = F.window(F.col(at).cast("timestamp"), width).getField("end")
    is_open = F.lit(False) if watermark is None else end > F.lit(watermark).cast("timestamp")
    names = ("n_read", "n_undated", "n_open", "n_kept")

    def counted(df: DataFrame, **counts: Column) -> DataFrame:
        return df.agg(*[F.coalesce(counts.get(name, F.lit(0)), F.lit(0)).cast("long").alias(name) for name in names])

    # The window of a null is no row, so undated rows are counted apart. One row each.
    parts = counted(read, n_read=F.count(F.lit(1)), n_undated=F.count_if(F.col(at).isNull()))
    dated = read.filter(F.col(at).isNotNull()).select(is_open.alias("is_open"))
    parts = parts.unionByName(counted(dated, n_open=F.count_if("is_open")))
    parts = parts.unionByName(counted(windows, n_kept=F.sum("n_events")))
    late = F.col("n_read") - F.col("n_undated") - F.col("n_open") - F.col("n_kept")
    return parts.agg(*[F.sum(name).alias(name) for name in names]).select(
        "n_read", "n_kept", "n_undated", "n_open", late.alias("n_late")
    )


def stream_sessions(
    df: DataFrame, keys: Sequence[str], at: str, gap: str, value: Column, delay: str
) -> DataFrame:
    """P20 on a stream: sessions, each emitted once the watermark has passed it."""
    return df.withWatermark(at, delay).groupBy(F.session_window(at, gap), *keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(value).alias("total_value"),
        F.max(at).cast("timestamp_ntz").alias("session_end"),
    ).select(
        *keys,
        F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
        "session_end", "n_events", "total_value",
    )


def stream_dedupe(df: DataFrame, keys: Sequence[str], at: str, bound: str) -> DataFrame:
    """The first row per key to arrive; later ones within `bound` of it are dropped.

    A row is compared with the last row that was let through, not with those
    that were dropped. State is one row per key, so a busy key costs time in its
    task but no memory.
    """
    return df.withWatermark(at, bound).dropDuplicatesWithinWatermark(list(keys))


def run_available(df: DataFrame, path: str, checkpoint: str) -> str | None:
    """Process what is there now, append it to the Parquet table `path`, and stop.

    Run again with the same checkpoint, it goes on where it stopped; the file
    sink and the checkpoint together give each row once. Returns the watermark, up
    to which windows were emitted, if there is one.
    """
    query = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = query.lastProgress
    return None if last is None else last["eventTime"].get("watermark")
