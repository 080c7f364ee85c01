"""P19, P20 and P21 on the events as a stream.

The SQL states what append mode emits: windows and sessions that end no later
than the watermark, which is the last event's time less the delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packhorse.functions.columns import money
from packhorse.plans.registry import query
from packhorse.session import delete_scratch, scratch_path
from packhorse.sources.contracts import CONTRACTS, read_table
from packhorse.streaming.events import (
    read_parquet_stream,
    row_account,
    run_available,
    stream_dedupe,
    stream_sessions,
    streaming_session,
    tumbling_counts,
)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    # The file source takes folders and patterns, and the table may be one file.
    path = f"{folder.rstrip('/')}/[e]vents.parquet"
    events = read_parquet_stream(streaming_session(spark), path, CONTRACTS["events"])
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _result(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    run_available(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


@query(
    """
    SELECT * FROM (
        SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
            time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
            event_type, count(*) AS n_events,
            CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value
        FROM events GROUP BY ALL)
    WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
    """
)
def p19_windows_stream(spark: SparkSession, folder: str) -> DataFrame:
    counts = tumbling_counts(
        _events(spark, folder), "ts", "10 minutes", ["event_type"], money("value"), "10 minutes"
    )
    result = _result(spark, counts, "windows")
    return result.withColumn("total_value", F.col("total_value").cast("double"))


# Fixed damage: every 23rd event has no time, every 17th arrives two files of eight days late.
_ARRIVING = """
    SELECT * EXCEPT (ts), CASE WHEN event_id % 23 <> 0 THEN ts END AS ts,
        CAST(least(3, floor((coalesce(CASE WHEN event_id % 23 <> 0 THEN day(ts) END, 1) - 1) / 8))
            + CASE WHEN event_id % 17 = 0 THEN 2 ELSE 0 END AS INTEGER) AS file
    FROM {events}
"""


@query(
    f"""
    WITH arriving AS ({_ARRIVING.replace("EXCEPT", "EXCLUDE").format(events="events")}),
    ends AS (SELECT file, ts, time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end FROM arriving),
    marks AS (SELECT f.file, max(e.ts) - INTERVAL 10 MINUTE AS mark
              FROM (SELECT DISTINCT file FROM ends) f LEFT JOIN ends e ON e.file <= f.file - 2 GROUP BY f.file),
    told AS (
        SELECT CASE WHEN ts IS NULL THEN 'undated' WHEN window_end <= mark THEN 'late'
            WHEN window_end > (SELECT max(ts) - INTERVAL 10 MINUTE FROM ends) THEN 'open' ELSE 'kept' END AS kind
        FROM ends JOIN marks USING (file))
    SELECT count(*) AS n_read, count_if(kind = 'kept')::BIGINT AS n_kept, count_if(kind = 'undated')::BIGINT AS n_undated,
        count_if(kind = 'open')::BIGINT AS n_open, count_if(kind = 'late')::BIGINT AS n_late
    FROM told
    """
)
def p19_row_account(spark: SparkSession, folder: str) -> DataFrame:
    """What a stream of one file a batch keeps and loses.

    A batch drops rows by the watermark of the batch before it, which is taken
    from the batches before that.
    """
    events = spark.sql(_ARRIVING, events=read_table(spark, folder, "events"))
    path = scratch_path(spark, "arriving")
    first, last = events.agg(F.min("file"), F.max("file")).first()
    for number in range(first, last + 1):
        events.filter(F.col("file") == number).coalesce(1).write.parquet(f"{path}/in/file={number}")
    stream = read_parquet_stream(streaming_session(spark), f"{path}/in/file=*", events.schema, files_per_batch=1)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    counts = tumbling_counts(stream, "ts", "10 minutes", ["event_type"], money("value"), "10 minutes")
    watermark = run_available(counts, f"{path}/table", f"{path}/checkpoint")
    windows = spark.read.schema(counts.schema).parquet(f"{path}/table")
    return row_account(events, "ts", "10 minutes", windows, watermark)


@query(
    """
    WITH marked AS (
        SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (
        SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING) AS session FROM marked)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
        CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value
    FROM numbered GROUP BY user_id, session
    HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
    """
)
def p20_sessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    sessions = stream_sessions(
        _events(spark, folder), ["user_id"], "ts", "30 minutes", money("value"), "10 minutes"
    )
    result = _result(spark, sessions, "sessions")
    return result.withColumn("total_value", F.col("total_value").cast("double"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def p21_dedupe_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice, the second time stamped five minutes later."""
    events = _events(spark, folder).select("event_id", "ts", "user_id", "event_type", "value")
    repeated = events.unionByName(events.withColumn("ts", F.expr("ts + INTERVAL 5 MINUTES")))
    once = stream_dedupe(repeated, ["event_id"], "ts", "10 minutes").drop("ts")
    return _result(spark, once, "deduplicated")


# Rows of a file that is one batch of the stream, and that one task writes.
ROWS_PER_FILE = 4_000_000


def _write_spans(df: DataFrame, span: Column, path: str) -> None:
    """The rows of each span as files of its own, of about `ROWS_PER_FILE` rows, written in the order of the spans.

    Rows without a span are left out. All tasks sort out the rows of the spans in one
    pass; what one task then writes to a file is a part of one span.
    """
    spark = df.sparkSession
    sorted_out = scratch_path(spark, "spans")
    dated = df.withColumn("span", span).filter("span IS NOT NULL")
    dated.write.partitionBy("span").parquet(sorted_out)
    rows = spark.read.schema(dated.schema).parquet(sorted_out)
    # As many rows as there are spans.
    counts = {row["span"]: row["count"] for row in rows.groupBy("span").count().collect()}
    for number in range(min(counts), max(counts) + 1):
        files = 1 + counts.get(number, 0) // ROWS_PER_FILE
        part = rows.filter(F.col("span") == number).drop("span")
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.parquet(f"{path}/span={number:04d}")
    delete_scratch(spark, sorted_out)


@query(
    """
    SELECT event_id, user_id, event_type, value FROM events
    UNION ALL SELECT event_id, user_id, event_type, value FROM events
    """
)
def p21_dedupe_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives three times: as it is, 5 and 25 days later, read in spans of 5 days.

    The second copy is within the bound of the first and is dropped; the third
    is beyond it, and must not be held back by the second. A span may come in several
    files, which are a batch each: none of its rows is late, as spans are shorter than the bound.
    """
    events = read_table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    copies = [events.withColumn("ts", F.expr(f"ts + INTERVAL {days} DAYS")) for days in (0, 5, 25)]
    every = copies[0].unionByName(copies[1]).unionByName(copies[2])
    span = F.floor(F.datediff("ts", F.lit("2024-01-01")) / 5)
    path = scratch_path(spark, "chains")
    _write_spans(every, span, path)
    stream = read_parquet_stream(streaming_session(spark), f"{path}/span=*", every.schema, files_per_batch=1)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    return _result(spark, stream_dedupe(stream, ["event_id"], "ts", "6 days").drop("ts"), "chains")
