"""Streams over several batches: late rows, restarts and repeated rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse import session
from packhorse.plans import streams
from packhorse.streaming.events import (
    read_parquet_stream,
    row_account,
    run_available,
    stream_dedupe,
    stream_sessions,
    streaming_session,
    tumbling_counts,
)

T0 = datetime(2024, 1, 1)
SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())]
)


class Feed:
    """A folder to which batches of rows are added, one file each, and a stream on it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        self.side = streaming_session(spark)

    def add(self, rows):
        path = str(self.folder / "in" / f"batch={self.n}")
        self.n += 1
        times = [(i, T0 + timedelta(minutes=m)) for i, m in rows]
        self.spark.createDataFrame(times, SCHEMA).coalesce(1).write.parquet(path)

    def stream(self):
        path = str(self.folder / "in" / "batch=*")
        rows = read_parquet_stream(self.side, path, SCHEMA, files_per_batch=1)
        return rows.withColumn("ts", F.col("ts").cast("timestamp"))

    def run(self, df):
        out = str(self.folder / "out")
        run_available(df, out, str(self.folder / "checkpoint"))
        return self.spark.read.schema(df.schema).parquet(out)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_late_rows_are_dropped_and_windows_emitted_once(feed):
    def counts():
        one = F.lit(Decimal(1))
        return tumbling_counts(feed.stream(), "ts", "10 minutes", [], one, "5 minutes")

    feed.add([(1, 1), (2, 9)])
    feed.add([(3, 21)])  # the watermark goes to 16 minutes
    feed.run(counts())
    feed.add([(4, 3), (5, 17)])  # the first row is late, the second is not
    feed.add([(6, 60)])
    got = feed.run(counts()).orderBy("window_start").collect()
    starts = [(int((r.window_start - T0).total_seconds() // 60), r.n_events) for r in got]
    assert starts == [(0, 2), (10, 1), (20, 1)]


def test_batch_and_stream_agree(feed):
    feed.add([(i, i) for i in range(100)])
    one = F.lit(Decimal(1))
    stream = tumbling_counts(feed.stream(), "ts", "10 minutes", [], one, "0 minutes")
    rows = feed.spark.read.schema(SCHEMA).parquet(str(feed.folder / "in" / "batch=0"))
    batch = tumbling_counts(rows, "ts", "10 minutes", [], one)
    assert stream.schema == batch.schema
    closed = batch.filter(F.col("window_end") <= F.lit(T0 + timedelta(minutes=99)).cast("timestamp_ntz"))
    assert sorted(map(tuple, feed.run(stream).collect())) == sorted(map(tuple, closed.collect()))


def test_partitions_are_the_callers(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "777")
        assert streaming_session(spark).conf.get("spark.sql.shuffle.partitions") == "777"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_chain_of_repeats_equals_plain_spark(feed):
    """The row at 7 is dropped; it must not hold back the row at 16, which is beyond the bound of the row at 2."""
    def once():
        return stream_dedupe(feed.stream(), ["id"], "ts", "10 minutes")

    feed.add([(1, 2)])
    feed.add([(1, 7)])
    feed.add([(2, 24)])
    feed.run(once())  # at its end the row at 2 is beyond the bound and forgotten
    feed.add([(1, 16)])
    got = sorted((r.id, (r.ts - T0).total_seconds() // 60) for r in feed.run(once()).collect())
    assert got == [(1, 2), (1, 16), (2, 24)]
    assert once()._jdf.queryExecution().analyzed().toString().count("Deduplicate") == 1


def test_repeated_rows_over_batches_and_restarts(feed):
    def once():
        return stream_dedupe(feed.stream(), ["id"], "ts", "30 minutes")

    feed.add([(1, 0), (1, 1), (2, 2)] + [(7, m) for m in range(20)])
    feed.run(once())
    feed.add([(1, 5), (3, 6), (7, 7)])
    got = feed.run(once())
    assert sorted(row.id for row in got.collect()) == [1, 2, 3, 7]


def test_stream_sessions(feed):
    feed.add([(1, 0), (1, 9), (2, 0), (1, 30)])
    feed.add([(1, 35), (2, 50)])
    feed.add([(3, 200)])
    got = feed.run(
        stream_sessions(feed.stream(), ["id"], "ts", "10 minutes", F.lit(Decimal(1)), "60 minutes")
    ).collect()
    minutes = lambda t: int((t - T0).total_seconds() // 60)
    assert sorted((r.id, minutes(r.session_start), minutes(r.session_end), r.n_events) for r in got) == [
        (1, 0, 9, 2), (1, 30, 35, 2), (2, 0, 0, 1), (2, 50, 50, 1)
    ]


def test_account_of_a_batch(spark):
    """Without a watermark nothing is open or late; rows without a time are in no window, and a null read is no read."""
    rows = [(i, None if i % 5 == 0 else T0 + timedelta(minutes=i)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    windows = tumbling_counts(df, "ts", "10 minutes", [], F.lit(1))
    assert tuple(row_account(df, "ts", "10 minutes", windows).first()) == (40, 32, 8, 0, 0)
    none = df.limit(0)
    assert tuple(row_account(none, "ts", "10 minutes", tumbling_counts(none, "ts", "10 minutes", [], F.lit(1))).first()) == (0, 0, 0, 0, 0)


def test_account_of_a_stream(spark, tmp_path):
    """Kept, open, late and undated rows add up after every run, by the watermark that the run returns."""
    side, path = streaming_session(spark), str(tmp_path / "in")
    runs = [[(1, 0), (2, 5), (3, 61)], [(4, 62), (5, None), (6, 130)], [(7, 1), (8, 131), (9, 200)], [(10, 2), (11, 64), (12, 260)]]
    read, told = [], []
    for n, run in enumerate(runs):
        rows = [(i, None if m is None else T0 + timedelta(minutes=m)) for i, m in run]
        read += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/batch={n}")
        stream = read_parquet_stream(side, f"{path}/batch=*", SCHEMA, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))
        counts = tumbling_counts(stream, "ts", "10 minutes", [], F.lit(1), "5 minutes")
        mark = run_available(counts, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        windows = spark.read.schema(counts.schema).parquet(str(tmp_path / "out"))
        account = row_account(spark.createDataFrame(read, SCHEMA), "ts", "10 minutes", windows, mark).first()
        assert account.n_read == account.n_kept + account.n_undated + account.n_open + account.n_late == len(read)
        told.append((account.n_kept, account.n_undated, account.n_open, account.n_late))
    assert told[-1][1] == 1 and told[-1][3] == 3 and told[0][3] == 0


def test_spans_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A span with many rows comes in several files and batches; an empty span and events without a time change nothing."""
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 50)
    rows = [
        (i, None if i == 7 else T0 + timedelta(days=i % 40 if i % 40 < 8 else 1 + i % 40, minutes=i), i % 9, "view", float(i), None)
        for i in range(800)
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    before, partitions = set(session._scratch), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = streams.p21_dedupe_chains(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert Counter(map(tuple, got)) == Counter({(r[0], r[2], r[3], r[4]): 2 for r in rows if r[1] is not None})
    new = [path for path in set(session._scratch) - before if "/chains-" in path]
    spans = [path for path in new if list(Path(path).glob("span=*"))]
    files = [len(list(folder.glob("*.parquet"))) for folder in Path(spans[0]).glob("span=*")]
    assert max(files) > 3
    assert not any("/spans-" in path for path in session._scratch)
