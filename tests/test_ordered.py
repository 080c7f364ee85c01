"""Ordered windows: cut into chunks or not, the result is the same."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from packhorse import session
from packhorse.functions.skew import LEAST_SAMPLES, large_keys, least_samples, sample_share, split
from packhorse.operators.ordered import (
    LastKnown,
    Next,
    Position,
    Previous,
    RunningTotal,
    _chunk_tasks,
    cut,
    running,
    scan,
    top_k,
    top_ranks,
)

SCHEMA = "k string, part int, at int, id long, v decimal(18,4), note string"


def make_rows(seed: int, n: int, hot) -> list[tuple]:
    """Rows with equal times, null values, null keys and one key with half of them."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        key = hot if draw.random() < 0.5 else draw.choice(["a", "b", "c", None, "d"])
        value = None if draw.random() < 0.3 else Decimal(draw.randint(-500, 500)) / 4
        note = None if draw.random() < 0.6 else f"n{i}"
        rows.append((key, draw.choice([1, None]), draw.randint(0, n // 3), i, value, note))
    return rows


def expected(rows: list[tuple]) -> list[tuple]:
    """All measures by going through the rows of each key one by one."""
    groups: dict = {}
    for row in rows:
        groups.setdefault((row[0], row[1]), []).append(row)
    out = []
    for group in groups.values():
        group.sort(key=lambda r: (r[2], r[3]))
        total, known = None, None
        for i, row in enumerate(group):
            if row[4] is not None:
                total = row[4] + (total or 0)
            before = group[i - 1][5] if i else None
            after = group[i + 1][2] if i + 1 < len(group) else None
            out.append((*row, after, known, before, i + 1, total))
            known = row[5] if row[5] is not None else known
    return out


def measured(df, rows_per_task):
    return scan(
        df, ["k", "part"], ["at", "id"],
        {
            "after": Next(F.col("at")),
            "known": LastKnown(F.col("note")),
            "before": Previous(F.col("note")),
            "position": Position(),
            "total": RunningTotal(F.col("v")),
        },
        rows_per_task,
    )


@pytest.mark.parametrize(
    ("seed", "hot", "rows_per_task"), [(1, "hot", 40), (2, None, 25), (3, "hot", 100_000), (4, "x", None)]
)
def test_scan_equals_row_by_row(spark, seed, hot, rows_per_task):
    rows = make_rows(seed, 900, hot)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    result = measured(df, rows_per_task)
    names = [*df.columns, "after", "known", "before", "position", "total"]
    assert result.columns == names
    got = sorted(map(tuple, result.collect()), key=lambda r: r[3])
    assert got == sorted(expected(rows), key=lambda r: r[3])


def test_cut_and_whole_have_one_schema(spark):
    df = spark.createDataFrame(make_rows(5, 600, "hot"), SCHEMA)
    assert measured(df, 30).schema == measured(df, None).schema


def test_large_key_is_spread_over_tasks(spark):
    """A key with a third of all rows ends up in many chunks of similar size."""
    df = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    large = large_keys(df, ["k"], 1000)
    assert [row.k for row in large.keys.collect()] == [-1]
    assert 10 <= large.tasks <= 40

    result = scan(df, ["k"], ["at"], {"n": Position()}, 1000)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan
    largest = result.filter("k = -1").agg(F.max("n"), F.count("n")).first()
    assert tuple(largest) == (20_000, 20_000)


def test_the_threshold_does_not_move_with_the_table():
    """The share of rows that is looked at, and the samples that make a key large, follow from the limit alone."""
    for limit in (10, 1000, 2_000_000, 10**9):
        assert least_samples(limit) == max(LEAST_SAMPLES, int(limit * sample_share(limit)))
        assert abs(least_samples(limit) / sample_share(limit) - max(limit, LEAST_SAMPLES)) <= 1 / sample_share(limit)


def test_running_totals_refuse_floats(spark):
    df = spark.createDataFrame([("a", 1, 0.5)], "k string, at int, v double")
    with pytest.raises(TypeError, match="decimal"):
        running(df, ["k"], ["at"], F.col("v"))


def test_chunks_leave_no_copy_behind(spark):
    """Of the folders a cut writes, the copy that only the bounds were taken from is deleted."""
    df = spark.range(6000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    before = set(session._scratch)
    parts = cut(df, ["k"], ["at"], 1000)
    new = [path.rpartition("/")[2] for path in set(session._scratch) - before]
    assert parts.large is not None and any(name.startswith("chunks-") for name in new)
    assert all(name.startswith(("chunks-", "large-keys-")) for name in new)


@pytest.mark.parametrize("seed", [11, 12])
def test_many_chunks_are_written_in_few_tasks(spark, monkeypatch, seed):
    """Several chunks of a task are in order and of the size asked for, and change no result."""
    monkeypatch.setattr("packhorse.operators.ordered.CHUNK_TASKS", 3)
    rows = make_rows(seed, 3000, None)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    large = cut(df, ["k", "part"], ["at", "id"], 40).large
    assert len(large.inputFiles()) <= 3
    sizes = [row["count"] for row in large.groupBy("_chunk").count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 40
    got = sorted(map(tuple, measured(df, 40).collect()), key=lambda r: r[3])
    assert got == sorted(expected(rows), key=lambda r: r[3])
    plain = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    best = top_k(plain, ["k"], [F.desc("v")], 1500, rows_per_task=100)
    assert sorted((r.v, r.rank) for r in best.collect()) == [(v, (20_001 - v) // 2) for v in range(17_000, 20_000)]


def test_tasks_of_chunks_are_bounded():
    """At any number of small chunks; large chunks have a task each."""
    assert _chunk_tasks(150, 1000) == 150
    assert _chunk_tasks(9_000, 1000) == _chunk_tasks(54_000, 1000) == 200
    assert _chunk_tasks(1_000_000, 1000) == 500
    assert _chunk_tasks(5_000, 2_000_000) == 5_000


def test_no_large_key_is_the_plain_window(spark):
    df = spark.range(5000).select((F.col("id") / 4).cast("long").alias("k"), "id")
    assert large_keys(df, ["k"], 1000) is None
    plan = scan(df, ["k"], ["id"], {"n": Position()}, 1000)
    assert "_chunk" not in plan._jdf.queryExecution().executedPlan().toString()


def test_split_keeps_every_row(spark):
    rows = make_rows(6, 800, None)
    df = spark.createDataFrame(rows, SCHEMA)
    large = large_keys(df, ["k"], 100)
    rest, hot = split(df, large, ["k"])
    assert rest.filter("k IS NULL").count() == 0
    assert spark_rows(rest.unionByName(hot)) == spark_rows(df)


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(make_rows(7, 500, "hot"), SCHEMA)
    best = top_k(df, ["k"], [F.desc_nulls_last("v"), F.asc("id")], 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:] and "WindowGroupLimit" in plan[exchange:]
    assert best.groupBy("k").count().filter("count > 2").count() == 0
    hottest = best.filter("k = 'hot'").agg(F.max("v")).first()[0]
    assert hottest == df.filter("k = 'hot'").agg(F.max("v")).first()[0]


def test_a_large_k_is_dealt_to_many_tasks(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    best = top_k(df, ["k"], [F.desc("v")], 1500, rows_per_task=1000)
    assert "_chunk" in best._jdf.queryExecution().executedPlan().toString()
    assert best.columns == ["k", "v", "rank"]
    assert sorted(row.v for row in best.collect()) == list(range(17_000, 20_000))


@pytest.mark.parametrize("rows_per_task", [None, 100, 700])
def test_large_k_by_hand(spark, rows_per_task):
    """A large key, a null key and small ones; map columns, mixed directions, ties up to the last column."""
    draw = random.Random(8)
    rows = [(draw.choice(["h"] * 6 + [None, None, "a", "b"]), draw.choice([None, 1, 2, 3]), i, {"m": i}) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v int, id long, m map<string, int>").repartition(4)
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(name, "50")
    try:
        best = top_k(df, ["k"], [F.desc_nulls_last("v"), F.asc("id")], 1300, rows_per_task=rows_per_task)
        got = sorted(((r.k, r.v, r.id, r.m["m"], r.rank) for r in best.collect()), key=str)
    finally:
        spark.conf.unset(name)
    want = []
    for key in ("h", None, "a", "b"):
        of_key = sorted((r for r in rows if r[0] == key), key=lambda r: (-(r[1] or 0), r[2]))
        want += [(*r[:3], r[2], i + 1) for i, r in enumerate(of_key[:1300])]
    assert got == sorted(want, key=str)


def test_top_ranks_keeps_all_ties(spark):
    rows = [("a", 9), ("a", 9), ("a", 9), ("a", 7), ("a", 7), ("a", 5), ("a", None)]
    rows += [("b", 1), (None, 4), (None, 4), (None, 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = sorted((tuple(row) for row in top_ranks(df, ["k"], "v", 4).collect()), key=str)
    want = [("a", 9, 1)] * 3 + [("a", 7, 4)] * 2 + [("b", 1, 1)] + [(None, 4, 1)] * 2 + [(None, 2, 3)]
    assert got == sorted(want, key=str)
