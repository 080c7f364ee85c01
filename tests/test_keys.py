"""Deduplication, references, enrichment, diffs, sessions and history on small tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from packhorse.functions.digest import digest
from packhorse.operators.history import as_of, type2_history
from packhorse.operators.keys import (
    dedupe_latest,
    duplicated_keys,
    enrich,
    guarded_enrich,
    matched,
    orphans,
    snapshot_changes,
    snapshot_diff,
)
from packhorse.operators.marts import finest, pivot, subtotals, unpivot
from packhorse.operators.sessions import sessionise

T0 = datetime(2024, 1, 1)


def test_dedupe_latest(spark):
    rows = [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), (None, 1, "x"), (None, 2, "y")]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    kept = dedupe_latest(df, ["k"], [F.desc("v")])
    assert sorted(map(tuple, kept.collect()), key=str) == [("a", 3, "new"), (None, 2, "y")]
    assert kept.columns == df.columns
    counts = {row.k: row.n_rows for row in duplicated_keys(df, ["k"]).collect()}
    assert counts == {"a": 3, None: 2}


@pytest.mark.parametrize("rows_per_task", [None, 50, 2_000_000])
def test_orphans_and_matched(spark, rows_per_task):
    """Two large keys, one with parents (many times) and one without; and null keys."""
    children = [(1, i) for i in range(300)] + [(2, i) for i in range(300)]
    children += [(k, 0) for k in range(10, 60)] + [(None, i) for i in range(80)]
    parents = [(1,)] * 500 + [(k,) for k in range(30, 80)] + [(None,)]
    child = spark.createDataFrame(children, "k long, n int").repartition(4)
    parent = spark.createDataFrame(parents, "p long")
    with_parent = {1, *range(30, 60)}
    key = lambda row: (row[0] is None, row)
    got = matched(child, parent, {"k": "p"}, rows_per_task)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in children if r[0] in with_parent)
    got = orphans(child, parent, {"k": "p"}, rows_per_task)
    without = [r for r in children if r[0] not in with_parent]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(without, key=key)


def test_enrich_splits_a_large_key_at_run_time(spark):
    """With a dimension too large to broadcast, the partition of a large key is split."""
    old = {}
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in limits.items():
        old[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        facts = spark.range(0, 60_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("fk"), "id"
        )
        dims = spark.range(0, 60_000, 1, 4).select(
            F.col("id").alias("pk"), F.concat(F.lit("d"), F.col("id")).alias("label")
        )
        joined = enrich(facts, dims, {"fk": "pk"}, {"label": "dim_label"})
        assert joined.columns == ["fk", "id", "dim_label"]
        wrong = joined.filter(F.col("dim_label") != F.concat(F.lit("d"), F.col("fk")))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert (joined.count(), wrong.count()) == (60_000, 0)
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_enrich_keeps_facts_without_dimension(spark):
    facts = spark.createDataFrame([(1, "x"), (9, "y"), (None, "z")], "fk int, t string")
    dims = spark.createDataFrame([(1, "one")], "pk int, label string")
    got = {tuple(r) for r in enrich(facts, dims, {"fk": "pk"}, {"label": "label"}).collect()}
    assert got == {(1, "x", "one"), (9, "y", None), (None, "z", None)}


@pytest.mark.parametrize("rows_per_task", [None, 50])
def test_guarded_enrich(spark, rows_per_task):
    """Repeats of keys of many facts and of none, null keys on both sides, a key without a dimension row."""
    facts = [(1, i) for i in range(200)] + [(2, i) for i in range(200)] + [(3, 0), (None, 0), (9, 0)]
    dimension = [(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "n"), (None, "n"), (7, "x"), (7, "y"), (7, "z")]
    found = guarded_enrich(
        spark.createDataFrame(facts, "k long, i int").repartition(3), spark.createDataFrame(dimension, "d long, name string"),
        {"k": "d"}, {"name": "name"}, rows_per_task,
    )
    name = {1: "a", 3: "c"}
    key = lambda r: str(r)
    assert sorted(map(tuple, found.rows.collect()), key=key) == sorted([(k, i, name.get(k)) for k, i in facts if k != 2], key=key)
    assert sorted(map(tuple, found.ambiguous.collect())) == [(2, i) for i in range(200)]
    assert found.ambiguous.columns == ["k", "i"]


def test_snapshot_diff(spark):
    schema = "k long, a int, b string"
    old = [(1, 1, "x"), (2, None, "x"), (3, 3, None), (4, 4, "x"), (6, 1, "p"), (6, 2, "q"), (None, 0, "n")]
    new = [(1, 1, "x"), (2, None, "y"), (3, None, "z"), (5, 5, "x"), (6, 2, "q"), (None, 0, "n")]
    diff = snapshot_diff(
        spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["k"], ["a", "b"]
    )
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {row.k: (row.change, row.changed) for row in diff.collect()}
    assert got == {
        1: ("same", []), 2: ("update", ["b"]), 3: ("update", ["a", "b"]), 4: ("delete", []),
        5: ("insert", []), 6: ("duplicate", []), None: ("same", []),
    }


def test_snapshot_changes(spark):
    schema = "k long, a int, b string"
    old = [(1, 1, "x"), (2, None, "x"), (3, 3, None), (4, 4, "x"), (6, 1, "p"), (6, 2, "q"), (None, 0, "n"), (7, None, "y")]
    new = [(1, 1, "x"), (2, None, "y"), (3, None, "z"), (5, 5, "x"), (6, 2, "q"), (None, 0, "m"), (7, None, "y")]
    args = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["k"], ["a", "b"]
    got = {row.k: (row.change, row.changed, row.old, row.new) for row in snapshot_changes(*args).collect()}
    assert got == {
        2: ("update", ["b"], (None, "x"), (None, "y")), 3: ("update", ["a", "b"], (3, None), (None, "z")),
        4: ("delete", [], (4, "x"), None), 5: ("insert", [], None, (5, "x")), 6: ("duplicate", [], None, None),
        None: ("update", ["b"], (0, "n"), (0, "m")),
    }
    assert snapshot_changes(*args).schema == snapshot_diff(*args).schema
    assert snapshot_changes(args[0], args[0].filter("k <> 6 OR a = 1"), ["k"], ["a", "b"]).filter("k = 6").collect()[0].change == "duplicate"


def test_diffs_of_maps(spark):
    def snapshot(*rows):
        return spark.sql("SELECT * FROM VALUES " + ", ".join(rows) + " AS t(k, m, s)")

    old = snapshot("(1, map('a', 0.0D, 'b', 2.0D), struct(map(1, 'x')))", "(2, map('a', 1.0D), struct(map(1, 'x')))", "(3, NULL, NULL)")
    new = snapshot("(1, map('b', 2.0D, 'a', -0.0D), struct(map(1, 'x')))", "(2, map('a', 1.0D), struct(map(1, 'y')))",
                   "(3, map('a', 1.0D), struct(map(1, 'x')))", "(3, map('z', 0.0D), struct(map(1, 'x')))")
    for diff, want in (
        (snapshot_diff, {1: ("same", []), 2: ("update", ["s"]), 3: ("duplicate", [])}),
        (snapshot_changes, {2: ("update", ["s"]), 3: ("duplicate", [])}),
    ):
        assert {r.k: (r.change, r.changed) for r in diff(old, new, ["k"], ["m", "s"]).collect()} == want
    greatest = {r.k: r.new for r in snapshot_diff(old, new, ["k"], ["m", "s"]).collect()}[3]
    assert greatest.m == {"z": 0.0}


def test_digests_tell_values_apart(spark):
    """Values of one type, each different from all others, and pairs that are equal."""
    different = {
        "array<array<int>>": ["array(array(1), array(2))", "array(array(1, 2))", "array(array(1, 2), array())", "NULL", "array()",
                              "array(array(1), NULL, array(2))", "array(NULL, array(1), array(2))"],
        "struct<a: int, b: int>": ["struct(1 AS a, NULL AS b)", "struct(NULL AS a, 1 AS b)", "NULL", "struct(NULL AS a, NULL AS b)"],
        "map<string, array<int>>": ["map('a', array(1))", "map('a', NULL)", "map()", "map('b', array(1))", "map('a', array(1), 'b', NULL)"],
        "array<timestamp_ntz>": ["array(TIMESTAMP_NTZ'2024-01-01 00:00:00.000001')", "array(TIMESTAMP_NTZ'2024-01-01 00:00:00.000002')"],
        "array<string>": ["array('a', 'b')", "array('ab')", "array('a,b')", "array('a\"', 'b')", "array('')", "array(NULL)"],
        "double": ["0.0D", "double('NaN')", "1e-300D", "NULL"], "binary": ["X'00'", "X''", "X'0000'"],
    }
    for kind, values in different.items():
        df = spark.sql(" UNION ALL ".join(f"SELECT CAST({v} AS {kind}) AS v" for v in [*values, *values]))
        first, second = digest([(F.col("v"), df.schema["v"].dataType)])
        got = df.select(first.alias("a"), second.alias("b"))
        assert got.distinct().count() == len(values) == got.select("a").distinct().count() == got.select("b").distinct().count()
    equal = [("map(1, 'a', 2, 'b')", "map(2, 'b', 1, 'a')"), ("array(0.0D)", "array(-0.0D)"), ("float(-0.0)", "float(0.0)"),
             ("struct(map(map_entries(map('k', 1))[0].key, 1, 'l', 2) AS m)", "struct(map('l', 2, 'k', 1) AS m)"),
             ("array(map('a', map('b', 1, 'c', 2)))", "array(map('a', map('c', 2, 'b', 1)))")]
    for one, two in equal:
        df = spark.sql(f"SELECT {one} AS v UNION ALL SELECT {two}")
        first, second = digest([(F.col("v"), df.schema["v"].dataType)])
        assert df.select(first, second).distinct().count() == 1


def test_dedupe_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("a", 1, 7, 8), ("a", 2, 7, 8)], "k string, v int, _rank int, rank int")
    assert [tuple(r) for r in dedupe_latest(df, ["k"], [F.desc("v")]).collect()] == [("a", 2, 7, 8)]


def sessions_by_hand(rows, gap):
    out, last = [], {}
    for user, at, value in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        session = last.get(user)
        if session is None or at > session[2] + gap:
            session = last[user] = [user, at, at, 0, Decimal(0)]
            out.append(session)
        session[2] = at
        session[3] += 1
        session[4] += value
    return sorted((tuple(s) for s in out), key=str)


@pytest.mark.parametrize(("seed", "rows_per_task"), [(1, None), (2, 60)])
def test_sessions(spark, seed, rows_per_task):
    """Gaps of exactly the limit, equal times, one busy user and a null user."""
    draw = random.Random(seed)
    rows = []
    for user, n in (("busy", 400), ("a", 30), (None, 40), ("b", 1)):
        at = T0
        for _ in range(n):
            at += timedelta(seconds=draw.choice([0, 1, 599, 600, 601, 1800]))
            rows.append((user, at, Decimal(draw.randint(1, 9))))
    df = spark.createDataFrame(rows, "u string, ts timestamp_ntz, v decimal(18,4)").repartition(3)
    got = sessionise(df, ["u"], "ts", 600, F.col("v"), rows_per_task)
    got = sorted((tuple(row) for row in got.collect()), key=str)
    want = sessions_by_hand(rows, timedelta(seconds=600))
    assert [(r[0], r[1], r[2], r[3], float(r[4])) for r in got] == [
        (r[0], r[1], r[2], r[3], float(r[4])) for r in want
    ]


def test_type2_history(spark):
    rows = [("a", T0, 1, "x"), ("a", T0, 2, "x"), ("a", T0 + timedelta(1), 3, None),
            ("a", T0 + timedelta(2), 4, None), ("a", T0 + timedelta(3), 5, "x"), ("b", T0, 6, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v string")
    every = type2_history(df, ["k"], "ts", "id")
    assert every.count() == 6 and every.filter("is_current").count() == 2
    changes = type2_history(df, ["k"], "ts", "id", track=["v"]).orderBy("id").collect()
    assert [(r.id, r.valid_to, r.is_current) for r in changes] == [
        (1, T0 + timedelta(1), False), (3, T0 + timedelta(3), False), (5, None, True), (6, None, True)
    ]


@pytest.mark.parametrize("rows_per_task", [None, 30])
def test_as_of(spark, rows_per_task):
    """Strictly earlier rows only; of equal times the one with the greater tie-break; nulls match nothing."""
    draw = random.Random(3)

    def time():
        return None if draw.random() < 0.1 else draw.randint(0, 50)

    left = [(draw.choice(["h", "h", "h", "a", None]), time(), i) for i in range(200)]
    right = [(draw.choice(["h", "h", "b", "a", None]), time(), i) for i in range(150)]
    schema = "k string, at int, id long"
    got = as_of(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema),
        ["k"], ["at", "id"], ["at", "id"], "hit", rows_per_task,
    )
    want = []
    for k, at, i in left:
        earlier = [
            r for r in right if None not in (k, at, r[1]) and r[0] == k and r[1] < at
        ]
        want.append((k, at, i, max(earlier, key=lambda r: (r[1], r[2])) if earlier else None))
    rows = [(r.k, r.at, r.id, None if r.hit is None else tuple(r.hit)) for r in got.collect()]
    assert sorted(rows, key=lambda r: r[2]) == sorted(want, key=lambda r: r[2])


def test_subtotals_repeat_groups_not_rows(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "p", 4), ("x", "p", 8)], "a string, b string, v int")
    measures = {"n": ("count", F.lit(1)), "total": ("sum", F.col("v")), "top": ("max", F.col("v"))}
    kinds = {name: kind for name, (kind, _) in measures.items()}
    cube = subtotals(finest(df, ["a", "b"], measures), ["a", "b"], kinds, "cube")
    got = {(r.a, r.b, r.level): (r.n, r.total, r.top) for r in cube.collect()}
    want = {(r.a, r.b, r.level): (r.n, r.total, r.top) for r in df.cube("a", "b").agg(
        F.grouping_id().alias("level"), F.count("*").alias("n"), F.sum("v").alias("total"),
        F.max("v").alias("top")).collect()}
    assert got == want
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Exchange")


def test_pivot_and_back(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "other")], "k int, t string")
    wide = pivot(df, ["k"], "t", ["x", "y"], F.count(F.lit(1)), 0)
    assert sorted(map(tuple, wide.collect())) == [(1, 2, 0), (2, 0, 1)]
    rest = pivot(df.union(spark.createDataFrame([(3, None)], df.schema)), ["k"], "t", ["x"], F.count(F.lit(1)), 0, "rest")
    assert sorted(map(tuple, rest.collect())) == [(1, 2, 0), (2, 0, 2), (3, 0, 1)]
    long = unpivot(wide, ["k"], ["x", "y"], "t", "n")
    assert sorted(map(tuple, long.collect())) == [(1, "x", 2), (1, "y", 0), (2, "x", 0), (2, "y", 1)]
