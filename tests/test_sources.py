"""Contracts, quarantine, marks, upserts and partitioned loads."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhorse.operators.quality import (
    Field,
    estimated_profile,
    flatten_json,
    profile,
    rejected_rows,
    rule_summary,
    standardise,
    valid_rows,
)
from packhorse.session import build_session, delete_by_uri, release_scratch, scratch_path, stored
from packhorse.sources import switched
from packhorse.sources.contracts import (
    CONTRACTS,
    ContractError,
    check_contract,
    enforce_contract,
    read_table,
)
from packhorse.sources.incremental import extract_after, highest_mark, load_mark, save_mark
from packhorse.sources.loads import load_partitions, of_partitions, upsert, upsert_partitions
from packhorse.sources.switched import drop_unused, load_switched, read_switched, upsert_switched
from packhorse.sources.text import accepted, quarantine, read_csv_lines, read_csv_records, read_json_lines

T0 = datetime(2024, 1, 1)
SMALL = "/root/testdata/sf0.001"


# P1


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_given_tables_keep_their_contract(spark, name):
    assert read_table(spark, SMALL, name).columns == CONTRACTS[name].fieldNames()


def test_contract_breaks_are_named(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, `odd 'name` string")
    contract = T.StructType.fromDDL("a bigint, c string, `odd 'name` string not null")
    with pytest.raises(ContractError, match="t: a mistyped, c missing"):
        enforce_contract(df, contract, "t")
    report = check_contract(df, contract, "t").collect()
    assert {row.column_name: (row.status, row.n_rows, row.n_nulls) for row in report} == {
        "a": ("mistyped", 1, 0), "c": ("missing", 1, 0), "b": ("extra", 1, 0),
        "odd 'name": ("nulls", 1, 1),
    }
    kept = enforce_contract(df, T.StructType.fromDDL("b string, a int"))
    assert kept.columns == ["b", "a"]


# P2

_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("name", T.StringType()),
    ]
)


def written(spark, lines: list[str]) -> str:
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return path


def test_csv_quarantine(spark):
    good = ["1,2.5,ann", '2,3.5,"a, b"', "3,,", "-4,1e3,x"]
    bad = ["x,1.0,ann", "5,n/a,ann", "6,1.0", "7,1.0,a,b"]
    path = written(spark, ["id,price,name", *good, *bad])
    parsed = read_csv_lines(spark, path, _SCHEMA, header="id,price,name")
    assert spark_rows(accepted(parsed))[1] == spark_rows(
        spark.createDataFrame(
            [(1, 2.5, "ann"), (2, 3.5, "a, b"), (3, None, None), (-4, 1000.0, "x")], _SCHEMA
        )
    )[1]
    rejected = quarantine(parsed).collect()
    assert sorted(row.raw for row in rejected) == sorted(bad)
    assert all(path in row.file for row in rejected)
    # Malformed does not depend on the columns that are used.
    assert accepted(parsed).select("id").count() == len(good)
    assert quarantine(parsed).select("file").count() == len(bad)


def test_json_quarantine(spark):
    good = ['{"id":1,"price":2.5,"name":"ann"}', '{"id":2}', '{"name":"é","id":3,"other":[1]}']
    bad = ['{"id":4', "not json", '{"id":"x"}', '{"id":5,"price":"n/a"}']
    parsed = read_json_lines(spark, written(spark, good + bad), _SCHEMA)
    assert sorted((row.id, row.price, row.name) for row in accepted(parsed).collect()) == [
        (1, 2.5, "ann"), (2, None, None), (3, None, "é")
    ]
    assert sorted(row.raw for row in quarantine(parsed).collect()) == sorted(bad)


def test_blank_lines_and_required_fields(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("n", T.StringType(), False), T.StructField("x", T.IntegerType())])
    good, bad = ["1,a,", "2,b,5"], ["", "   ", "3,,7", ",c,7", "2,"]
    parsed = read_csv_lines(spark, written(spark, good + bad), schema)
    assert sorted(row.id for row in accepted(parsed).collect()) == [1, 2]
    assert sorted(row.raw for row in quarantine(parsed).collect()) == sorted(bad)
    good, bad = ['{"id":1,"n":"a"}', '{"id":2,"n":"","x":3}'], ["", " ", "{}", '{"x":2}', '{"id":null,"n":"a"}']
    parsed = read_json_lines(spark, written(spark, good + bad), schema)
    assert sorted(row.id for row in accepted(parsed).collect()) == [1, 2]
    assert sorted(row.raw for row in quarantine(parsed).collect()) == sorted(bad)


def test_records_end_with_their_line(spark):
    """Each with what the parser alone would make of it: a value, and no complaint."""
    good = ['1,2,"a, b"', '2,2,"a \\" b"', '3,2,f"g', '4,2, "f"', '5,2,"f" ', "6,2,C:\\"]
    bad = ['7,2,"f', '8,2,"f\\"', '9,"2,f', '10,2,"f",', "11,2", '12,2,"f\\']
    parsed = read_csv_lines(spark, written(spark, good + bad), _SCHEMA)
    assert {r.id: r.name for r in accepted(parsed).collect()} == {1: "a, b", 2: 'a " b', 3: 'f"g', 4: ' "f"', 5: "f", 6: "C:\\"}
    assert sorted(r.raw for r in quarantine(parsed).collect()) == sorted(bad)
    parsed = read_csv_lines(spark, written(spark, ["1;2;'a;b'", "2;2;'a"]), _SCHEMA, options={"SEP": ";", "quote": "'"})
    assert [(r.id, r.name) for r in accepted(parsed).collect()] == [(1, "a;b")]
    good = ['{"id":1}', ' {"id":2} ', '{"id":3,"name":{"a":[1]}}']
    bad = ['{"id":4} x', '{"id":5}}', '{"id":6}{"id":7}', '{"id":8},{"id":9}', "null", "[]", '[{"id":1}]', '"x"', "5", '{"id":1},"end":1}']
    parsed = read_json_lines(spark, written(spark, good + bad), _SCHEMA)
    assert sorted((r.id, r.name) for r in accepted(parsed).collect()) == [(1, None), (2, None), (3, '{"a":[1]}')]
    assert sorted(r.raw for r in quarantine(parsed).collect()) == sorted(bad)
    with pytest.raises(ValueError, match="added under these names: File"):
        read_csv_lines(spark, "x", T.StructType.fromDDL("File string"))


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, "150")
    yield
    spark.conf.unset(name)


def test_records_over_lines_and_splits(spark, small_splits, tmp_path):
    pick = random.Random(2)
    parts = ["a", "b, c", "\n", "\r\n", '"', "long " * 9, "\n\n", ""]
    rows = [(k, "".join(pick.choices(parts, k=pick.randrange(6))), pick.choice(["", "x", "\ny"])) for k in range(300)]
    for end in ("\n", "\r\n"):
        quoted = ['{},"{}","{}"'.format(k, *[v.replace('"', '""') for v in rest]) for k, *rest in rows]
        folder = tmp_path / f"end{len(end)}"
        folder.mkdir()
        (folder / "one.csv").write_text(end.join(["id,a,b", *quoted[:200]]) + end, newline="")
        (folder / "two.csv").write_text(end.join(quoted[200:]), newline="")
        schema = T.StructType.fromDDL("id long, a string, b string")
        options = {"escape": '"', "emptyValue": ""}
        parsed = read_csv_records(spark, str(folder), schema, "id,a,b", options)
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
        assert sorted((r.id, r.a or "", r.b or "") for r in accepted(parsed).collect()) == rows
        assert quarantine(parsed).collect() == []


def test_a_quote_that_is_never_closed(spark, small_splits, tmp_path):
    lines = ['1,"a"', '2,"b', *[f"{k},x" for k in range(3, 40)]]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    parsed = read_csv_records(spark, str(tmp_path), T.StructType.fromDDL("id long, a string"), most_lines=5)
    assert [r.id for r in accepted(parsed).collect()] == [1]
    rejected = [r.raw for r in quarantine(parsed).collect()]
    assert sorted(rejected) == sorted(["\n".join(lines[1:6]), *lines[6:]])


# P3, P4, P5, P22


def test_rules_with_nulls(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (9, -1), (2, None)], "a int, b int")
    rules = {"a_small": F.col("a") < 5, "b_positive": F.col("b") > 0}
    assert [tuple(row) for row in valid_rows(df, rules).collect()] == [(1, 5)]
    rejected = {(row.a, row.b): row.failed_rules for row in rejected_rows(df, rules).collect()}
    assert rejected == {
        (None, 5): ["a_small"], (9, -1): ["a_small", "b_positive"], (2, None): ["b_positive"]
    }
    summary = {row.rule: (row.n_rows, row.n_failed) for row in rule_summary(df, rules).collect()}
    assert summary == {"a_small": (4, 2), "b_positive": (4, 2)}


def test_standardise(spark):
    df = spark.createDataFrame(
        [(" Ann  lee ", " 12 ", 3), ("   ", "x", None), (None, None, 4)], "n string, q string, v int"
    )
    fields = [
        Field("n", "name", case="title", default="nobody"),
        Field("q", "quantity", "int", default=-1),
        Field("v", "value", "bigint"),
    ]
    tidy = standardise(df, fields)
    assert [tuple(row) for row in tidy.collect()] == [
        ("Ann  Lee", 12, 3), ("nobody", -1, None), ("nobody", -1, 4)
    ]
    assert [t for _, t in tidy.dtypes] == ["string", "int", "bigint"]


def test_flatten_json(spark):
    df = spark.createDataFrame(
        [(1, '{"k": 3, "s": "x"}'), (2, '{"k": "bad"}'), (3, "oops"), (4, None)], "id int, props string"
    )
    flat = flatten_json(df, "props", T.StructType.fromDDL("k int, s string"), "p_")
    assert sorted(map(tuple, flat.collect())) == [
        (1, 3, "x"), (2, None, None), (3, None, None), (4, None, None)
    ]
    told = flatten_json(df, "props", T.StructType.fromDDL("k int, s string"), bad="broken")
    assert {row.id: row.broken for row in told.collect()} == {1: None, 2: '{"k": "bad"}', 3: "oops", 4: None}
    odd = spark.createDataFrame([('{"k": 3} x', 1, 2, 3, 4), ("null", 1, 2, 3, 4)], "props string, _json int, row int, is_whole int, `a.b` int")
    told = flatten_json(odd, "props", T.StructType.fromDDL("k int"), bad="broken")
    assert sorted(map(tuple, told.collect()), key=str) == [(1, 2, 3, 4, None, "null"), (1, 2, 3, 4, None, '{"k": 3} x')]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "b", [1.0]), (None, "a", [1.0]), (1, None, [2.0])], "`a b` int, s string, v array<float>"
    )
    want = {
        "a b": (3, 1, "1", "1", 1), "s": (3, 1, "a", "b", 2), "v": (3, 0, "", "", 2)
    }
    for table in (profile(df), estimated_profile(df)):
        assert {r.column_name: (r.n_rows, r.n_nulls, r.least, r.greatest, r.n_distinct)
                for r in table.collect()} == want
    nothing = {r.column_name: tuple(r)[1:] for r in profile(df.limit(0)).collect()}
    assert nothing == dict.fromkeys(want, (0, 0, "", "", 0))


def test_profile_of_maps_and_structs(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
            (map('a', 1, 'b', 2), struct(map('k', 1) AS m), 'x'), (map('b', 2, 'a', 1), struct(map('k', 2) AS m), 'x'),
            (map('a', 1), struct(map('k', 1) AS m), NULL), (NULL, NULL, 'y') AS t(m, s, v)
    """)
    got = {r.column_name: (r.n_rows, r.n_nulls, r.least, r.greatest, r.n_distinct) for r in profile(df).collect()}
    assert got == {"m": (4, 1, "", "", 2), "s": (4, 1, "", "", 2), "v": (4, 1, "x", "y", 2)}
    df = spark.sql("SELECT array(map('a', map(1, 2, 3, 4))) AS v, -0.0F AS z UNION ALL SELECT array(map('a', map(3, 4, 1, 2))), 0.0F")
    assert {r.column_name: r.n_distinct for r in profile(df).collect()} == {"v": 1, "z": 1}


def test_profile_shuffles_no_text(spark):
    plan = profile(read_table(spark, SMALL, "pages"))._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert keys and not any("html" in line for line in keys)


def test_estimated_distinct_is_close(spark):
    df = read_table(spark, SMALL, "lineitem")
    exact = {row.column_name: row.n_distinct for row in profile(df).collect()}
    for row in estimated_profile(df).collect():
        assert abs(row.n_distinct - exact[row.column_name]) <= max(2, exact[row.column_name] * 0.2)


# P16


def test_extracts_take_every_row_once(spark):
    """Also rows that share the time of the mark, and rows that arrive in between."""
    def rows(ids):
        return spark.createDataFrame(
            [(i, T0 + timedelta(hours=i // 3, microseconds=i // 3)) for i in ids],
            "id long, ts timestamp_ntz",
        )

    path = scratch_path(spark, "marks")
    assert load_mark(spark, path) is None
    first, _, mark, _ = extract_after(rows(range(10)), "ts", "id", load_mark(spark, path))
    save_mark(spark, path, mark)
    second, _, mark, _ = extract_after(rows(range(20)), "ts", "id", load_mark(spark, path))
    save_mark(spark, path, mark)
    third, _, unchanged, _ = extract_after(rows(range(20)), "ts", "id", load_mark(spark, path))
    taken = [sorted(row.id for row in df.collect()) for df in (first, second, third)]
    assert taken == [list(range(10)), list(range(10, 20)), []]
    assert unchanged == mark == highest_mark(rows(range(20)), "ts", "id")


def test_late_and_undated_rows(spark):
    def rows(*pairs):
        times = [(i, None if h is None else T0 + timedelta(hours=h)) for i, h in pairs]
        return spark.createDataFrame(times, "id long, ts timestamp_ntz")

    def ids(df):
        return sorted(row.id for row in df.collect())

    none = rows().limit(0)
    first = extract_after(rows((1, 1), (2, 10), (3, None)), "ts", "id", None, "5 HOURS", none)
    assert (ids(first.rows), ids(first.undated)) == ([1, 2], [3])
    there = rows((1, 1), (2, 10), (3, None), (4, 6), (5, 3), (6, 11), (7, None), (8, 10), (0, 10))
    loaded = rows((1, 1), (2, 10), (3, None))
    second = extract_after(there, "ts", "id", first.mark, "5 HOURS", loaded)
    assert (ids(second.rows), ids(second.undated)) == ([0, 4, 6, 8], [7])
    plain = extract_after(there, "ts", "id", first.mark)
    assert (ids(plain.rows), ids(plain.undated)) == ([6, 8], [3, 7])
    with pytest.raises(ValueError, match="lookback"):
        extract_after(there, "ts", "id", first.mark, "5 HOURS")


@pytest.mark.parametrize(("kind", "ids"), [
    ("string", ["b", "a10", "a9", "é"]), ("binary", [b"\x00", b"\xff", b"a", b""]), ("double", [-1.5, 0.1, 1e300, 7.0]),
    ("date", [date(2024, 1, k) for k in (3, 1, 2, 4)]), ("boolean", [True, False]), ("long", [2**53 + 1, 2**53, -5, 0]),
])
def test_ids_of_any_type_and_none(spark, kind, ids):
    """A run for each row of one time, in the order of ids: every row is taken once, those without an id apart."""
    schema = f"id {kind}, ts timestamp_ntz, n int"
    later = [(i, T0 + timedelta(hours=1), 1) for i in ids]
    there, taken, mark = [(None, T0, 0), (None, None, 3)], [], None
    path = scratch_path(spark, "marks")
    for row in [*sorted(later), (None, T0 + timedelta(hours=2), 2)]:
        there.append(row)
        found = extract_after(spark.createDataFrame(there, schema), "ts", "id", load_mark(spark, path))
        taken += [tuple(r) for part in (found.rows, found.unnamed) for r in part.collect()]
        assert [r.n for r in found.undated.collect()] == [3]
        save_mark(spark, path, found.mark)
        mark = found.mark
    assert sorted(taken, key=str) == sorted([r for r in there if r[1]], key=str)
    assert mark.row_id is None and load_mark(spark, path) == mark
    # A row with an id at the time of a mark without one comes after it.
    there.append((ids[0], T0 + timedelta(hours=2), 4))
    found = extract_after(spark.createDataFrame(there, schema), "ts", "id", mark)
    assert [r.n for r in found.rows.collect()] == [4] and found.unnamed.collect() == []


def test_ids_without_an_order(spark):
    df = spark.sql("SELECT map(1, 2) AS id, TIMESTAMP_NTZ'2024-01-01' AS ts")
    with pytest.raises(TypeError, match="no place in an order"):
        extract_after(df, "ts", "id", None)


def test_mark_reaches_the_scan(spark):
    events = read_table(spark, SMALL, "events")
    mark = highest_mark(events.filter(F.col("event_id") < 500), "ts", "event_id")
    fresh = extract_after(events, "ts", "event_id", mark).rows
    plan = fresh.select("event_id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts,2024" in pushed and "LessThanOrEqual(ts,2024" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


# P17, P18


def test_upsert(spark):
    schema = "k long, v string"
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], schema)
    changes = spark.createDataFrame(
        [(2, "old", 1), (2, "new", 2), (3, "c", 1), (None, "m", 1)], "k long, v string, version int"
    )
    merged = upsert(target, changes, ["k"], [F.desc("version")])
    assert sorted(map(tuple, merged.collect()), key=str) == [
        (1, "a"), (2, "new"), (3, "c"), (None, "m")
    ]


@pytest.mark.parametrize("rows_per_task", [None, 50])
def test_upsert_into_large_keys(spark, rows_per_task):
    """Rows of a repeated key are all replaced, or all kept; null is such a key."""
    schema = "k long, v string"
    rows = [(None, "n")] * 200 + [(7, "s")] * 200 + [(8, "t")] * 200 + [(k, "x") for k in range(40, 80)]
    changes = [(None, "new", 1), (8, "new", 2), (8, "old", 1), (60, "new", 1), (99, "new", 1)]
    merged = upsert(
        spark.createDataFrame(rows, schema).repartition(4),
        spark.createDataFrame(changes, "k long, v string, version int"),
        ["k"], [F.desc("version")], rows_per_task,
    )
    want = [(7, "s")] * 200 + [(k, "x") for k in range(40, 80) if k != 60]
    want += [(None, "new"), (8, "new"), (60, "new"), (99, "new")]
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(want, key=str)


def test_load_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    load_partitions(
        spark.createDataFrame([(1, "x", 1), (2, "x", 2), (3, "y", 3)], "k long, p string, v int"),
        path, ["p"],
    )
    untouched = sorted(f.name for f in (tmp_path / "table" / "p=y").glob("*.parquet"))
    changes = spark.createDataFrame([(2, "x", 9, 1), (4, "x", 4, 1)], "k long, p string, v int, n int")
    upsert_partitions(spark, path, changes, ["k"], ["p"], [F.desc("n")])
    rows = sorted((r.k, r.p, r.v) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "x", 1), (2, "x", 9), (3, "y", 3), (4, "x", 4)]
    assert sorted(f.name for f in (tmp_path / "table" / "p=y").glob("*.parquet")) == untouched
    upsert_partitions(spark, path, changes.filter("k > 99"), ["k"], ["p"], [F.desc("n")])
    assert spark.read.parquet(path).count() == 4


def test_moved_keys_leave_no_old_row(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "k long, p string, q int, v int"
    rows = [(1, "a", 1, 0), (2, "a", 1, 0), (3, "b", 1, 0), (4, None, 1, 0), (None, "c", 2, 0), (6, "d", 2, 0)]
    load_partitions(spark.createDataFrame(rows, schema), path, ["p", "q"])
    untouched = sorted(f.name for f in (tmp_path / "table" / "p=d" / "q=2").glob("*.parquet"))
    changes = [(1, "b", 1, 9, 1), (3, None, 1, 9, 1), (4, "a", 1, 9, 1), (None, "e", 2, 9, 1)]
    changes = spark.createDataFrame(changes, schema + ", n int")
    upsert_partitions(spark, path, changes, ["k"], ["p", "q"], [F.desc("n")])
    got = sorted(((r.k, r.p, r.q, r.v) for r in spark.read.parquet(path).collect()), key=str)
    want = [(1, "b", 1, 9), (2, "a", 1, 0), (3, None, 1, 9), (4, "a", 1, 9), (None, "e", 2, 9), (6, "d", 2, 0)]
    assert got == sorted(want, key=str)
    assert not (tmp_path / "table" / "p=c" / "q=2").exists()
    assert sorted(f.name for f in (tmp_path / "table" / "p=d" / "q=2").glob("*.parquet")) == untouched


# Names that Spark, a file system or a URI writes in another way.
ODD_NAMES = ["a b", "a:b", "a%20b", "a/b", "ü", "x=y", "%", "#", "007", "null", "", None]


def test_keys_move_out_of_partitions_with_odd_names(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k long, p string, v int"
    rows = [(k, name, 0) for k, name in enumerate(ODD_NAMES)]
    load_partitions(spark.createDataFrame(rows, schema), path, ["p"])
    changes = [(k, "other", 1, 1) for k in range(len(rows))] + [(99, "", 1, 1)]
    upsert_partitions(spark, path, spark.createDataFrame(changes, schema + ", n int"), ["k"], ["p"], [F.desc("n")])
    got = sorted((r.k, r.p, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(k, "other", 1) for k in range(len(rows))] + [(99, None, 1)]
    assert sorted(f.name for f in tmp_path.glob("table/p=*")) == ["p=__HIVE_DEFAULT_PARTITION__", "p=other"]


def test_partitions_named_like_numbers(spark, tmp_path):
    """Text codes with zeros in front, dates and numbers stay what they are."""
    path, schema = str(tmp_path / "table"), "k long, code string, day date, n int, v int"
    rows = [(1, "007", date(2024, 1, 2), 7, 0), (2, "010", date(2024, 1, 2), 7, 0), (3, "1e3", date(2024, 1, 3), 8, 0)]
    load_partitions(spark.createDataFrame(rows, schema), path, ["code", "day", "n"])
    changes = [(1, "010", date(2024, 1, 2), 7, 1, 1), (3, "1e3", date(2024, 1, 3), 8, 1, 1), (4, "007", date(2024, 1, 2), 7, 1, 1)]
    changes = spark.createDataFrame(changes, schema + ", version int")
    upsert_partitions(spark, path, changes, ["k"], ["code", "day", "n"], [F.desc("version")])
    got = spark.read.schema(T.StructType.fromDDL(schema)).parquet(path).select("k", "code", "day", "n", "v").collect()
    assert sorted(map(tuple, got)) == [
        (1, "010", date(2024, 1, 2), 7, 1), (2, "010", date(2024, 1, 2), 7, 0), (3, "1e3", date(2024, 1, 3), 8, 1),
        (4, "007", date(2024, 1, 2), 7, 1),
    ]


def test_deleting_what_is_not_there_is_noticed(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing to delete"):
        delete_by_uri(spark, f"file:{tmp_path}/p=a%20b")


# P18 with a switch


def switched_rows(spark, path):
    return sorted((tuple(r) for r in read_switched(spark, path).collect()), key=str)


def test_switched_upserts_give_what_in_place_ones_do(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k long, p string, q int, v int"
    rows = [(k, name, k % 2, 0) for k, name in enumerate(ODD_NAMES)]
    stored = [(k, p or None, q, v) for k, p, q, v in rows]
    load_switched(spark, path, spark.createDataFrame(rows, schema), ["p", "q"])
    assert switched_rows(spark, path) == sorted(stored, key=str)
    moved = [(k, "other", 7, 1, 1) for k in range(0, len(rows), 2)] + [(50, "", 1, 5, 1), (50, "", 1, 4, 0)]
    upsert_switched(spark, path, spark.createDataFrame(moved, schema + ", n int"), ["k"], [F.desc("n")])
    want = [(k, "other", 7, 1) if k % 2 == 0 else row for row in stored for k in row[:1]] + [(50, None, 1, 5)]
    assert switched_rows(spark, path) == sorted(want, key=str)
    assert read_switched(spark, path).schema == T.StructType.fromDDL(schema)
    upsert_switched(spark, path, spark.createDataFrame([], schema + ", n int"), ["k"], [F.desc("n")])
    assert switched_rows(spark, path) == sorted(want, key=str)


def test_a_killed_load_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "table"), "k long, p string"
    with pytest.raises(FileNotFoundError):
        read_switched(spark, path)
    load_switched(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], schema), ["p"])
    with monkeypatch.context() as patch:
        # Killed when all files and the manifest are there, but not the pointer.
        patch.setattr(switched, "_move_pointer", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            load_switched(spark, path, spark.createDataFrame([(3, "a"), (4, "c")], schema), ["p"])
    assert switched_rows(spark, path) == [(1, "a"), (2, "b")]
    load_switched(spark, path, spark.createDataFrame([(5, "b")], schema), ["p"])
    assert switched_rows(spark, path) == [(1, "a"), (5, "b")]
    # A reader that has begun goes on with the files of its load.
    before = read_switched(spark, path)
    load_switched(spark, path, spark.createDataFrame([(6, "b")], schema), ["p"])
    assert sorted(map(tuple, before.collect())) == [(1, "a"), (5, "b")]
    assert drop_unused(spark, path, "2000-01-01") == 0
    assert drop_unused(spark, path, "2100-01-01") == 4
    assert switched_rows(spark, path) == [(1, "a"), (6, "b")]
    assert len(list(tmp_path.glob("table/data/*/*"))) == 2


def test_two_loads_at_once(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k long, p string"
    load_switched(spark, path, spark.createDataFrame([(1, "a")], schema), ["p"])
    before = switched.latest_pointer(spark, path)
    load_switched(spark, path, spark.createDataFrame([(2, "a")], schema), ["p"])
    with pytest.raises(switched.LoadConflict):
        switched._load(spark, path, spark.createDataFrame([(3, "a")], schema), ["p"], None, before)
    assert switched_rows(spark, path) == [(2, "a")]
    assert sorted(f.name for f in tmp_path.glob("table/pointers/[!.]*")) == ["0000000001", "0000000002"]
    with pytest.raises(ValueError, match="not those of"):
        load_switched(spark, path, spark.createDataFrame([("x", "a")], "k string, p string"), ["p"])
    with pytest.raises(ValueError, match="load_id"):
        load_switched(spark, path, spark.createDataFrame([("x", "a")], "load_id string, p string"), ["p"])


def test_an_emptied_switched_table(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "k long, p string"
    rows = spark.createDataFrame([(1, "a"), (2, None)], schema)
    load_switched(spark, path, rows, ["p"])
    load_switched(spark, path, rows.limit(0), ["p"], emptied=rows.select("p"))
    assert switched_rows(spark, path) == []
    load_switched(spark, path, rows.filter("k = 2"), ["p"])
    assert switched_rows(spark, path) == [(2, None)]


def test_switched_reads_open_live_folders_only(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(20).select(F.col("id").alias("k"), (F.col("id") % 5).alias("p"))
    load_switched(spark, path, rows, ["p"])
    load_switched(spark, path, rows.filter("p = 1").withColumn("k", F.col("k") + 100), ["p"])
    plan = read_switched(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert sorted(r.k for r in read_switched(spark, path).filter("p = 1").collect()) == [101, 106, 111, 116]


def test_thousands_of_touched_partitions(spark, tmp_path):
    """The read is pruned by a join, whose plan does not grow with them."""
    path = str(tmp_path / "table")
    rows = spark.range(5100).select(F.col("id").alias("k"), F.col("id").alias("p"), F.lit(0).alias("v"))
    load_partitions(rows.coalesce(1), path, ["p"])
    changes = rows.filter("k < 5000").withColumns({"v": F.lit(1), "n": F.lit(1)})
    upsert_partitions(spark, path, changes, ["k"], ["p"], [F.desc("n")], keys_stay=True)
    got = spark.read.parquet(path).agg(F.count("k"), F.sum("v"), F.count_if(F.col("k") == F.col("p"))).first()
    assert tuple(got) == (5100, 5000, 5100)


def test_touched_partitions_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(20).select(F.col("id").alias("k"), (F.col("id") % 5).alias("p"))
    load_partitions(rows, path, ["p"])
    touched = stored(spark.createDataFrame([(1, 1)], "p int, _n long"), "touched")
    pruned = of_partitions(spark.read.parquet(path), touched, ["p"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert sorted(row.k for row in pruned.collect()) == [1, 6, 11, 16]


def test_large_partition_is_written_by_many_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "100KB")
    try:
        df = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "large").otherwise("other").alias("p"),
            F.xxhash64("id").alias("v"),
        )
        load_partitions(df, str(tmp_path / "t"), ["p"])
        assert len(list((tmp_path / "t" / "p=large").glob("*.parquet"))) > 3
    finally:
        spark.conf.unset(name)


# Session


def test_scratch_lies_in_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(3).write.parquet(path)
    release_scratch(spark)
    assert not spark.sparkContext._jvm.java.io.File(path).exists()


def test_session_settings(spark):
    assert build_session() is not None
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
