"""Queries with SQL, on whole tables, and what all queries have in common."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, duck_rows, duck_types, spark_rows, spark_types

from packhorse.llm.queries import MODULES, ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"
ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    df, db = QUERIES[name](spark, FOLDER), connect(FOLDER)
    assert spark_types(df) == duck_types(db, ORACLES[name])
    assert spark_rows(df) == duck_rows(db, ORACLES[name])


def test_one_query_for_each():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(MODULES) + 1))


def test_entry_without_a_session_and_without_the_subpackage(tmp_path):
    """The entry module imports before there is a session, and when these folders are gone."""
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert set(QUERIES) | {"pipeline"} < set(run.stdout.split())
    rest = tmp_path / "rest"
    rest.mkdir()
    (rest / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    (rest / "packhorse").mkdir()
    for part in (ROOT / "packhorse").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (rest / "packhorse" / part.name).symlink_to(part)
    hide = "import sys; sys.path.insert(0, '.'); sys.dont_write_bytecode = True; "
    code = hide + "exec(open('__spark_entry__.py').read().replace('os.path.abspath(__file__)', repr('.'))); print(*queries())"
    run = subprocess.run([sys.executable, "-c", "__file__='./__spark_entry__.py'; " + code], cwd=rest, capture_output=True, text=True, check=True)
    assert "p09_revenue_mart" in run.stdout and "op1_" not in run.stdout and "pipeline" not in run.stdout


def test_native_plan_has_no_python(spark):
    plan = QUERIES["op3_secrets"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert operator not in plan
