"""Each query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from quern.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("QUERN_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def test_all_have_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found, wanted = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    key = lambda row: tuple(str(x) for x in row)
    rows = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=key)
    at = [wanted.columns.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in at) for r in wanted.fetchall()), key=key)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["row_index", "line"]
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_entry_without_the_training_data_operators(tmp_path):
    """An empty folder in their place, or one whose imports fail, leaves the other queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for kind in ("absent", "empty", "broken"):
        at = tmp_path / kind
        shutil.copytree(root / "quern", at / "quern", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(root / "__spark_entry__.py", at)
        if kind != "absent":
            (at / "quern/llm").mkdir()
        if kind == "broken":
            (at / "quern/llm/queries.py").write_text("import no_such_library")
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql().keys() <= e.queries().keys()"], cwd=at, env=os.environ | {"PYTHONPATH": str(at)}, capture_output=True, text=True, check=True)
        assert said.stdout.split() == list(QUERIES)


def test_native_stages_have_no_python(spark):
    plan = QUERIES["generate_offline"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
