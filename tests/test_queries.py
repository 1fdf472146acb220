"""Every registered query against its DuckDB text, on the smallest tables."""

import importlib.util
from pathlib import Path

import duckdb
import pytest
from conftest import SF

from linkscore.plans.oracles import ORACLES
from linkscore.plans.queries import QUERIES

# No Python worker, no cross join, in any registered query.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")
ROOT = Path(__file__).resolve().parents[1]
spec = importlib.util.spec_from_file_location("check", ROOT / "tools/check.py")
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(check.entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = check.entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    count, problems, _ = check.compare(df, con, name)
    assert not problems and count > 0


def test_entry(spark):
    df = check.entry.entry(spark)
    assert df.columns[:3] == ["sn", "mdn", "model"] and df.count() > 0
