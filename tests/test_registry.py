import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from callstrata.operators import joins
from callstrata.registry import oracle, queries
from tests.helpers import plan
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle.all_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con.sql(entry.oracle_sql()[name])) == ""
    text = plan(df)
    assert not re.search(r"CartesianProduct|NestedLoopJoin|EvalPython|InPandas|PythonUDF", text)


@pytest.mark.parametrize("name", ["enrich_calls", "anti_semi_filters", "hourly_history", "fact_cases"])
def test_query_equals_its_sql_when_no_lookup_may_be_broadcast(spark, con, monkeypatch, name):
    monkeypatch.setattr(joins, "measured_bytes", lambda df: 1 << 60)
    df = entry.queries()[name](spark, SF)
    assert compare(df, con.sql(entry.oracle_sql()[name])) == ""


def test_only_models_lack_sql():
    assert set(queries.all_queries()) - set(oracle.all_sql()) == {
        "train_volume", "train_volume_band", "train_handling", "model_forecast", "kmeans_segments"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_works_without_the_corpus_folders(tmp_path):
    """The corpus operators live in folders that may be absent."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "callstrata", tmp_path / "callstrata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    names = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)},
                           capture_output=True, text=True, check=True).stdout.split()
    assert set(names) == set(queries.all_queries())
