"""Every query with SQL gives the same rows as DuckDB; the engine works without the optional package."""

import glob
import os
import subprocess
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from brieflight.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return "null"
    if isinstance(v, (bool, np.bool_, int, float, np.number)):
        return f"{float(v):.9g}"
    return str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(x) for x in r) for r in df[names].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_import_without_the_optional_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.makedirs(tmp_path / "brieflight")
    for d in os.listdir(f"{root}/brieflight"):
        if d not in ("llm", "__pycache__"):
            os.symlink(f"{root}/brieflight/{d}", tmp_path / "brieflight" / d)
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
