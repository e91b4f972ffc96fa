"""Every query against its SQL on the smallest tables, and the entry module without its optional folders."""

import glob
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__
from taxaflow.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def cell(x):
    if isinstance(x, (list, np.ndarray)):
        return tuple(map(cell, x))
    if isinstance(x, (float, np.floating)):
        return None if x != x else round(float(x), 6)
    if isinstance(x, (np.integer,)):
        return int(x)
    return x


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(repr(tuple(map(cell, r))) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_without_the_optional_folders(tmp_path):
    root = Path(__spark_entry__.__file__).parent
    for p in root.iterdir():
        if p.name in ("__spark_entry__.py",):
            (tmp_path / p.name).write_text(p.read_text())
    package = tmp_path / "taxaflow"
    package.mkdir()
    for p in (root / "taxaflow").iterdir():
        if p.name != "llm":
            (package / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rank_rollup' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=120)
