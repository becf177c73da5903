import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from lumiflux.plans import queries as core

TABLES = "embeddings events customer nation supplier part orders lineitem"


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def same(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 5) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_and_sql_agree(spark, con, sf, name):
    df, want = core.QUERIES[name](spark, sf), con.sql(core.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    key = lambda r: tuple(map(str, r))
    a = sorted((tuple(same(r[c]) for c in cols) for r in df.collect()), key=key)
    b = sorted((tuple(same(r[i]) for i in at) for r in want.fetchall()), key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=2e-5) if all(isinstance(v, (int, float)) for v in x) else key(x) == key(y)


def test_frames_are_printed_as_sql_prints_them(spark, tmp_path):
    """Ties, missing and endless pixels, digits beyond those of a double, a frame of nulls."""
    odd = [1 / 32, 3 / 32, 5 / 32, -1 / 32, -2 - 1 / 32, -2 - 2.0**-20, None, float("nan"), float("inf"), float("-inf"), 3.4e38, -2.0]
    rows = [(i, [odd[(i + j) % len(odd)] for j in range(64)], 0) for i in range(6)] + [(6, [None] * 64, 0), (7, [5 / 32] * 64, 0), (8, None, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = c.sql(f"SELECT channel, t, img FROM ({core.SQL['pixels_to_frames']})").fetchall()
    got = [tuple(r) for r in core.QUERIES["pixels_to_frames"](spark, str(tmp_path)).select("channel", "t", "img").collect()]
    assert len(want) == 8 and sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert core.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 664
    assert set(core.SQL) <= set(entry.oracle_sql()) and set(core.QUERIES) <= set(entry.queries())


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    import shutil

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; assert e.llm is None; assert 'flagship' in e.queries() and not any(k.startswith('op') for k in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=os.environ | {"PYTHONPATH": str(tmp_path / "r")}, check=True)
