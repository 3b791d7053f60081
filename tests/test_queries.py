"""Every query with SQL gives the SQL's rows on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return str(v) if v is not None and not isinstance(v, (int, bool)) else None if v is None else int(v)

    return sorted(columns), sorted(([plain(r[i]) for i in order] for r in values), key=str)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(entry.queries())))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    want = rows([c[0] for c in cur.description], cur.fetchall())
    df = entry.queries()[name](spark, DATA)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_without_the_optional_parts(tmp_path):
    """With the training-data folders deleted, the rest of the library and the entry points work."""
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{top}/keelson", tmp_path / "keelson", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{top}/__spark_entry__.py", tmp_path)
    code = "import keelson.cli, keelson.jobs, keelson.streaming.change_stream, __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 40; print('fine')"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=120)
    assert out.stdout.strip() == "fine", out.stderr
