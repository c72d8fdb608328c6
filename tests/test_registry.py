import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidecycle import registry, registry_files, registry_sources  # noqa: F401 - adds its queries to the registry

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def rows(df, cols):
    return sorted(str(tuple(None if pd.isna(x) else x for x in r)) for r in df[cols].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    found = registry.QUERIES[name](spark, SF).toPandas()
    want = con.execute(registry.ORACLES[name]).df()
    cols = sorted(found.columns)
    assert cols == sorted(want.columns)
    assert rows(found, cols) == rows(want, cols)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_without_the_training_data_operators(tmp_path):
    """The entry module works with that subpackage and the pipeline taken out, but hides no other error."""
    import shutil

    shutil.copytree(ROOT / "tidecycle", tmp_path / "tidecycle", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cycles' in q and not any(n.startswith('op1') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
