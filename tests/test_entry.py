import os
import subprocess
import sys

import pytest
from conftest import DATA, ROOT


def same(a, b):
    def key(df):
        cols = sorted(df.columns)
        return sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))

    assert sorted(a.columns) == sorted(b.columns)
    assert key(a) == key(b)


def names():
    from sparkloom.plans import catalog

    return list(catalog.QUERIES)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(f"{DATA}/sf0.001"):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/sf0.001/{f}')")
    return con


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, duck, name):
    from sparkloom.plans import catalog

    got = catalog.QUERIES[name](spark, f"{DATA}/sf0.001").toPandas()
    if name in catalog.ORACLES:
        same(got, duck.execute(catalog.ORACLES[name]).df())
    else:
        assert len(got) > 0


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_the_optional_parts(tmp_path):
    code = "import sys; sys.modules['sparkloom.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
