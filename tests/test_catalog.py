"""Every catalog query against its DuckDB text on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import verify
from tokenloom.catalog import all_queries

ORACLE = entry.oracle_sql()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in all_queries()}


@pytest.fixture(scope="module")
def con(data_dir):
    c = duckdb.connect()
    for t in verify.TABLES:
        c.execute(f"create view {t} as select * from '{data_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, data_dir, name):
    note, ok = verify.compare(spark, con, name, QUERIES[name], ORACLE.get(name), data_dir)
    assert ok, note


def test_entry(spark, data_dir):
    df = entry.entry(spark)
    assert df.columns == ["dataset", "sample", "tokens"] and df.count() > 0


def test_only_random_operators_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {"a13_training_samples", "a23_sample_prompt", "a31_interleave_icl"}
