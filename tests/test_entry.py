"""Driver contract: entry, and every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from strata.sources.tables import TABLES
from tools.oracle_check import rows_of, spark_type

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "chunk", "key_hex", "pos"]
    assert df.count() > 0


CORPUS = set(E._corpus()[0])          # the corpus operators have their own tests


def test_every_query_has_an_oracle():
    assert set(E.queries()) - CORPUS == set(E.oracle_sql()) - CORPUS
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    stypes = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())
