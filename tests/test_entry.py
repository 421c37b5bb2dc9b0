"""Driver contract and oracle parity on the smoke data."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 90
    assert "payor_name" in df.columns


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    assert len(s) == len(d)
    assert sorted(s.columns) == sorted(d.columns)
    assert digest(s) == digest(d)


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "StringType()": "VARCHAR",
                 "BooleanType()": "BOOLEAN", "DoubleType()": "DOUBLE"}


def test_column_types_match_oracle(spark, con):
    bad = {}
    for name, fn in E.QUERIES.items():
        s = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in fn(spark, SF_SMALL).schema.fields}
        d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
        if s != d:
            bad[name] = (s, d)
    assert not bad
