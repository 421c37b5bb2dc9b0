"""The queries that SQL can express against their SQL."""

import duckdb
import pytest

from billflow.llm.oracle import SQL
from billflow.llm.queries import QUERIES
from tools.check_oracle import TABLES, digest


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    got, want = QUERIES[name](spark, f"/root/testdata/{sf}").toPandas(), con.execute(SQL[name]).df()
    assert len(got) == len(want) > 0 and sorted(got.columns) == sorted(want.columns)
    assert list(got.dtypes) == list(want[got.columns].dtypes)
    assert digest(got) == digest(want)
