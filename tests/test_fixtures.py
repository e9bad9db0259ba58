"""Every derived fixture: the DataFrame and its SQL text give the same rows."""

import duckdb

from tablevault.plans import fixtures as fx
from tablevault.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of


def test_fixture_dataframes_equal_their_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in fx.SQL.items():
        df = getattr(fx, name)(spark, SF_SMALL)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(cols), name
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall()), name
