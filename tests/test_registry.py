import duckdb

import __spark_entry__ as E
from tablevault.plans import catalog
from tablevault.sources.tables import TABLES
from tools.check_oracle import rows_of
from tests.conftest import SF_SMALL

# queries that SQL cannot express are allowed to lack an oracle
NO_ORACLE: set[str] = set()

# Spark type -> DuckDB type of the same values
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB"}


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) <= NO_ORACLE
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.queries()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["cls", "rows", "bytes"]
    assert df.count() > 0


def test_all_queries_match_oracle_on_small_data(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    sqls = catalog.oracle_sql()
    failed = []
    for name, fn in catalog.queries().items():
        df = fn(spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        if sorted(df.columns) != sorted(dcols) or rows_of(df.columns, srows) != rows_of(dcols, res.fetchall()):
            failed.append(name)
        spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString()) for f in df.schema.fields}
        duck_types = {r[0]: r[1] for r in con.execute(f"describe {sqls[name]}").fetchall()}
        if spark_types != duck_types:
            failed.append(f"{name} types {spark_types} != {duck_types}")
    assert failed == []
