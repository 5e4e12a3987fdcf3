"""The driver's correctness gate in the test suite: every registered query
against its DuckDB SQL at sf0.001 (rows, column names, types, values)."""

import duckdb

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.check_oracle import SPARK_TO_DUCK, TABLES, key, norm


def test_every_query_matches_its_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    sql = E.oracle_sql()
    bad = {}
    for name, q in E.queries().items():
        if name not in sql:             # tested by brute force where SQL cannot say it
            continue
        df = q(spark, SF0001)
        cols = df.columns
        stypes = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        srows = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=key)
        rel = con.sql(sql[name])
        dtypes = {n: str(t) for n, t in zip(rel.columns, rel.types)}
        idx = [rel.columns.index(c) for c in cols] if sorted(cols) == sorted(rel.columns) else None
        drows = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=key) if idx else None
        if stypes != dtypes or drows != srows:
            bad[name] = (len(srows), None if drows is None else len(drows))
    assert bad == {}
