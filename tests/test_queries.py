from __future__ import annotations

import pytest

import __spark_entry__ as entry
from timeloom import catalog


def test_entry(spark, sf):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_agrees_with_its_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    from tools.compare import plain

    df = catalog.queries()[name](spark, sf)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r.asDict(True)[c]) for c in columns) for r in df.collect()), key=repr)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    table = con.sql(sql).to_arrow_table()
    assert columns == sorted(table.column_names)
    assert ours == sorted((tuple(plain(r[c]) for c in columns) for r in table.to_pylist()), key=repr)
