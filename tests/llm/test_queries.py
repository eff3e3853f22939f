"""Registered queries: SQL twins, schemas, and nothing registered twice."""

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_all_operators_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in sorted(names, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(entry.OPTIONAL_ORACLE))
def test_query_equals_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    cols = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))
    assert got == sorted(map(str, rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall()))
