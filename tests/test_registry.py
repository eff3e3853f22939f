"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.OPTIONAL_ORACLE)))
def test_query_equals_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cols = sorted(df.columns)
    rel = duck.sql(entry.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=_key)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=_key)
    assert got == want


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    unchecked = set(entry.queries()) - set(entry.OPTIONAL) - set(entry.oracle_sql())
    assert unchecked == {
        "kmeans_segments", "k_selection", "segment_labels", "pca_projection", "gbt_forecast",
        "gbt_fold_report", "feature_importance", "feature_attribution",
    }
