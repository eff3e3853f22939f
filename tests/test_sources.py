"""Input of the queries and intermediate tables: whole rows, small exchanges, no files left behind."""

import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockweave.session import SHUFFLE_CLEANUP_KEY, materialize
from stockweave.sources import adapter

COLUMNS = ["order_id", "user_id", "order_dow", "order_hour_of_day", "days_since_prior_order", "product_id",
           "product_name", "reordered"]


@pytest.fixture
def tables(spark, tmp_path):
    """Orders that come twice, lines that come twice, keys and values that are null."""
    day = datetime(1999, 1, 1)
    orders = [(k, k % 4 if k % 11 else None, "POF"[k % 3] if k % 7 else None, day + timedelta(days=k * 5 % 17) if k % 9 else None)
              for k in range(1, 30)]
    orders += orders[3:6]
    lines = [(k, k * j % 5) for k, *_ in orders[:29] for j in range(1, 4)] + [(None, 1), (8, None), (4, 4), (4, 4), (99, 1)]
    parts = [(i, f"part {i}", "b", "t") for i in range(5)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
        ("lineitem", lines, "l_orderkey long, l_partkey long"),
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path), orders, lines


def test_sales_rows(spark, tables):
    path, orders, lines = tables
    # Gaps need a user and a day: orders without are left out.
    owned = [(o, p) for k, p in lines for o in orders if o[0] == k and None not in (o[1], o[3])]
    first, want = {}, Counter()
    for (k, user, _, when), p in owned:  # orders of all kinds
        first[user, p] = min(first.get((user, p), (when, k)), (when, k))
    for (k, user, status, when), p in owned:
        if status != "P" and p is not None:
            row = (k, user, (when.weekday() + 1) % 7, (k * 7 + user) % 24, p, f"part {p}")
            want[(*row, int((when, k) > first[user, p]))] += 1
    got = adapter.sales(spark, path, COLUMNS).drop("days_since_prior_order").collect()
    assert Counter(map(tuple, got)) == want
    plain = adapter.sales(spark, path, [c for c in COLUMNS if c != "reordered"])
    assert Counter(tuple(r)[:-1] for r in adapter.sales(spark, path, COLUMNS).collect()) == Counter(map(tuple, plain.collect()))


def test_sales_exchange_no_column_that_others_tell(spark, tables):
    rows = adapter.sales(spark, tables[0], COLUMNS)
    below = rows._jdf.queryExecution().optimizedPlan().toString().partition("Window [min(")[2]
    assert below and "dayofweek" not in below and "pmod" not in below


def test_materialize_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before, set_to = files(), spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    kept = spark.range(50_000).groupBy((F.col("id") % 999).alias("k")).agg(F.sum("id").alias("s"))
    assert kept.count() == 999  # its own files stay as long as the session wishes
    meanwhile = files()
    out = materialize(kept, "sums")
    for _ in range(50):
        if not files() - meanwhile - before:
            break
        time.sleep(0.2)
    assert not files() - meanwhile - before
    assert spark.conf.get(SHUFFLE_CLEANUP_KEY, None) == set_to
    assert out.agg(F.sum("s")).first()[0] == sum(range(50_000))
