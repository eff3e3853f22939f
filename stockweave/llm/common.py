"""What the corpus operators share: Arrow batches of bounded size, row numbers, written tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.session import materialize

#: Text reaches Python in batches of this size, so long documents don't add up in a worker.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}


def by_value(name: str) -> None:
    """Send the functions of this module with the task: executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in BATCH_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def utf8(column: str | Column) -> Column:
    """Text as UTF-8 bytes; null stays null."""
    return (F.col(column) if isinstance(column, str) else column).cast("string").cast("binary")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, name: str, column: str, codec: str | None = None) -> DataFrame:
    """``df`` with a number of its own on every row, written so that all later reads agree on it."""
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name, codec)


def map_batches(df: DataFrame, kernel: Callable, schema: str) -> DataFrame:
    """``kernel(record batch) -> record batch`` over every Arrow batch, no shuffle."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                yield kernel(batch)

    return df.mapInArrow(run, schema)


def record_batch(**columns):
    """Arrow columns given as (values, type) pairs."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in columns.values()], names=list(columns)
    )
