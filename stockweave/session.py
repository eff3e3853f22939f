"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: split the oversized partition, also where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Names the scratch folder where the cluster sets no ``spark.checkpoint.dir``.
SCRATCH_KEY = "stockweave.scratch.dir"
#: Set by ``scratch_scope`` while a run is on.
SCOPE_KEY = "stockweave.scratch.run"
#: Spark removes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on for skewed keys."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stockweave")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_base(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder, else the folder the caller named for this session."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, or the folder of the scope that is open; raises where
    nobody named one."""
    base = spark.conf.get(SCOPE_KEY, None) or scratch_base(spark)
    if not base:
        raise ValueError(f"spark.checkpoint.dir (or {SCRATCH_KEY}) must name a folder all executors share")
    return f"{base.rstrip('/')}/stockweave/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """All intermediate tables written inside go to one folder, which is removed at the end: sinks
    must have run by then."""
    outer = spark.conf.get(SCOPE_KEY, None)
    folder = scratch_path(spark, "run")
    spark.conf.set(SCOPE_KEY, folder)
    try:
        yield folder
    finally:
        spark.conf.set(SCOPE_KEY, outer) if outer else spark.conf.unset(SCOPE_KEY)
        remove_path(spark, folder)


def remove_path(spark: SparkSession, name: str) -> None:
    """Remove a folder that this run wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, compressed by ``codec`` or as the session says, and read it back.

    Ends the lineage, so a lost executor costs a re-read and not the whole job, and gives
    Catalyst the real size, so later joins broadcast it only if it is small. What the write shuffled
    is removed: nobody reads it again.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP_KEY) if before is None else spark.conf.set(SHUFFLE_CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)
