"""A scratch folder for sessions of one machine that name none, such as tests and the benchmark."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

from stockweave.session import SCRATCH_KEY, scratch_base


def local_scratch(spark: SparkSession) -> SparkSession:
    """Name a folder of this machine, removed at exit, if the session is local and names none."""
    master = spark.sparkContext.master
    if not scratch_base(spark) and (master == "local" or master.startswith("local[")):
        folder = tempfile.mkdtemp(prefix="stockweave-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set(SCRATCH_KEY, folder)
    return spark
