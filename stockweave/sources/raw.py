"""Raw CSV files and Parquet sinks, with explicit schemas (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

RAW_SCHEMAS = {
    "orders": (
        "order_id long, user_id long, eval_set string, order_number int, order_dow int, "
        "order_hour_of_day int, days_since_prior_order double"
    ),
    "order_products": "order_id long, product_id long, reordered int",
    "products": "product_id long, product_name string, aisle_id long, department_id long",
    "aisles": "aisle_id long, aisle string",
    "departments": "department_id long, department string",
    "users": "user_id long, pin_code string, city string, store_id string, first_order_date date",
}

RAW_FILES = {
    "orders": "orders.csv",
    "order_products": "order_products__prior.csv",
    "products": "products.csv",
    "aisles": "aisles.csv",
    "departments": "departments.csv",
}


FILE_ROWS = 5_000_000


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header; columns are matched by name and may stand in any order, among others.

    Only one header is looked at ahead of the scan; types come from ``schema``. A file of the folder
    whose header differs from that one fails the read. NaN becomes null.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    wanted = {f.name: f.dataType for f in StructType.fromDDL(schema)}
    in_file = reader.csv(path).columns
    missing = [c for c in wanted if c not in in_file]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    fields = [StructField(c, wanted.get(c, StringType())) for c in in_file]
    rows = reader.schema(StructType(fields)).csv(path)
    return rows.select(*[
        F.nanvl(c, F.lit(None)).alias(c) if isinstance(t, (DoubleType, FloatType)) else F.col(c) for c, t in wanted.items()
    ])


def load_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five raw tables; a missing file fails at once and names its path."""
    return {
        name: read_csv(spark, f"{folder.rstrip('/')}/{file}", RAW_SCHEMAS[name])
        for name, file in RAW_FILES.items()
    }


def load_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users with their area, store and the day of their first order."""
    return read_csv(spark, f"{folder.rstrip('/')}/users.csv", RAW_SCHEMAS["users"])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Overwrite ``path``. Rows are range-partitioned by the partition columns and a hash of the row,
    so the tasks follow the rows: a hot value is written by as many as its share, a small one leaves
    few files."""
    writer = df
    if partition_by:
        writer = df.repartitionByRange(*[F.col(c) for c in partition_by], F.xxhash64(*df.columns))
    writer.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).partitionBy(*partition_by).parquet(path)
    return path
