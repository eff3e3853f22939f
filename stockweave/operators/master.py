"""The transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MASTER_COLUMNS = (
    "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day",
    "days_since_prior_order", "product_id", "product_name", "reordered", "aisle", "department",
)
ORDER_COLUMNS = (
    "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order",
)


def product_dim(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    return (
        products.join(aisles, "aisle_id")
        .join(departments, "department_id")
        .select("product_id", "product_name", "aisle", "department")
    )


def build_master(
    orders: DataFrame,
    order_products: DataFrame,
    products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    eval_set: str = "prior",
) -> DataFrame:
    """Order lines with order, product, aisle and department columns, one evaluation set.

    The filter stands before the joins. No broadcast hint: Spark broadcasts a dimension when its
    measured size allows it and splits skewed partitions otherwise.
    """
    wanted = orders.filter(F.col("eval_set") == eval_set).drop("eval_set")
    dim = product_dim(products, aisles, departments)
    return order_products.join(wanted, "order_id").join(dim, "product_id").select(*MASTER_COLUMNS)


def distinct_orders(master: DataFrame, columns: tuple[str, ...] = ORDER_COLUMNS) -> DataFrame:
    """One row per order. Order columns are constant within an order, so any value will do;
    aggregating by the id alone keeps the shuffle key small."""
    rest = [c for c in columns if c != "order_id"]
    return master.groupBy("order_id").agg(*[F.first(c).alias(c) for c in rest]).select(*columns)
