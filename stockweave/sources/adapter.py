"""The given test tables (orders, lineitem, part, customer, ...) seen as the retail raw tables.

Each function scans only the columns it needs. Expensive columns (order number, gap, reordered)
are built only when asked for, so a query does not pay for joins it does not use.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockweave.functions.ordering import daily_positions, ordered_codes, value_codes
from stockweave.operators.calendar import day_spine, event_calendar
from stockweave.params import CalendarParams
from stockweave.session import materialize

YEARS = range(1995, 2002)
CALENDAR = CalendarParams(
    festivals=tuple(f"{y}-{md}" for y in YEARS for md in ("03-17", "07-29", "10-03", "10-23")),
    windows=tuple((f"{y}-04-08", f"{y}-05-26") for y in YEARS),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Columns of ``orders`` beside the order id.
ORDER_HEAD = (
    "user_id", "order_date", "order_dow", "order_hour_of_day", "order_number", "days_since_prior_order",
)


#: What tells a column that follows from other columns of an order.
DERIVED_FROM = {"order_dow": ("order_date",), "order_hour_of_day": ("order_id", "user_id")}


def derived(name: str) -> Column:
    """The column by the columns that tell it, any other as it is."""
    if name == "order_dow":
        return (F.dayofweek("order_date") - 1).alias(name)
    if name == "order_hour_of_day":
        return F.pmod(F.col("order_id") * 7 + F.col("user_id"), F.lit(24)).cast("int").alias(name)
    return F.col(name)


def orders(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """One row per order; ``numbered`` adds order_number and days_since_prior_order."""
    out = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(F.col("o_orderstatus") == "P", "train").otherwise("prior").alias("eval_set"),
    ).select("*", derived("order_dow"), derived("order_hour_of_day"))
    if not numbered:
        return out
    return (
        daily_positions(out, ["user_id"], "order_date", ["order_id"])
        .withColumn("order_number", F.col("position").cast("int"))
        .withColumn("days_since_prior_order", F.date_diff("order_date", "prior_day").cast("double"))
        .drop("position", "prior_day")
    )


def order_products(
    spark: SparkSession, sf_dir: str, reordered: bool = False, *head: str, prior_only: bool = False
) -> DataFrame:
    """One row per order line, with the ``head`` columns of its order; ``reordered`` marks parts the
    user bought in an earlier order: lines meet their orders once, the first purchase comes from one
    exchange by user and part, of all orders also where only the lines of ``prior`` ones are wanted."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    )
    numbered = bool({"order_number", "days_since_prior_order"} & set(head))
    prior = F.col("eval_set") == "prior"
    if not reordered:
        if not head and not prior_only:
            return lines
        heads = orders(spark, sf_dir, numbered)
        return lines.join((heads.filter(prior) if prior_only else heads).select("order_id", *head), "order_id")
    needed = dict.fromkeys(["user_id", "order_date", *head])
    heads = orders(spark, sf_dir, numbered).select("order_id", *needed, *[prior.alias("_wanted")] * prior_only)
    when = F.struct("order_date", "order_id")
    first = F.min(when).over(Window.partitionBy("user_id", "product_id"))
    marked = lines.join(heads, "order_id").withColumn("reordered", (when > first).cast("int"))
    return (marked.filter("_wanted") if prior_only else marked).select("order_id", "product_id", "reordered", *head)


def code_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(column, value, code) of part types and brands: one job for both."""
    return materialize(value_codes(table(spark, sf_dir, "part"), ["p_type", "p_brand"]), "part_codes")


def ids(codes: DataFrame, column: str, id_name: str, name: str) -> DataFrame:
    return codes.filter(F.col("column") == column).select(
        (F.col("code") + 1).cast("long").alias(id_name), F.col("value").alias(name)
    )


def products(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None) -> DataFrame:
    """Products with aisle and department ids."""
    codes = code_tables(spark, sf_dir) if codes is None else codes
    part = table(spark, sf_dir, "part")
    return (
        part.join(ids(codes, "p_type", "aisle_id", "p_type"), "p_type")
        .join(ids(codes, "p_brand", "department_id", "p_brand"), "p_brand")
        .select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), "aisle_id", "department_id"
        )
    )


def aisles(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None) -> DataFrame:
    return ids(code_tables(spark, sf_dir) if codes is None else codes, "p_type", "aisle_id", "aisle")


def departments(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None) -> DataFrame:
    return ids(code_tables(spark, sf_dir) if codes is None else codes, "p_brand", "department_id", "department")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw tables with all their columns."""
    full_orders = orders(spark, sf_dir, numbered=True).drop("order_date")
    codes = code_tables(spark, sf_dir)
    return {
        "orders": full_orders,
        "order_products": order_products(spark, sf_dir, True),
        "products": products(spark, sf_dir, codes),
        "aisles": aisles(spark, sf_dir, codes),
        "departments": departments(spark, sf_dir, codes),
    }


def sales(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """The master table's rows with only ``columns``; joins nothing that is not asked for.

    Keys of the test tables are complete, so a skipped dimension join drops no row. With ``reordered``
    lines are exchanged more than once, and columns that others tell are made after that.
    """
    columns = list(columns)
    late = DERIVED_FROM if "reordered" in columns else {}
    heads = dict.fromkeys(x for c in columns if c in ORDER_HEAD for x in late.get(c, (c,)) if x != "order_id")
    out = order_products(spark, sf_dir, "reordered" in columns, *heads, prior_only=True)
    names = {"product_name": "p_name", "aisle": "p_type", "department": "p_brand"}
    wanted = [c for c in columns if c in names]
    if wanted:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"), *[F.col(names[c]).alias(c) for c in wanted]
        )
        out = out.join(part, "product_id")
    return out.select(*[derived(c) if c in late else F.col(c) for c in columns])


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, product_name) of all order lines, for operators that bring their own orders."""
    names = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
    return order_products(spark, sf_dir).join(names, "product_id").select("order_id", "product_name")


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with area (nation), city and store (region) from the real keys."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return customer.join(nation, "n_nationkey").select(
        "user_id",
        F.col("n_nationkey").cast("string").alias("pin_code"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("store_id"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with a given segment: cluster_name, cluster_id."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("cluster_name")
    )
    return customer.join(ordered_codes(customer, "cluster_name", "cluster_id"), "cluster_name").select(
        "user_id", "cluster_id", "cluster_name"
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every calendar day from the first to the last order."""
    return day_spine(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_calendar(order_days(spark, sf_dir), CALENDAR)
