"""Grocery tables derived from an order/line/part star schema.

A brand plays the product. The grocery columns the star schema has no counterpart
for (order number, days since the prior order, cart position, reordered flag) are
derived from the order dates and line numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from pannier.sources.schemas import TABLES
from pannier.sources.scratch import Scratch


def _part_products(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        F.substring_index("p_brand", "#", -1).cast("bigint").alias("product_id"),
        F.col("p_brand").alias("product_name"),
    )


def star_products(part: DataFrame) -> DataFrame:
    """One product per brand, five brands to a department."""
    return (
        _part_products(part)
        .select("product_id", "product_name")
        .distinct()
        .withColumn("department_id", F.expr("cast((product_id - 1) div 5 + 1 as int)"))
    )


def star_departments(part: DataFrame) -> DataFrame:
    """The departments of the derived products."""
    return (
        star_products(part)
        .select("department_id")
        .distinct()
        .withColumn("department", F.concat(F.lit("Department#"), F.col("department_id").cast("string")))
    )


def star_orders(orders: DataFrame) -> DataFrame:
    """Number every user's orders by date and key.

    The numbering runs per (user, day) on top of per-day totals. A user's totals are
    at most one row per calendar day, so a user who owns a large share of all orders
    is still spread over as many tasks as there are days.
    """
    base = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        "o_orderdate",
        F.to_date("o_orderdate").alias("day"),
    )
    by_user = W.partitionBy("user_id")
    by_user_day = by_user.orderBy("day")
    days = (
        base.groupBy("user_id", "day")
        .agg(F.count("*").alias("n"))
        .withColumn("total", F.sum("n").over(by_user))
        .withColumn("before", F.sum("n").over(by_user_day.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("prior_day", F.lag("day").over(by_user_day))
    )
    within = F.row_number().over(W.partitionBy("user_id", "day").orderBy("o_orderdate", "order_id"))
    number = F.coalesce("before", F.lit(0)) + F.col("within")
    gap = F.when(F.col("within") > 1, F.lit(0)).otherwise(F.datediff("day", "prior_day"))
    return base.join(days, ["user_id", "day"]).withColumn("within", within).select(
        "order_id",
        "user_id",
        F.when(number == F.col("total"), "train").otherwise("prior").alias("eval_set"),
        number.cast("int").alias("order_number"),
        (F.dayofweek("day") - 1).alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def star_order_products(lineitem: DataFrame, part: DataFrame, numbered_orders: DataFrame) -> DataFrame:
    """One line per (order, brand), placed in the cart by its first line number.

    Lines are moved twice: by order, then by user and product, where the first order with the
    product is found in the same sort. Lines without a user or a product number are never reordered, and
    their orders stay apart there.
    """
    placed = (
        lineitem.join(_part_products(part), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("order_id"), "product_id", "l_linenumber")
        .repartition("order_id")
        .groupBy("order_id", "product_id")
        .agg(F.min("l_linenumber").alias("line"))
        .withColumn(
            "add_to_cart_order",
            F.row_number().over(W.partitionBy("order_id").orderBy("line", "product_id")),
        )
        .drop("line")
        .join(numbered_orders.select("order_id", "user_id", "order_number"), "order_id", "left")
    )
    known = F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
    first = F.min("order_number").over(W.partitionBy("user_id", "product_id", "apart"))
    return placed.withColumn("apart", F.when(~known, F.col("order_id"))).select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        F.coalesce(known & (F.col("order_number") > first), F.lit(False)).cast("int").alias("reordered"),
    )


def star_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four grocery tables over the Parquet files in ``folder``."""
    orders, lineitem, part = (
        spark.read.parquet(f"{folder}/{name}.parquet") for name in ("orders", "lineitem", "part")
    )
    numbered = Scratch.of(spark).keep(star_orders(orders), "numbered-orders")
    tables = {
        "orders": numbered,
        "order_products": star_order_products(lineitem, part, numbered),
        "products": star_products(part),
        "departments": star_departments(part),
    }
    return {name: df.select(*TABLES[name].names) for name, df in tables.items()}


def star_type_carts(spark: SparkSession, folder: str) -> DataFrame:
    """Cart lines with the part type as product: one per (order, type), numbered by the first line number."""
    lineitem, part = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("lineitem", "part"))
    types = part.select(F.col("p_type").alias("product_name")).distinct()
    types = types.withColumn("product_id", F.row_number().over(W.orderBy("product_name")).cast("bigint"))  # a row per type
    placed = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("p_type").alias("product_name"))
        .agg(F.min("l_linenumber").alias("line"))
    )
    position = F.row_number().over(W.partitionBy("order_id").orderBy("line", "product_name"))
    return placed.withColumn("add_to_cart_order", position).join(types, "product_name").drop("line")


def star_type_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the part type as product name; its baskets hold large itemsets."""
    lineitem, part = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("lineitem", "part"))
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("p_type").alias("product_name")
    )
