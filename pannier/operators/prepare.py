"""Sampling, splitting and joining the input tables into the master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from pannier.functions.expressions import fill_missing, row_hash
from pannier.sources.schemas import MASTER

# Columns that go into the master table.
ORDER_COLUMNS = ["order_id", "order_dow", "order_hour_of_day", "days_since_prior_order", "order_number"]
PRODUCT_COLUMNS = ["product_id", "product_name", "department_id"]


class CardinalityError(ValueError):
    """A side of a join that must hold one row per key holds several."""


def prior_orders(orders: DataFrame) -> DataFrame:
    """Only the orders of the prior evaluation set."""
    return orders.filter(F.col("eval_set") == "prior")


def first_orders(orders: DataFrame) -> DataFrame:
    """Every user's first order."""
    return orders.filter(F.col("order_number") == 1)


def missing_days(orders: DataFrame) -> DataFrame:
    """Orders without a number of days since the prior one."""
    return orders.filter(F.col("days_since_prior_order").isNull()).select("order_id", "days_since_prior_order")


def keep_members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``ids``; duplicates in ``ids`` do not multiply them."""
    return df.join(ids.select(key), key, "left_semi")


def _sample_hash(key: str, seed: int) -> Column:
    # The tag keeps the sample independent of the split, which hashes the same ids.
    return row_hash("sample", F.col(key), seed)


def sample_cutoff(keys: DataFrame, key: str, n: int, seed: int) -> Column:
    """The n-th smallest (hash, key) of the unique ``keys``, NULL when there are fewer.

    Hashes are first counted by their leading 16 bits; only the one of those 65,536
    buckets that holds the n-th hash is ranked, so no task ever sorts all keys.
    """
    hashed = keys.select(key, _sample_hash(key, seed).alias("hash")).withColumn(
        "bucket", F.substring("hash", 1, 4)
    )
    running = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = (
        hashed.groupBy("bucket")
        .agg(F.count("*").alias("size"))
        .withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .filter((F.col("before") < n) & (F.col("before") + F.col("size") >= n))
    )
    rank = F.row_number().over(W.partitionBy("bucket").orderBy("hash", key))
    return (
        hashed.join(F.broadcast(buckets), "bucket")  # one row
        .withColumn("rank", rank)
        .filter(F.col("before") + F.col("rank") == n)
        .select(F.struct("hash", key))
        .scalar()
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42, keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` for exactly ``n`` random keys (all of them when there are fewer).

    The keys to draw from are ``keys`` or else the keys of ``df``, which must then be
    unique. The same seed draws the same keys whatever the partitioning.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    cutoff = sample_cutoff(df if keys is None else keys, key, n, seed)
    drawn = F.struct(_sample_hash(key, seed).alias("hash"), F.col(key)) <= cutoff
    return df.filter(F.coalesce(drawn, F.lit(True)))


def sample_users(orders: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Whole order histories of exactly ``n`` random users."""
    return sample_rows(orders, "user_id", n, seed, orders.select("user_id").distinct())


def peek(df: DataFrame, key: str, k: int = 10, seed: int = 42) -> DataFrame:
    """A few random rows to look at."""
    return df.orderBy(_sample_hash(key, seed), key).limit(k)


def split_column(test_share: float = 0.2, seed: int = 42, key: str = "order_id") -> Column:
    """``test`` for a hashed share of the keys and ``train`` for the others."""
    threshold = format(int(test_share * 2**32), "08x")
    prefix = F.substring(row_hash(F.col(key), seed), 1, 8)
    everything = F.lit(test_share >= 1)
    return F.when(everything | (prefix < threshold), "test").otherwise("train")


def split_orders(df: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; all lines of an order land on the same side."""
    side = split_column(test_share, seed)
    return df.filter(side == "train"), df.filter(side == "test")


def join_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with their lines; orders without lines drop out."""
    return orders.join(lines, "order_id")


def join_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their product's name and department."""
    return lines.join(products.select(*PRODUCT_COLUMNS), "product_id")


def join_departments(lines: DataFrame, departments: DataFrame) -> DataFrame:
    """Lines with their department's name."""
    return lines.join(departments, "department_id")


def build_master(
    orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    departments: DataFrame,
    n: int | None = None,
    seed: int = 42,
    unit: str = "order",
) -> DataFrame:
    """One row per cart line of the prior orders, or of a sample of ``n`` orders or users.

    Product and department joins carry no hint: Catalyst broadcasts those tables while
    their files are small and AQE splits the popular products once they are not.
    """
    chosen = prior_orders(orders)
    if n is not None:
        chosen = sample_users(chosen, n, seed) if unit == "user" else sample_rows(chosen, "order_id", n, seed)
    joined = join_lines(chosen.select(*ORDER_COLUMNS), lines)
    joined = join_departments(join_products(joined, products), departments)
    return joined.withColumn("days_since_prior_order", fill_missing("days_since_prior_order", -1.0)).select(
        *MASTER.names
    )


def order_lines(master: DataFrame, order_id: Column | int) -> DataFrame:
    """One order's lines in cart order."""
    return (
        master.filter(F.col("order_id") == order_id)
        .select("order_id", "product_id", "product_name", "add_to_cart_order")
        .orderBy("add_to_cart_order")
    )


def product_catalogue(lines: DataFrame) -> DataFrame:
    """One row per product_id seen in ``lines``; conflicting names resolve to the smallest.

    Lines are first cut down to their different products by hashing; the minimum over
    structs, which Spark computes by sorting, then sees hardly more rows than products.
    """
    products = lines.select("product_id", "product_name", "department_id", "department").distinct()
    return (
        products.groupBy("product_id")
        .agg(F.min(F.struct("product_name", "department_id", "department")).alias("p"))
        .select("product_id", "p.product_name", "p.department_id", "p.department")
    )


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise unless ``df`` holds at most one row per key."""
    repeated = df.groupBy(key).count().filter(F.col("count") > 1).first()
    if repeated is not None:
        raise CardinalityError(f"{key}={repeated[key]!r} occurs {repeated['count']} times")
