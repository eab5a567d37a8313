"""Reading and writing the grocery tables and the tables derived from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from pannier.sources.schemas import TABLES

# Names of the raw files where they differ from the table names.
RAW_NAMES = {"order_products": "order_products_prior"}
# Quotes inside quoted text are doubled.
CSV_FORM = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan a CSV file under a declared schema, matching columns by their header names.

    Spark assigns declared columns by position, so the header is read first to find
    where they are; columns that are not declared are skipped. A file of the folder with
    another header, and text that is not of the declared type, raise an error when read.
    """
    header = spark.read.options(**CSV_FORM).csv(path).columns
    missing = set(schema.names) - set(header)
    if missing:
        raise ValueError(f"{path} lacks the columns {sorted(missing)}")
    in_file = [schema[name] if name in schema.names else StructField(name, StringType()) for name in header]
    strict = spark.read.options(**CSV_FORM, enforceSchema="false", mode="FAILFAST")
    return strict.schema(StructType(in_file)).csv(path).select(*schema.names)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a Parquet folder, under ``schema`` when one is given."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_raw(spark: SparkSession, folder: str, form: str = "csv") -> dict[str, DataFrame]:
    """The four input tables from ``folder``, as raw CSV or as clean Parquet tables."""
    if form == "parquet":
        return {name: read_parquet(spark, f"{folder}/{name}.parquet", schema) for name, schema in TABLES.items()}
    return {
        name: read_csv(spark, f"{folder}/{RAW_NAMES.get(name, name)}.csv", schema) for name, schema in TABLES.items()
    }


def write_table(df: DataFrame, path: str, form: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Replace the table at ``path``; every task writes its own part file."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.options(**CSV_FORM).csv(path) if form == "csv" else writer.parquet(path)


def build_clean_tables(
    raw: dict[str, DataFrame], folder: str, watch: Callable[[str, DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Write the clean relational tables one after the other and return scans of them.

    ``watch(name, table)`` may put a table under observation before it is written.
    """
    spark = raw["orders"].sparkSession
    for name, schema in TABLES.items():
        table = raw[name].select(*schema.names)
        write_table(watch(name, table) if watch else table, f"{folder}/{name}.parquet")
    return read_raw(spark, folder, "parquet")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write a catalog table at ``path`` in buckets of ``key``, sorted inside, and return its scan.

    Joins and groupings on ``key`` of such tables, or on ``key`` and more, need no shuffle. Rows are
    shuffled once here, so that each bucket is one file. There are as many buckets as shuffle
    partitions unless given; NULL keys share a bucket. The table's name is new in every call.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"pannier_{uuid.uuid4().hex[:12]}"
    laid = df.repartition(buckets, key)
    laid.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)
