"""Counts and hygiene checks over the tables, one pass each."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch


def _long(df: DataFrame, key: str, values: dict[str, Column], name: str) -> DataFrame:
    """One aggregated row turned into a (key, name) row per aggregate."""
    return df.agg(*[column.cast("bigint").alias(label) for label, column in values.items()]).unpivot(
        [], list(values), key, name
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_info(df: DataFrame) -> DataFrame:
    """Type and number of present values per column."""
    types = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    counted = _long(df, "column_name", {c: F.count(c) for c in df.columns}, "non_null")
    return counted.withColumn("type_name", types[F.col("column_name")])


def footer_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Rows and columns of each Parquet folder, from the files' footers alone.

    Spark's second Parquet reader answers counts, and least and greatest values of numbers and
    dates, from the statistics each file ends with; no column is read. The reader is chosen in a
    session of its own, and a row per table comes back from it.
    """
    scans = {name: _footer_session(spark).read.parquet(path) for name, path in tables.items()}
    rows = [(name, df.count(), len(df.columns)) for name, df in scans.items()]
    return spark.createDataFrame(rows, "table_name string, n_rows bigint, n_columns bigint")


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reader may answer aggregates from footers."""
    own = spark.newSession()
    listed = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in listed if s != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_range_plan(spark: SparkSession, path: str) -> DataFrame:
    """The one row of counts, least and greatest values that ``footer_ranges`` reads."""
    df = _footer_session(spark).read.parquet(path)
    ranged = [c for c, kind in df.dtypes if kind in _FOOTER_TYPES]
    return df.agg(
        *[F.count(c).alias(f"n {c}") for c in df.columns],
        *[F.min(c).alias(f"least {c}") for c in ranged],
        *[F.max(c).alias(f"greatest {c}") for c in ranged],
    )


# Types whose least and greatest values Parquet footers hold exactly.
_FOOTER_TYPES = ("tinyint", "smallint", "int", "bigint", "date")


def footer_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Present values, and the least and greatest as text, of each whole-number and date column, from footers alone.

    Columns of other types have their present values counted only. A column without any value
    has NULL for both ends. Spark refuses to take ends from footers where a file has no value in
    a column; the columns are then read for them.
    """
    columns = _footer_session(spark).read.parquet(path).columns
    plan = footer_range_plan(spark, path)
    try:
        found = plan.first().asDict()
    except Exception as error:
        if "spark.sql.parquet.aggregatePushdown" not in str(error):
            raise
        plan.sparkSession.conf.set("spark.sql.parquet.aggregatePushdown", "false")
        found = plan.select("*").first().asDict()
    ends = [[found.get(f"{end} {c}") for end in ("least", "greatest")] for c in columns]
    rows = [(c, found[f"n {c}"], *(None if e is None else str(e) for e in both)) for c, both in zip(columns, ends)]
    return spark.createDataFrame(rows, "column_name string, non_null bigint, least string, greatest string")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column."""
    return _long(df, "column_name", {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "nulls")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of different values per column."""
    return _long(df, "column_name", {c: F.count_distinct(c) for c in columns}, "n_distinct")


def distinct_sketches(df: DataFrame, by: list[str], columns: list[str], precision: int = 14) -> DataFrame:
    """A mergeable sketch of each column's different values, per group of ``by``.

    A sketch has 2**precision registers at most, whatever it has seen, so one kept for each day
    can be merged into a week or a year without its rows. NULLs are not counted.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), precision).alias(c) for c in columns]
    return df.groupBy(*by).agg(*sketches)


def sketched_counts(sketches: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """About how many different values the merged sketches have seen, per group of ``by`` or in all.

    Up to some thousands of values the count is nearly exact; beyond that its standard error is
    about 0.8 / sqrt(2**precision), 0.7 % for the default. A column with only NULLs counts 0.
    """
    merged = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("bigint")).alias(c) for c in columns]
    return sketches.groupBy(*(by or [])).agg(*merged)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value as a share of all rows."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return value_counts(df, column).select(column, (F.col("n") / total).alias("share"))


def orphan_counts(orders: DataFrame, lines: DataFrame, products: DataFrame, departments: DataFrame) -> DataFrame:
    """Lines that refer to no order or product, orders that have no line, products without a department."""
    checks = {
        "lines_without_order": lines.join(orders, "order_id", "left_anti"),
        "lines_without_product": lines.join(products, "product_id", "left_anti"),
        "products_without_department": products.join(departments, "department_id", "left_anti"),
        "orders_without_lines": orders.join(lines, "order_id", "left_anti"),
    }
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check_name"), "n") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float | None]]) -> DataFrame:
    """Present values outside their allowed range, per column; an upper bound of None is open."""
    return _long(df, "column_name", {c: F.count_if(_outside(c, *bounds)) for c, bounds in ranges.items()}, "n_outside")


def _outside(column: str, low: float, high: float | None) -> Column:
    below = F.col(column) < low
    return below if high is None else below | (F.col(column) > high)


class Checks:
    """Counts taken by the job that writes a table, without a scan of their own.

    ``watch`` adds them to a table that is about to be written. They are taken where the rows
    leave for the files, in the tasks whose results Spark counts once, so lost executors and
    repeated tasks change nothing. ``rows`` waits for the write and has a row per column:
    table, column, type, rows, present values, NULLs, values outside ``ranges`` (NULL without a
    range) and, for each of the ``unique`` columns, in how many rows the most frequent value
    is (NULL for others; 0 without rows, and NULLs are values too).
    """

    def __init__(self, ranges: dict[str, tuple[float, float | None]] | None = None, unique: tuple[str, ...] = ()):
        self.ranges, self.unique = ranges or {}, unique
        self._watched: dict[str, tuple[list[tuple[str, str]], Observation]] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` under observation; a table with unique columns is shuffled by each of them, in turn."""
        keys = [c for c in df.columns if c in self.unique]
        watched, seen = df, Observation(f"checks of {name}")
        for key in keys:
            # A running number streams through a sorted group, whatever its size.
            watched = watched.withColumn(f"_alike {key}", F.row_number().over(W.partitionBy(key).orderBy(key)))
        measures = [F.count(F.lit(1)).alias("rows")]
        for c in df.columns:
            measures.append(F.count(c).alias(f"present {c}"))
            if c in self.ranges:
                measures.append(F.count_if(_outside(c, *self.ranges[c])).alias(f"outside {c}"))
        measures += [F.coalesce(F.max(f"_alike {key}"), F.lit(0)).alias(f"alike {key}") for key in keys]
        self._watched[name] = (df.dtypes, seen)
        return watched.observe(seen, *measures).drop(*(f"_alike {key}" for key in keys))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The counts of all watched tables, once these are written."""
        found = []
        for name, (columns, seen) in self._watched.items():
            counts = seen.get
            n = counts["rows"]
            for c, kind in columns:
                present = counts[f"present {c}"]
                found.append((name, c, kind, n, present, n - present, counts.get(f"outside {c}"), counts.get(f"alike {c}")))
        return spark.createDataFrame(
            found,
            "table_name string, column_name string, type_name string, n_rows bigint, non_null bigint, nulls bigint, "
            "n_outside bigint, most_alike bigint",
        )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and linearly interpolated quartiles per column.

    Values are counted first. Running counts then say which places of the sorted column a
    value fills; they are taken over ranges of values, so no task orders a whole column.
    """
    parts = []
    for column in columns:
        summary = df.agg(
            F.count(column).cast("double").alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
            F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"),
        )
        placed = Scratch.of(df.sparkSession).keep(running_counts(df, column), "placed-values")
        total = placed.agg(F.sum("n")).first()[0] or 0

        def quartile(q: float) -> Column:
            at = q * (total - 1)

            def value_at(place: int) -> Column:
                return F.max(F.when((F.col("before") <= place) & (F.col("before") + F.col("n") > place), F.col("v")))

            low, high = value_at(math.floor(at)), value_at(math.ceil(at))
            return placed.agg(low + (high - low) * (at - math.floor(at))).scalar()

        quartiles = [quartile(q).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
        parts.append(summary.select(F.lit(column).alias("column_name"), "n", "mean", "std", "min", *quartiles, "max"))
    return reduce(DataFrame.unionByName, parts)


def running_counts(df: DataFrame, column: str, range_values: int = 10_000) -> DataFrame:
    """Each present value ``v`` with its ``n`` rows and the number of rows ``before`` it, by running sums over ranges and inside them."""
    counted = Scratch.of(df.sparkSession).keep(
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n")), "values"
    )
    n = counted.count()
    ranges = n // range_values + 1
    cuts = sorted(set(counted.approxQuantile("v", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="v", outputCol="range").transform(counted)
    totals = ranged.groupBy("range").agg(F.sum("n").alias("held"))
    over = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("range", F.coalesce(F.sum("held").over(over), F.lit(0)).alias("start"))
    inside = W.partitionBy("range").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.join(starts, "range").withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.select("v", "n", (F.col("start") + F.col("inside")).alias("before"))
