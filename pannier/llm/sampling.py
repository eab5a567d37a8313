"""Bounded samples by a hash, without sending candidates of every task to one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch

_BITS = 16  # leading bits of a mark by which marks are counted


def lowest_marks(marks: DataFrame, n: int, by: Sequence[str] = (), mark: str = "mark") -> DataFrame:
    """Per group of ``by``, the greatest of its ``n`` lowest different marks as ``last_mark``; its greatest if there are fewer.

    Marks are 64-bit hashes. They are first counted by their leading bits, and only the ranges
    that hold the lowest ``n`` are ranked. What is counted is a bound from below of a range's
    different marks, one bit for each value of six more bits, so a row that a third of the table
    repeats counts once and is folded inside each task. NULL groups are groups; an empty table
    gives no group, or NULL without ``by``. ``marks`` is read twice and should be a written table.
    """
    marks = marks.select(*by, F.col(mark).alias("_mark"), F.shiftright(mark, 64 - _BITS).alias("_range"))
    one_bit = F.expr(f"shiftleft(1L, CAST(shiftright(_mark, {64 - _BITS - 6}) & 63 AS INT))")
    counted = marks.groupBy(*by, "_range").agg(F.bit_count(F.bit_or(one_bit)).cast("bigint").alias("_least"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    needed = counted.withColumn("_before", F.coalesce(F.sum("_least").over(before), F.lit(0))).filter(F.col("_before") < n)
    last = needed.groupBy(*by).agg(F.max("_range").alias("_last_range"))
    # Written, the row per group has a known size, so that rows meet it where they are.
    scratch = Scratch.of(marks.sparkSession)
    last = scratch.keep(last, "last-ranges")
    same = [marks[c].eqNullSafe(last[c]) for c in by]
    low = marks.join(last, [*same, marks["_range"] <= last["_last_range"]], "left_semi")
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_mark"))
    ranked = low.select(*by, "_mark").distinct().withColumn("_place", place).filter(F.col("_place") <= n)
    return scratch.keep(ranked.groupBy(*by).agg(F.max("_mark").alias("last_mark")), "last-marks")
