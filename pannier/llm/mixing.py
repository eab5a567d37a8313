"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
RANGE_ROWS = 20_000  # rows that a range of hash keys holds on average


def word_count(text: str | Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3) -> DataFrame:
    """Targets of ``sizes(source_key, source_size)``, one row per source, sorted by key.

    Keys in order take the weights in turn. A target is ``least(most * size, level *
    weight)`` with the level at which targets add up to all sizes; that is where resharing
    the excess of stopped sources ends. The level is found from running sums over the
    sources in the order in which they stop.
    """
    place = F.row_number().over(Window.orderBy("source_key")) - 1
    weighed = sizes.withColumn("weight", F.array(*map(F.lit, weights))[place % len(weights)]).withColumn(
        "cap", F.col("source_size") * most
    )
    stopping = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before = stopping.rowsBetween(Window.unboundedPreceding, -1)
    onward = stopping.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    levelled = weighed.withColumn("level", level)
    free = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "source_key", "level"))).over(everything)
    return levelled.withColumn("level", first["level"]).select(
        "source_key", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    most: int = 3,
) -> DataFrame:
    """Per row: ``keep``, size, source_size, target and the words ``taken`` by the mix.

    Rows of a source stand in the order of a hash of their key, cut into ranges of that hash
    so that no source, however large, meets in one task; running sums inside a range start
    from the sums of the ranges before. A source gives whole epochs while its budget, the
    target without its fraction, exceeds its size, and the last epoch is cut at the budget.

    NULL is a source of its own after all others. NULL keys and repeated keys are hashed as
    they are and ordered by size and text; equal rows are interchangeable. A source without
    words has target 0, an empty table gives an empty result, other columns are ignored.
    """
    digits = max(1, math.ceil(math.log(max(docs.count(), 1) / RANGE_ROWS, 16)))
    hashed = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    named = F.when(F.col(source).isNull(), "null").otherwise(F.concat(F.lit("is "), F.col(source)))  # "is" < "null"
    rows = docs.select(
        *keep,
        named.alias("source_key"),
        word_count(text).alias("size"),
        hashed.alias("hash_key"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.substring(hashed, 1, digits).alias("hash_range"),
    )
    scratch = Scratch.of(docs.sparkSession)
    sums = scratch.keep(rows.groupBy("source_key", "hash_range").agg(F.sum("size").alias("range_size")), "range-sums")
    sizes = sums.groupBy("source_key").agg(F.sum("range_size").alias("source_size"))
    earlier = Window.partitionBy("source_key").orderBy("hash_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.select(
        "source_key", "hash_range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start")
    ).join(source_targets(sizes, weights, most), "source_key")
    ranges = scratch.keep(ranges, "ranges")
    inside = (
        Window.partitionBy("source_key", "hash_range")
        .orderBy("hash_key", "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    budget, whole = F.floor("target"), F.greatest("source_size", F.lit(1))
    epochs = F.floor(budget / whole)
    left = budget - epochs * whole - F.col("range_start") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", left))
    return rows.join(ranges, ["source_key", "hash_range"]).select(
        *keep, "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )
