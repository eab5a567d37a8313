"""Where rows lie."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows by ``keys`` into ``spark.sql.shuffle.partitions`` partitions.

    For rows that multiply later on: with the number given, AQE does not merge
    partitions that are small only as long as they have not been expanded.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
