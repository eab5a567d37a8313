"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks join strategies from measured sizes and splits skewed join partitions. Without
# the co-partition setting a join on (order, product) would shuffle rows again that already
# lie together by order. With concurrent writers a task writes the few split folders side
# by side instead of sorting its rows by split first.
SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    Shuffle partitions stay as chosen unless they would leave cores idle, as Spark's
    default of 200 does on a large cluster. Scans and merged partitions make several
    tasks a core: with about one a core, which is Spark's aim, a last task runs alone.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    for key in ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum"):
        spark.conf.set(key, str(3 * cores))
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < cores:
        spark.conf.set("spark.sql.shuffle.partitions", str(3 * cores))
    return spark


def local_session(cpus: int = 8, memory: str = "8g", app: str = "pannier") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
