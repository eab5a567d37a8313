"""Token counts through a cache of digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pannier.llm.arrays import slices
from pannier.llm.tokens import counter
from pannier.sources.scratch import exists

CACHE = "tokenizer string, digest binary, n_tokens bigint"


def normalised(text: str) -> Column:
    """The text with runs of ASCII white space as one space; NULL is empty.

    Every tokenizer that drops white space counts it as it counts the text itself. Case
    stays, as special strings are told apart by it.
    """
    return F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\r]+", " "))


def tokenizer_version(path: str) -> str:
    """A digest of the tokenizer file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in batches:
            for part in slices(batch, "text"):
                found = counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    return encode


def refresh_cache(docs: DataFrame, tokenizer_path: str, cache: str, text: str = "text") -> DataFrame:
    """Append the counts of all texts that the cache lacks, and return the tokenizer's part of it.

    The cache is a Parquet folder in a shared store, partitioned by tokenizer version. Equal
    contents fold inside each task before they are shuffled, so a text that a third of the
    rows share arrives once per task; only distinct misses are encoded.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer_path)
    contents = (
        docs.select(normalised(text).alias("text"))
        .select(F.unhex(F.sha2("text", 256)).alias("digest"), "text")
        .dropDuplicates(["digest"])
    )
    if exists(spark, cache):
        stored = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
        contents = contents.join(stored.select("digest"), "digest", "left_anti")
    counted = contents.mapInArrow(_encode(tokenizer_path), "digest binary, n_tokens bigint")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    known = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return known.select("digest", "n_tokens")


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache: str, keep: Sequence[str] = ("doc_id",), text: str = "text", limit: int = 2048
) -> DataFrame:
    """Per row of ``docs``: ``keep``, n_bytes, n_tokens and whether the tokens exceed ``limit``.

    NULL and empty texts have 0 bytes and 0 tokens. Repeated rows and rows without an id are
    counted each; other columns are ignored, and an empty table gives an empty result.
    Appends by two jobs at once may store a digest twice; such rows are folded.
    """
    known = refresh_cache(docs, tokenizer_path, cache, text).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = docs.select(
        *keep,
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
    )
    counted = rows.join(known, "digest", "left").drop("digest")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
