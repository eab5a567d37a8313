"""The training-data pipeline: five stages from documents to packed sequences.

Each stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pannier.llm.jaccard import near_duplicates
from pannier.llm.langid import identify, train
from pannier.llm.mixing import mix
from pannier.llm.packing import pack
from pannier.llm.passages import remove_repeats
from pannier.llm.queries import TOKENIZERS, prepare
from pannier.sources.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language: those without a letter, empty or NULL are rejected.

    No least score rejects others, as most documents of the lowest scores are of good quality. Rows without key, label or source, and repeated rows, stay as they are.
    """
    prepare(spark)
    return identify(docs, train(docs), COLUMNS).filter(F.col("lang_pred") != "und").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that of the smallest doc_id.

    Of a group's rows that repeat this doc_id, that of the least digest of all columns is kept.
    Groups are told apart by their texts, not by doc_id. Documents without words, and groups
    without any doc_id, stay as they are.
    """
    prepare(spark)
    scratch = Scratch.of(spark)
    marked = docs.select(*COLUMNS, F.unhex(F.md5(F.to_json(F.struct(*COLUMNS)))).alias("_row"))
    found = scratch.keep(near_duplicates(marked.select("doc_id", "text", "_row"), ["doc_id", "_row"], group="_group"), "groups")
    grouped = (F.col("n_shingles") > 0) & F.col("component_id").isNotNull()
    smallest = found.filter(grouped & (F.col("doc_id") == F.col("component_id")))
    first = smallest.groupBy("_group", "_row").count().groupBy("_group").agg(F.min(F.struct("_row", "count")).alias("first"))
    free = found.filter(~grouped).select("_row").distinct().withColumn("count", F.lit(1).cast("bigint"))
    kept = scratch.keep(first.select("first.*").unionByName(free), "kept-rows")
    # Texts are read again and moved once; equal rows of a group, which are rare, once more to keep one of them.
    alone = marked.join(kept.filter("count = 1"), "_row", "left_semi")
    equal = marked.join(kept.filter("count > 1"), "_row", "left_semi").dropDuplicates(["_row"])
    return alone.unionByName(equal).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of every text; documents of which nothing is left go.

    NULL and empty texts, and those shorter than a passage, stay; equal rows cut each other.
    """
    prepare(spark)
    cut = remove_repeats(docs, ["doc_id", "lang", "source"]).withColumnRenamed("kept_text", "text")
    kept = cut.filter((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it; the one that a source's budget cuts stays whole.

    A NULL source is a source of its own; documents without words are not taken.
    """
    prepare(spark)
    mixed = mix(docs, COLUMNS)
    times = F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    copies = mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times)))
    return copies.select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what the mix holds into sequences of 2048 tokens; a NULL or empty text is its end id alone."""
    prepare(spark)
    return pack(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packing", packing),
]

# Networks, suffix order and tokenizers have no SQL; tests/llm/test_pipeline_stages.py and
# test_jaccard_sets.py hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = Scratch.of(spark).keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
