"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pannier.llm import codes, quality
from pannier.llm.contamination import decontaminate
from pannier.llm.fingerprints import fingerprints
from pannier.llm.jaccard import near_duplicates
from pannier.llm.langid import held_out, identify, train
from pannier.llm.licenses import scan_with_inheritance
from pannier.llm.mixing import mix
from pannier.llm.packing import pack
from pannier.llm.passages import remove_repeats
from pannier.llm.periods import periodic_runs
from pannier.llm.token_counts import token_counts
from pannier.llm.topk import top_k
from pannier.sources.scratch import Scratch, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZERS = os.environ.get("PANNIER_TOKENIZERS") or os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))


def prepare(spark: SparkSession) -> None:
    """Let a finished query's shuffle files go at once; operators write what they need again."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out("doc_id").alias("held_out"))
    measured = Scratch.of(spark).keep(quality.statistics(docs, ["doc_id", "held_out"]), "statistics")
    model = quality.train(measured, table(spark, folder, "labels"), ~F.col("held_out"))
    return quality.classify(measured, model, ["doc_id", "held_out"])


@query
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), ["doc_id"]).drop("kept_text")


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as files at their address; a page at a directory's address is that directory's licence file."""
    pages = table(spark, folder, "pages")
    address = F.regexp_replace(F.regexp_replace("url", r"^[A-Za-z]+://", ""), r"[?#].*$", "")
    address = F.when(address.contains("/"), address).otherwise(F.concat(address, F.lit("/")))  # a host alone is its first page
    files = pages.select("page_id", address.alias("path"), F.col("html").alias("text"))
    is_index = F.col("path").endswith("/")
    return scan_with_inheritance(files, is_index, ["page_id"])


@query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), ["doc_id"])


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    marked = docs.select("doc_id", "text", held_out("doc_id").alias("held_out"))
    return identify(marked, train(docs), ["doc_id", "held_out"])


@query
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents"))


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts join a cache that stays in the shared folder, so later runs encode new texts only."""
    cache = f"{shared_folder(spark).rstrip('/')}/pannier-token-cache"
    return token_counts(table(spark, folder, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", cache)


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, book = codes.compress(table(spark, folder, "embeddings"), ["vec_id", "label"])
    coded = codes.label_errors(coded, "label")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(book)).alias("codebooks_sha256"))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of the texts, of which a tenth are first made periodic from some word on."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    g, words = F.floor(h / 10), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    docs = docs.withColumn("words", F.explode(F.array(F.when(h % 10 == 0, words))))
    n = F.size("words")
    a = (g % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")
    edited = docs.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))

    found = periodic_runs(edited, ["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
