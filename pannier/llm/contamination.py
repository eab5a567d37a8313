"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch

WINDOW, GRAM = 10, 6  # words of a window, and of the grams whose hashes are compared
SPAN = WINDOW - GRAM + 1  # grams in a window

# ASCII characters that are not part of a word once A to Z are in lower case.
SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text: runs of lower-case letters, digits and characters beyond ASCII."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.array_remove(F.split(plain, " "), "")


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is evaluated once a row, wherever it is used later."""
    return rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(value)).alias(name))


def stretches(size: int) -> Column:
    """Every stretch of ``size`` of the row's ``words`` as one string, by where it begins."""
    starts = F.sequence(F.lit(1), F.size("words") - (size - 1))
    return F.when(F.size("words") >= size, F.transform(starts, lambda at: F.array_join(F.slice("words", at, size), " ")))


def fingerprints(rows: DataFrame) -> DataFrame:
    """Rows with ``prints``: place and hash of the least gram of each window of ``words``, once while it stays.

    A gram's place modulo 8 stands in the low bits of its hash, so that the place can be told
    from the least value of a window, which spans ``SPAN`` grams, fewer than 8.
    """
    starts = F.sequence(F.lit(0), F.size("words") - GRAM)
    grams = F.transform(
        starts, lambda at: F.shiftleft(F.xxhash64(F.slice("words", at + 1, GRAM)), 3).bitwiseOR(at.bitwiseAND(F.lit(7)).cast("bigint"))
    )
    long = F.size("words") >= WINDOW
    rows = once(rows, "_grams", F.when(long, grams))
    least = F.transform(F.sequence(F.lit(1), F.size("_grams") - (SPAN - 1)), lambda at: F.array_min(F.slice("_grams", at, SPAN)))
    rows = once(rows, "_least", F.when(F.col("_grams").isNotNull(), least)).drop("_grams")

    def found(value: Column, at: Column) -> Column:
        place = at + F.pmod(value.bitwiseAND(F.lit(7).cast("bigint")).cast("int") - at, F.lit(8))
        new = (at == 0) | (value != F.element_at("_least", F.greatest(at, F.lit(1))))
        return F.when(new, F.struct(place.alias("place"), F.shiftright(value, 3).alias("hash")))

    prints = F.filter(F.transform("_least", found), lambda p: p.isNotNull())
    return rows.withColumn("prints", prints).drop("_least")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str], text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``keep``, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    A window is ``WINDOW`` words in a row of an item, or all words of an item of fewer; a word of
    a document inside any occurrence of a window is hit. Winnowing keeps, of the ``SPAN`` grams
    of ``GRAM`` words in each window, the one of the least hash. Equal windows have equal
    grams, so documents keep a gram of every window that they share with an item. Documents'
    kept grams are held against those of the benchmark by a semi-join, which multiplies nothing
    however frequent a gram is; those found are extended to the windows around them, which are
    joined with the benchmark's different windows by their words. Items of fewer words are
    sought at every place, as windows of their number of words.

    All further work is on different texts: copies of a text share their hits, and texts with
    the same windows share their items. Joins carry no hint: what the benchmark gives is
    broadcast where its written table is small, and joined by shuffle where it is not.

    NULL, empty and wordless texts have no words and no hits; so have all documents where the
    benchmark is empty or has no words. Items without an id are hit but not counted or named;
    rows of one id are one item with the windows of all. Repeated documents are rows of their
    own, NULLs in ``keep`` stay, columns of other names are ignored, and an empty table gives an
    empty result.
    """
    scratch = Scratch.of(docs.sparkSession)
    items = once(benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("_text")), "words", words_of(F.col("_text")))
    items = scratch.keep(items.filter(F.size("words") > 0).select("item", "words").distinct(), "items")
    short = sorted(r["n"] for r in items.filter(F.size("words") < WINDOW).select(F.size("words").alias("n")).distinct().collect())
    sizes = [*short, WINDOW]  # at most WINDOW numbers

    windows = items.filter(F.size("words") >= WINDOW).select("item", F.lit(WINDOW).alias("size"), F.explode(stretches(WINDOW)).alias("window"))
    whole = items.filter(F.size("words") < WINDOW).select("item", F.size("words").alias("size"), F.array_join("words", " ").alias("window"))
    windows = scratch.keep(windows.unionByName(whole).distinct(), "windows")
    known = scratch.keep(windows.select("size", "window").distinct(), "known-windows")

    long = once(known.filter(F.col("size") == WINDOW).select("window"), "words", F.split("window", " "))
    hashes = fingerprints(long).select(F.explode("prints").alias("p")).select(F.lit(WINDOW).alias("size"), "p.hash")
    hashes = hashes.unionByName(known.filter(F.col("size") < WINDOW).select("size", F.xxhash64("window").alias("hash")))
    hashes = scratch.keep(hashes.distinct(), "fingerprints")

    named = F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("text_id")
    read = once(docs.select(named, F.col(text).alias("_text")), "words", words_of(F.col("_text"))).drop("_text")
    prints = fingerprints(read.filter(F.size("words") >= WINDOW)).select("text_id", F.lit(WINDOW).alias("size"), F.explode("prints").alias("p"))
    prints = prints.select("text_id", "size", "p.place", "p.hash")
    for size in short:
        every = read.filter(F.size("words") >= size).select("text_id", F.posexplode(stretches(size)).alias("place", "window"))
        prints = prints.unionByName(every.select("text_id", F.lit(size).alias("size"), "place", F.xxhash64("window").alias("hash")))
    met = prints.join(hashes, ["size", "hash"], "left_semi")
    met = scratch.keep(met.groupBy("text_id").agg(F.collect_set(F.struct("place", "size")).alias("met")), "met")  # at most a text's words times sizes

    # Extend: the windows around each gram, and the stretches found for short items themselves.
    held = docs.select(named, F.col(text).alias("_text")).join(met, "text_id")
    held = once(held, "words", words_of(F.col("_text"))).drop("_text")
    ranges = F.transform(
        "met",
        lambda m: F.when(
            m["size"] == WINDOW, F.sequence(F.greatest(m["place"] - (SPAN - 1), F.lit(0)), F.least(m["place"], F.size("words") - WINDOW))
        ).otherwise(F.array(m["place"])),
    )
    starts = F.array_distinct(F.flatten(F.zip_with("met", ranges, lambda m, r: F.transform(r, lambda at: F.struct(at.alias("start"), m["size"].alias("size"))))))
    apart = held.select("text_id", "words", F.explode(starts).alias("s"))
    apart = apart.select("text_id", "s.start", "s.size", F.array_join(F.slice("words", F.col("s.start") + 1, F.col("s.size")), " ").alias("window"))
    occurring = scratch.keep(
        apart.join(known.withColumn("window_id", F.unhex(F.md5("window"))), ["size", "window"]).select("text_id", "start", "size", "window_id").distinct(),
        "occurrences",
    )

    # Words that the stretches of a text cover, and the items of its windows, once for each different set of windows.
    spans = F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end"))))
    per_text = occurring.groupBy("text_id").agg(spans.alias("spans"), F.sort_array(F.collect_set("window_id")).alias("held"))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))

    def cover(so_far: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], so_far["end"]), F.lit(0))
        return F.struct((so_far["n"] + new).alias("n"), F.greatest(so_far["end"], span["end"]).alias("end"))

    n_hit = F.aggregate("spans", start, cover, lambda x: x["n"])
    per_text = scratch.keep(per_text.select("text_id", n_hit.alias("n_hit"), "held", F.md5(F.array_join(F.transform("held", F.hex), "")).alias("set_id")), "hit-texts")
    sets = per_text.groupBy("set_id").agg(F.first("held").alias("held")).select("set_id", F.explode("held").alias("window_id"))
    owners = windows.filter(F.col("item").isNotNull()).select(F.unhex(F.md5("window")).alias("window_id"), "item")
    named_items = sets.join(owners, "window_id").groupBy("set_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    named_items = named_items.select("set_id", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    results = per_text.drop("held").join(named_items, "set_id", "left").drop("set_id")

    rows = once(docs.select(*keep, F.col(text).alias("_text"), named), "n_words", F.size(words_of(F.col("_text"))).cast("bigint")).drop("_text")
    found = rows.join(scratch.keep(results, "results"), "text_id", "left")
    return found.select(
        *keep,
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
