"""Removal of repeated passages by prefix-free parsing and suffix order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.llm.arrays import SpanHash, mixed, slices, text_bytes
from pannier.sources.scratch import Scratch

LENGTH, TRIGGER = 200, 40  # bytes of a repeated string and of a trigger
WINDOW = LENGTH - TRIGGER + 1  # triggers that a string holds
GROUP = 20_000  # phrases of one trigger that are ordered in one piece
_LOW32 = np.uint64((1 << 32) - 1)


def phrases(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Cut texts into phrases at triggers.

    The trigger of a string of ``LENGTH`` bytes is the substring of ``TRIGGER`` bytes with the
    least rolling hash, the first of equals; it depends on the string alone, so equal strings
    have equal triggers at equal places. A phrase is what the strings with the same trigger
    cover: strings starting from ``low`` to ``low + n - 1``, the trigger at ``low + lead``.
    """
    if len(data) < LENGTH:
        return {name: np.empty(0, np.int64) for name in ("doc", "low", "n", "lead", "trigger", "phrase")}
    hashed = SpanHash(data)
    at = np.arange(len(data) - TRIGGER + 1)
    rolling = mixed(hashed.raw(at, at + TRIGGER))
    order = rolling & ~_LOW32 | at.astype(np.uint64)
    padded = np.concatenate([order, np.full(-len(order) % WINDOW, ~np.uint64(0))]).reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(len(data) - LENGTH + 1)
    least = (np.minimum(behind[start], ahead[start + WINDOW - 1]) & _LOW32).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(start)]
    inside = start + LENGTH <= offsets[1:][doc]
    start, least, doc = start[inside], least[inside], doc[inside]
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate([first, [len(start)]]))
    low, place = start[first], least[first]
    content = mixed(hashed.of(low, low + n - 1 + LENGTH) + (place - low).astype(np.uint64))
    return {"doc": doc[first], "low": low, "n": n, "lead": place - low, "trigger": rolling[place].view(np.int64), "phrase": content.view(np.int64)}


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of every text without their bytes, a row each, at places counted from the text's start."""
    for batch in batches:
        for part in slices(batch, "_text"):
            data, offsets = text_bytes(part.column("_text"))
            found = phrases(data, offsets)
            columns = {
                "row_key": part.column("row_key").take(pa.array(found["doc"])),
                "low": pa.array(found["low"] - offsets[found["doc"]]),
                "n": pa.array(found["n"].astype(np.int32)),
                "lead": pa.array(found["lead"].astype(np.int32)),
                "trigger": pa.array(found["trigger"]),
                "phrase": pa.array(found["phrase"]),
            }
            yield pa.RecordBatch.from_pydict(columns)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the phrases that are wanted of each text."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["trigger", "phrase", "n", "lead", "content"]
    for batch in batches:
        for part in slices(batch, "_text"):
            rows = []
            for text, wanted in zip(part.column("_text").to_pylist(), part.column("wanted").to_pylist()):
                raw = text.encode()
                for w in wanted:
                    content = raw[w["low"] : w["low"] + w["n"] - 1 + LENGTH]
                    rows.append((w["trigger"], w["phrase"], w["n"], w["lead"], content))
            values = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)


def _suffix_classes(rows: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of byte rows inside their groups, and the common prefix of each with the one before it.

    The common prefix is -1 where a group begins.
    """
    order = np.lexsort((np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), groups))
    one, two = order[:-1], order[1:]
    differs = rows[one] != rows[two]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    common = np.minimum(common, np.minimum(lengths[one], lengths[two]))
    return order, np.concatenate([[-1], np.where(groups[one] == groups[two], common, -1)])


def repeated_starts(content: list[bytes], n: np.ndarray, lead: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """For each distinct phrase, which of its strings are in another phrase of its trigger.

    A string is the end of the dictionary's text before the trigger and the start of the text
    from it. Both are put in order, and where neighbours have less in common than a string
    needs on that side, another class begins; strings of equal classes on both sides are equal.
    Returned as (place before the trigger, phrase).
    """
    count = len(content)
    left, right = np.zeros((count, WINDOW), np.uint8), np.zeros((count, LENGTH), np.uint8)
    for k, (text, cut) in enumerate(zip(content, lead)):
        raw = np.frombuffer(text, np.uint8)
        left[k, :cut] = raw[:cut][::-1]
        right[k, : len(raw) - cut] = raw[cut:]
    sizes = n - 1 + LENGTH - lead
    left_order, left_common = _suffix_classes(left, lead, groups)
    right_order, right_common = _suffix_classes(right, sizes, groups)
    found = np.zeros((WINDOW, count), bool)
    left_class, right_class = np.empty(count, np.int64), np.empty(count, np.int64)
    for before in range(int(lead.max()) + 1):
        has = np.flatnonzero((lead >= before) & (lead - n < before))
        if len(has) < 2:
            continue
        left_class[left_order] = np.cumsum(left_common < before)
        right_class[right_order] = np.cumsum(right_common < LENGTH - before)
        both = left_class[has] * (count + 1) + right_class[has]
        _, inverse, times = np.unique(both, return_inverse=True, return_counts=True)
        found[before, has] = times[inverse] > 1
    return found


def _intervals(found: np.ndarray, lead: np.ndarray, phrase: np.ndarray) -> pa.RecordBatch:
    """Runs of true starts as (phrase, first, last), relative to the phrase's first string."""
    edges = np.zeros((found.shape[0] + 2, found.shape[1]), np.int8)
    edges[1:-1] = found
    change = np.diff(edges, axis=0)
    of, begin = np.nonzero(change.T == 1)
    _, end = np.nonzero(change.T == -1)  # places before the trigger, begin to end - 1
    columns = {"phrase": phrase[of], "first": lead[of] - end + 1, "last": lead[of] - begin}
    return pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64)) for k, v in columns.items()})


def _order_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings of phrases sorted by trigger; whole groups are taken together."""
    held: list[pa.Table] = []

    def resolve(rows: pa.Table) -> pa.RecordBatch:
        groups = rows["trigger"].to_numpy()
        n, lead, phrase = (rows[c].to_numpy().astype(np.int64) for c in ("n", "lead", "phrase"))
        return _intervals(repeated_starts(rows["content"].to_pylist(), n, lead, groups), lead, phrase)

    for batch in batches:
        for at in range(0, batch.num_rows, GROUP):
            part = pa.Table.from_batches([batch.slice(at, GROUP)])
            values = part["trigger"].to_numpy()
            if held and held[-1]["trigger"][-1].as_py() != values[0]:
                yield resolve(pa.concat_tables(held))
                held = []
            begun = np.flatnonzero(values != values[-1])
            cut = int(begun[-1]) + 1 if len(begun) else 0
            if cut:
                yield resolve(pa.concat_tables([*held, part.slice(0, cut)]))
                held = []
            held.append(part.slice(cut))
    if held:
        yield resolve(pa.concat_tables(held))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a phrase as a row of its own, named by a hash."""
    for batch in batches:
        for text, n, lead, trigger, phrase in zip(*(batch.column(c).to_pylist() for c in ("content", "n", "lead", "trigger", "phrase"))):
            start = np.arange(n)
            hashed = SpanHash(np.frombuffer(text, np.uint8)).raw(start, start + LENGTH)
            name = mixed(mixed(hashed) + (np.uint64(trigger & (1 << 64) - 1) + (start - lead).astype(np.int64).view(np.uint64)))
            yield pa.RecordBatch.from_pydict(
                {"string": pa.array(name.view(np.int64)), "phrase": pa.array(np.full(n, phrase)), "first": pa.array(start)}
            )


def repeated_spans(rows: DataFrame, group: int = GROUP) -> DataFrame:
    """(row_key, spans) of ``rows(row_key, _text)``: where strings of ``LENGTH`` bytes start that start elsewhere too.

    The parse, phrases by place without their bytes, is written once; triggers are counted in
    it, folding in each task, and a join by trigger keeps the phrases of those met again. A
    phrase met again repeats with all its strings. Different phrases of a trigger enter the
    dictionary: one place of each is read again from its text, and they are compared through
    suffix order; those of a trigger with more than ``group`` phrases are cut into strings
    that are counted one by one, so no group meets in one task. Texts are read twice whatever
    their number, and nothing goes through the driver.
    """
    scratch = Scratch.of(rows.sparkSession)
    schema = "row_key bigint, low bigint, n int, lead int, trigger bigint, phrase bigint"
    parse = scratch.keep(rows.select("row_key", "_text").mapInArrow(_parse, schema), "parse")
    counted = parse.groupBy("trigger").agg(F.count("*").alias("times"), F.min("phrase").alias("x"), F.max("phrase").alias("y"))
    again = counted.filter("times > 1").select("trigger", (F.col("x") != F.col("y")).alias("several"))
    again = scratch.keep(again, "triggers")
    found = scratch.keep(parse.join(again, "trigger"), "phrases")
    scratch.discard(parse, again)

    one = ["trigger", "n", "lead", "row_key", "low"]
    places = found.filter("several").groupBy("phrase").agg(*(F.first(c).alias(c) for c in one))
    wanted = places.groupBy("row_key").agg(F.collect_list(F.struct("trigger", "phrase", "n", "lead", "low")).alias("wanted"))
    wanted = scratch.keep(wanted, "wanted")
    content = rows.select("row_key", "_text").join(wanted, "row_key").select("_text", "wanted")
    content = content.mapInArrow(_contents, "trigger bigint, phrase bigint, n int, lead int, content binary")
    dictionary = scratch.keep(content.dropDuplicates(["phrase"]), "dictionary")  # equal rows give the same phrases
    scratch.discard(wanted)

    times = found.groupBy("phrase").agg(F.count("*").alias("times"), F.first("n").alias("n")).filter("times > 1")
    whole = times.select("phrase", F.lit(0).cast("bigint").alias("first"), (F.col("n") - 1).cast("bigint").alias("last"))
    sizes = dictionary.groupBy("trigger").agg(F.count("*").alias("size")).filter("size > 1")
    sized = dictionary.join(sizes, "trigger")
    small = sized.filter(F.col("size") <= group).drop("size").repartition("trigger").sortWithinPartitions("trigger")
    ordered = small.mapInArrow(_order_phrases, "phrase bigint, first bigint, last bigint")
    strings = sized.filter(F.col("size") > group).drop("size").mapInArrow(_strings, "string bigint, phrase bigint, first bigint")
    strings = scratch.keep(strings, "strings")
    met = strings.groupBy("string").agg(F.count("*").alias("times")).filter("times > 1").select("string")
    single = strings.join(met, "string").select("phrase", "first", F.col("first").alias("last"))

    starts = whole.unionByName(ordered).unionByName(single)
    placed = found.select("row_key", "low", "phrase").join(starts, "phrase")  # equal rows, however many, have one set
    return placed.groupBy("row_key").agg(
        F.collect_set(F.struct((F.col("low") + F.col("first")).alias("a"), (F.col("low") + F.col("last") + LENGTH).alias("b"))).alias("spans")
    )


def _remove(keep: list[str]):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
                for text, spans in zip(part.column("_text").to_pylist(), part.column("spans").to_pylist()):
                    raw = (text or "").encode()
                    pieces, at, runs = [], 0, 0
                    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                        if a > at or not runs:
                            pieces.append(raw[at:a])
                            runs += 1
                        at = max(at, b)
                    pieces.append(raw[at:])
                    kept = b"".join(pieces)
                    out["n_bytes"].append(len(raw))
                    out["n_removed"].append(len(raw) - len(kept))
                    out["n_spans"].append(runs)
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept_text"].append(None if text is None else kept.decode(errors="ignore"))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(v, t) for v, t in zip(out.values(), types)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *columns], [*keep, *out])

    return remove


def remove_repeats(
    docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", group: int = GROUP
) -> DataFrame:
    """``keep``, n_bytes, n_removed, n_spans, kept_sha256 and kept_text of every document.

    Removed is every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
    else in the table, the same document included; matches never cross documents. ``kept_text``
    leaves out what a cut has left of a character.

    NULL texts are empty, and texts shorter than a string keep all. Equal rows and equal texts
    repeat each other. NULL keys are keys like others, other columns are ignored, and an
    empty table gives an empty result.
    """
    rows = docs.select(*keep, F.xxhash64(F.col(key), F.col(text)).alias("row_key"), F.col(text).alias("_text"))
    spans = repeated_spans(rows.select("row_key", "_text"), group)
    joined = rows.join(spans, "row_key", "left").drop("row_key")
    kinds = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep]
    schema = ", ".join([*kinds, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"])
    return joined.mapInArrow(_remove(keep), schema)
