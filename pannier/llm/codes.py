"""Vector code compression: product codebooks fitted by exact integer k-means over Hilbert-sorted blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK = 64  # points of a block
LARGEST = 1 << 26  # of an integer component, so that sums of squares stay exact in 64 bits

Book = np.ndarray  # parts x entries x components, 64-bit integers


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Places of points along a Hilbert curve through the grid between their least and greatest components.

    Coordinates have as many bits as 63 hold together; of more than 63, the first 63 count.
    The transposed index is found bit by bit: from the highest down, a coordinate's bit tells
    whether lower bits of the first are reversed or exchanged with its own; then Gray decoding.
    """
    n, dims = len(points), min(points.shape[1], 63)
    if not n or not dims:
        return np.zeros(n, np.int64)
    bits = min(63 // dims, 31)
    low = points[:, :dims].min(axis=0).astype(np.int64)
    span = np.maximum(points[:, :dims].max(axis=0) - low, 1)
    x = ((points[:, :dims] - low) * ((1 << bits) - 1) // span).T.copy()
    for bit in range(bits - 1, 0, -1):
        lower = (1 << bit) - 1
        for k in range(dims):
            high = (x[k] >> bit & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[k]) & lower)
            x[0] ^= np.where(high, lower, swap)
            x[k] ^= swap
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    turn = np.zeros(n, np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    keys = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(dims):
            keys = keys << 1 | x[k] >> bit & 1
    return keys


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries can be the nearest of a point of each box: blocks x entries.

    An entry is out if its least distance to the box is above the least of the entries'
    greatest distances. Ties stay, as the lower number wins among them.
    """
    below, above = low[:, None] - entries[None], entries[None] - high[:, None]
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(np.abs(below), np.abs(above))
    least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
    return least <= most.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of, and squared distance to, the nearest entry of points that lie in blocks of ``BLOCK``."""
    listed = shortlists(low, high, entries)
    best = np.full(len(points), np.iinfo(np.int64).max)
    at = np.zeros(len(points), np.int64)
    for e, entry in enumerate(entries):
        asked = np.flatnonzero(np.repeat(listed[:, e], BLOCK)[: len(points)])
        away = points[asked] - entry
        distance = (away * away).sum(axis=1)
        closer = distance < best[asked]
        best[asked[closer]], at[asked[closer]] = distance[closer], e
    return at, best


def _sums(points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and sums of each entry's points. A block with one entry on its list gives its own sums."""
    listed = shortlists(low, high, entries)
    sizes = np.minimum(BLOCK, len(points) - BLOCK * np.arange(len(low)))
    alone = listed.sum(axis=1) == 1
    count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    owner = listed.argmax(axis=1)
    np.add.at(count, owner[alone], sizes[alone])
    np.add.at(total, owner[alone], sums[alone])
    rest = np.repeat(~alone, BLOCK)[: len(points)]
    if rest.any():
        # The blocks left, as if they lay in a row: only the very last may be short.
        at, _ = nearest(points[rest], low[~alone], high[~alone], entries)
        left = points[rest]
        for e in range(len(entries)):
            mine = left[at == e]
            count[e] += len(mine)
            total[e] += mine.sum(axis=0)
    return count, total


def _blocks(keep: list[str], parts: int):
    """A row for each batch: ``keep`` as lists, and for each part its points in order of the curve, with boxes and sums."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            lists = batch.column("_vector")
            lengths = np.diff(lists.offsets.to_numpy())
            if (lengths != lengths[0]).any() or lengths[0] % parts:
                raise ValueError(f"vectors must have one length, a multiple of {parts}; found {sorted(set(lengths.tolist()))[:3]}")
            numbers = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            if len(numbers) and np.abs(numbers).max() > LARGEST:
                raise ValueError(f"components must be below {LARGEST // SCALE} in size")
            vectors = numbers.astype(np.int64).reshape(n, parts, -1)
            cut = np.arange(0, n, BLOCK)
            out: list[list[bytes]] = [[] for _ in range(5)]
            for part in range(parts):
                points = vectors[:, part]
                order = np.argsort(hilbert_keys(points), kind="stable")
                points = points[order]
                boxes = [f.reduceat(points, cut, axis=0) if points.shape[1] else points[cut] for f in (np.minimum, np.maximum, np.add)]
                for held, value, kind in zip(out, (order, points, *boxes), ("<i4", "<i4", "<i4", "<i4", "<i8")):
                    held.append(np.ascontiguousarray(value.astype(kind)).tobytes())
            whole = pa.array(np.array([0, n], np.int32))
            columns = [pa.ListArray.from_arrays(whole, batch.column(k)) for k in keep]
            columns += [pa.array([n], pa.int64()), *(pa.array([held], pa.list_(pa.binary())) for held in out)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_n", *BLOCKS])

    return blocks


BLOCKS = ["_order", "_points", "_low", "_high", "_sums"]


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[tuple[np.ndarray, ...]]]]:
    """Row number, vectors, and (order, points, low, high, sums) of each part, of every row of blocks."""
    for row in range(batch.num_rows):
        n = batch.column("_n")[row].as_py()
        held = zip(*(batch.column(c)[row].as_py() for c in BLOCKS))
        found = []
        for raw in held:
            order, *rest = (np.frombuffer(x, "<i8" if c == "_sums" else "<i4").astype(np.int64) for x, c in zip(raw, BLOCKS))
            found.append((order, rest[0].reshape(n, -1), *(x.reshape(-(-n // BLOCK), -1) for x in rest[1:])))
        yield row, n, found


def _round(book: Book):
    """Per task: count and sums of every entry that any of its parts is nearest to."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(book.shape[:2], np.int64), np.zeros(book.shape, np.int64)
        for batch in batches:
            for _, _, found in _read(batch):
                for part, (_, points, low, high, sums) in enumerate(found):
                    c, t = _sums(points, low, high, sums, book[part])
                    count[part] += c
                    total[part] += t
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame({"part": part, "entry": entry, "n": count[part, entry], "sums": list(total[part, entry])}),
            schema=pa.schema([(c, pa.int64()) for c in ("part", "entry", "n")] + [("sums", pa.list_(pa.int64()))]),
            preserve_index=False,
        )

    return partial


def _codes(book: Book, keep: list[str]):
    """Every vector's ``keep``, code and error."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, found in _read(batch):
                code, error = np.zeros((n, len(book)), np.uint8), np.zeros(n, np.int64)
                for part, (order, points, low, high, _) in enumerate(found):
                    at, distance = nearest(points, low, high, book[part])
                    code[order, part] = at
                    error[order] += distance
                digits = code.tobytes().hex().encode()
                limits = np.arange(n + 1, dtype=np.int32) * (2 * len(book))
                texts = pa.StringArray.from_buffers(n, pa.py_buffer(limits), pa.py_buffer(digits))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k)[row].values for k in keep), texts, pa.array(error)], [*keep, "code", "error"]
                )

    return codes


def compress(
    vectors: DataFrame,
    keep: list[str],
    key: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Book]:
    """``keep``, code and error of every vector, and the codebooks: parts x entries x components.

    Components become floor(4096 x), and vectors are cut into ``parts`` equal parts. The
    codebook of a part position starts as that part of the vectors with the ``entries`` smallest
    keys. A round gives every part to its nearest entry (squared distance, ties to the lower
    number) and moves each entry to the componentwise floor of its parts' mean; unused entries
    stay. A code has two hex digits, the entry's number, for each part; the error is the sum of
    the parts' squared distances.

    The vectors are read once. Each Arrow batch of them, at most ``maxRecordsPerBatch`` rows,
    becomes flat blocks: for every part position, its points in Hilbert order, cut into blocks
    of ``BLOCK`` with their box and sums. A round shortlists entries for each block by the
    distances of its box. Where one is left, the block's sums are taken as they are; else the
    exact distances to the listed entries only are computed. All is in integers, so neither the
    order of rows nor their partitions matter. Tasks send one count and sum for each entry, and
    only the codebooks, parts x entries numbers, pass through the driver.

    Vectors that are NULL, or hold NULLs or numbers that are not finite, take no part. NULL keys
    come last among keys, equal keys in the order of their vectors; repeated rows count each.
    With fewer vectors than entries there are as many entries; an empty table gives an empty
    result and empty codebooks. Vectors of different lengths, or of one that ``parts`` does not
    divide, and components of 16384 or more raise an error. Other columns are ignored.
    """
    spark, scratch = vectors.sparkSession, Scratch.of(vectors.sparkSession)

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    rows = vectors.filter(F.col(vector).isNotNull() & ~F.exists(vector, bad))
    first = rows.orderBy(F.col(key).asc_nulls_last(), vector).select(F.col(vector).alias("v")).limit(entries).collect()
    numbers = [[int(np.floor(SCALE * float(x))) for x in r["v"]] for r in first]
    if len({len(v) for v in numbers}) > 1 or numbers and len(numbers[0]) % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    book = np.array(numbers, np.int64).reshape(len(numbers), parts, -1).transpose(1, 0, 2) if numbers else np.zeros((parts, 0, 0), np.int64)

    rows = rows.select(*keep, F.col(vector).alias("_vector"))
    types = {k: rows.schema[k].dataType.simpleString() for k in keep}
    lists = ", ".join(f"`{k}` array<{t}>" for k, t in types.items())
    held = ", ".join(f"{c} array<binary>" for c in BLOCKS)
    blocks = scratch.keep(rows.mapInArrow(_blocks(keep, parts), f"{lists}, _n bigint, {held}"), "blocks")
    points = blocks.select("_n", *BLOCKS)
    for _ in range(rounds if numbers else 0):
        sums = points.mapInArrow(_round(book), "part bigint, entry bigint, n bigint, sums array<bigint>")
        apart = sums.select("part", "entry", "n", F.posexplode("sums").alias("place", "sum"))
        exact = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
        book = book.copy()
        for r in apart.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), exact).collect():
            book[r["part"], r["entry"], r["place"]] = int(r["sum"]) // r["n"]
    kinds = ", ".join(f"`{k}` {t}" for k, t in types.items())
    return blocks.mapInArrow(_codes(book, keep), f"{kinds}, code string, error bigint"), book


def digest(book: Book) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame, label: str) -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels; NULLs are one label."""
    coded = Scratch.of(coded.sparkSession).keep(coded, "coded")
    sums = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
