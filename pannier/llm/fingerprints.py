"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the hash: a prime below 2**31, so that products fit in 64 bits, and two bases.
PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN, SKETCH = 16, 48


class Powers:
    """Powers of a base and of its inverse modulo the prime, extended by doubling."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) <= n:
            step = pow(self.base, len(self.up), PRIME)
            self.up = np.concatenate([self.up, self.up * np.uint64(step) % PRIME])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(step, -1, PRIME)) % PRIME])
        return self.up, self.down


class PrefixHash:
    """Prefix arrays of a text; any two spans, of one text or two, compare in constant time."""

    powers = [Powers(base) for base in BASES]

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n, self.prefix = len(codes), []
        for powers in self.powers:
            terms = codes * powers.upto(self.n)[0][: self.n] % PRIME
            self.prefix.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % PRIME]))

    def span(self, start, end):
        """62-bit hashes of spans ``[start, end)``; both may be arrays."""
        parts = []
        for prefix, powers in zip(self.prefix, self.powers):
            parts.append((prefix[end] + np.uint64(PRIME) - prefix[start]) % PRIME * powers.upto(self.n)[1][start] % PRIME)
        return parts[0] << np.uint64(31) | parts[1]

    def extension(self, at: int, other: "PrefixHash", there: int) -> int:
        """Length of the longest common extension of two positions, by doubling and binary search."""
        most, low, step = min(self.n - at, other.n - there), 0, 1

        def same(length: int) -> bool:
            return bool(self.span(at, at + length) == other.span(there, there + length))

        while low + step <= most and same(low + step):
            low, step = low + step, 2 * step
        high = min(low + step - 1, most)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if same(middle) else (low, middle - 1)
        return low


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection that makes low hashes a fair choice of spans."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Fingerprint:
    """Length, hash of the whole text, and the lowest distinct hashes of its spans."""

    def __init__(self, text: str):
        hashed = PrefixHash(text)
        n, size = hashed.n, min(SPAN, hashed.n)
        starts = slice(0, n - size + 1), slice(size, n + 1)
        spans = _mixed(hashed.span(*starts)) >> np.uint64(32) if n else np.empty(0, np.uint64)
        few = 4 * SKETCH
        if n > 4 * few:  # nearly always enough; equal spans may use up the lowest few
            low = np.unique(np.partition(spans, few)[:few])
            spans = low if len(low) >= SKETCH else spans
        self.n, self.low, self.hashed = n, np.unique(spans)[:SKETCH], hashed
        self.text = f"{n:x}-{int(hashed.span(0, n)):016x}-" + self.low.astype(">u4").tobytes().hex()

    def likeness(self, other: "Fingerprint") -> float:
        """Estimated share of common spans; 1 for two empty texts, 0 for one."""
        if not self.n or not other.n:
            return float(self.n == other.n)
        lowest = np.union1d(self.low, other.low)[:SKETCH]
        return float((np.isin(lowest, self.low) & np.isin(lowest, other.low)).mean())


def _compare(key_type: pa.DataType, names: list[str]):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (range, whether a guest, key, text, fingerprint)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = []
                columns = batch.slice(at, 512).to_pydict()
                for of, guest, key, text in zip(columns["of"], columns["guest"], columns["key"], columns["text"]):
                    if last and last[0] == of and last[1]:
                        continue  # a second copy of the guest
                    mark = Fingerprint(text)
                    if last and last[0] == of:
                        _, _, before, own, own_mark = last
                        half = len(own) // 2
                        edited = own[: len(own) - half] + text[:half]
                        changed = Fingerprint(edited)
                        digest = hashlib.sha256(edited.encode()).hexdigest()
                        common = own_mark.hashed.extension(0, mark.hashed, 0)
                        likeness = own_mark.likeness(changed), own_mark.likeness(mark)
                        rows.append((before, len(own), digest, own_mark.text, changed.text, *likeness, common))
                    last = (of, guest, key, text, mark)
                types = [key_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
                values = list(zip(*rows)) or [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    return compare


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit by the next document's start.

    ``common_start`` is how many code points the text and the next document's have in common at
    their starts, the longest common extension of both.

    The next document is that of the next key, and the first after the last. Rows are dealt
    into ranges of the key; a range also gets, as a guest, the first document of the range
    after it, so no order over all rows is built in one place.

    NULL texts are empty. NULL keys come first; rows with equal keys are ordered by a digest
    of their text, and equal rows follow each other. A single document is its own next one,
    an empty table gives an empty result, and other columns are ignored. The key is a number.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(sorted(set(rows.approxQuantile("key", [at / parts for at in range(1, parts)], 0.25 / parts))))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, keys.astype("float64").to_numpy(), side="right")
        return pd.Series(np.where(keys.isna(), 0, found).astype("int32"))

    order = F.struct(F.col("key").isNotNull(), "key", F.md5("text"))
    placed = rows.withColumn("of", range_of("key"))
    first = sorted(r for r in placed.groupBy("of").agg(F.min(order).alias("first")).collect())
    guests = [(first[at - 1][0], *row[1]) for at, row in enumerate(first)]  # a row per range, to the range before
    key_type = rows.schema["key"].dataType.simpleString()
    small = spark.createDataFrame(guests, f"of int, known boolean, guest_key {key_type}, digest string")
    visiting = rows.join(
        F.broadcast(small), F.col("key").eqNullSafe(F.col("guest_key")) & (F.md5("text") == F.col("digest"))
    ).select("key", "text", "of", F.lit(True).alias("guest"))
    dealt = placed.withColumn("guest", F.lit(False)).unionByName(visiting).repartition("of")
    ordered = dealt.sortWithinPartitions("of", "guest", F.asc_nulls_first("key"), F.md5("text"))
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_start"]
    kinds = [key_type, "bigint", "string", "string", "string", "double", "double", "bigint"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}[key_type]
    return ordered.select("of", "guest", "key", "text").mapInArrow(
        _compare(arrow, names), ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))
    )
