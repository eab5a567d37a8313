"""Texts of an Arrow batch as byte arrays: spans of words or lines and their hashes."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

# Fixed values of the hashes: an odd factor and the seed of the table of bytes.
FACTOR, SEED = 0x9E3779B97F4A7C15, 20_240_229
_TABLE = np.random.default_rng(SEED).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text starts, with the end of the last."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, rows: int = 512, size: int = 4 << 20):
    """Parts of a batch with at most so many rows and, but for a single longer text, so many bytes."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class SpanHash:
    """64-bit hashes of spans of a byte array from one prefix array of a polynomial in a fixed factor."""

    _up, _down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def _powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._up) <= n:
            steps = np.full(2 * n, FACTOR, np.uint64)
            steps[0] = 1
            cls._up = np.multiply.accumulate(steps)
            steps[1:] = pow(FACTOR, -1, 1 << 64)
            cls._down = np.multiply.accumulate(steps)
        return cls._up, cls._down

    def __init__(self, data: np.ndarray):
        up, self.down = self._powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], out=self.prefix[1:])

    def raw(self, starts, ends) -> np.ndarray:
        return (self.prefix[ends] - self.prefix[starts]) * self.down[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the spans; their lengths are part of them."""
        return mixed(self.raw(starts, ends) + (ends - starts).astype(np.uint64))


def words_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The words at these spans, which ascend and do not touch, with a number for each different one."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    letters = np.ascontiguousarray(data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)])
    limits = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(limits), pa.py_buffer(letters)])
    return words.dictionary_encode()


def word_hashes(words: pa.DictionaryArray) -> np.ndarray:
    """64 bits of a cryptographic hash of every word, computed once for each different one."""
    different = b"".join(blake2b(word, digest_size=8).digest() for word in words.dictionary.to_pylist())
    return np.frombuffer(different, "<u8")[words.indices.to_numpy()]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross texts: starts, ends and each run's text."""
    n = len(inside)
    if not n:
        return (np.empty(0, np.int64),) * 3
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def distinct_per_text(of: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """Number of distinct hashes of each text."""
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(of[new], minlength=texts)
