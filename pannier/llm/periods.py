"""Runs of periodic words, found online on sparse diagonals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.llm.arrays import IS_SPACE, runs, slices, text_bytes, words_array

LEAST, TIMES = 6, 4  # a run has at least so many words, and its period so many times
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, top struct<start:bigint,length:bigint,period:bigint>, collapsed string"


def _repeated(keys: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of equal keys at their places (-1: none or met once), the places met again, and how far before."""
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    again = np.zeros(len(keys) + 1, bool)
    again[1:-1] = keys[1:] == keys[:-1]
    kept = again[:-1] | again[1:]
    rank = np.full(n, -1, np.int64)
    rank[places[kept]] = np.cumsum(~again[:-1])[kept]
    later = np.flatnonzero(again[:-1])
    return rank, places[later], places[later] - places[later - 1]


def earlier_occurrences(codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse diagonal matches (place, lag, words compared), by place, of the words of all texts in a row.

    Lags fall into classes from a power of two to the next. A run whose period is in a class
    repeats, at this lag, every stretch of as many words as the next power of two; and the last
    place before where such a stretch of it begins again is just one period back, as two periods
    would otherwise have a common divisor that is one too. So each word has at most one earlier
    occurrence in a class, and what a text has only once is out of all longer stretches.
    """
    n = len(codes)
    rank, _, _ = _repeated(of * (int(codes.max(initial=0)) + 1) + codes, np.arange(n), n)
    found, size = [], 1
    while True:  # stretches of ``size`` words become twice as long; lags are from the old size to below the new
        places = np.flatnonzero(rank >= 0)
        places = places[places + size < n]
        places = places[(rank[places + size] >= 0) & (of[places] == of[places + size])]
        if not len(places):
            break
        rank, later, lag = _repeated(rank[places] * (int(rank.max()) + 1) + rank[places + size], places, n)
        near = (lag >= size) & (lag < 2 * size)
        found.append((later[near], lag[near], np.full(int(near.sum()), 2 * size)))
        size *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    place, lag, width = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(place, kind="stable")
    return place[order], lag[order], width[order]


def emitted(places: Sequence[int], lags: Sequence[int], widths: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """Runs (start, length, period), each as soon as its diagonal ends.

    Word by word, an earlier occurrence adds one to the match length of its lag; lags that the
    next word does not match are over.
    """
    active: dict[int, tuple[int, int]] = {}
    now: dict[int, tuple[int, int]] = {}
    at = -1

    def over(diagonals: dict[int, tuple[int, int]], last: int) -> Iterator[tuple[int, int, int]]:
        for lag, (matches, width) in diagonals.items():
            length = matches + width - 1 + lag
            if length >= max(LEAST, TIMES * lag):
                yield last - matches + 1 - lag, length, lag

    for place, lag, width in zip(places, lags, widths):
        if place != at:
            yield from over(active, at - 1)
            active, now = now, {}
            if place != at + 1:
                yield from over(active, at)
                active = {}
            at = place
        now[lag] = (active.pop(lag, (0, width))[0] + 1, width)
    yield from over(active, at - 1)
    yield from over(now, at)


def _longest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length per period, compared exactly; ties go to the first start, then period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _periodic(keep: list[str]):
    def periodic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                n = part.num_rows
                data, offsets = text_bytes(part.column("_text"))
                starts, ends, of = runs(~IS_SPACE[data], offsets)
                counts = np.bincount(of, minlength=n)
                first = np.cumsum(counts) - counts
                codes = words_array(data, starts, ends).indices.to_numpy().astype(np.int64)
                matches = earlier_occurrences(codes, of)
                by_text: dict[int, list[tuple[int, int, int]]] = {}
                dropped = np.zeros(len(starts) + 1, np.int64)
                for start, length, period in emitted(*(m.tolist() for m in matches)):
                    text = int(of[start])
                    by_text.setdefault(text, []).append((start - int(first[text]), length, period))
                    dropped[start + period] += 1
                    dropped[start + length] -= 1
                # Bytes of the words left, each but a text's last with the byte after it as a space.
                left = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
                last = np.ones(len(left), bool)
                last[:-1] = of[left[1:]] != of[left[:-1]]
                mask = np.zeros(len(data) + 1, np.int8)
                mask[starts[left]] = 1
                mask[ends[left]] -= 1
                mask = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
                spaced = data.copy()
                spaces = ends[left[~last]]
                spaced[spaces], mask[spaces] = 32, True
                letters = np.ascontiguousarray(spaced[mask])
                limits = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask, dtype=np.int64)])[offsets]
                collapsed = pa.LargeStringArray.from_buffers(n, pa.py_buffer(limits), pa.py_buffer(letters))
                found = [sorted(by_text.get(t, []), key=lambda run: (run[0], run[2])) for t in range(n)]
                tops = [_longest(f) for f in found]

                def structs(rows: list) -> list:
                    return [None if r is None else dict(zip(("start", "length", "period"), r)) for r in rows]

                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(k) for k in keep),
                        pa.array(counts, pa.int64()),
                        pa.array([structs(f) for f in found], pa.list_(RUN)),
                        pa.array(structs(tops), RUN),
                        collapsed.cast(pa.string()),
                    ],
                    [*keep, "n_words", "runs", "top", "collapsed"],
                )

    return periodic


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, n_words, the runs of periodic words, the longest of them by its period, and the text without them.

    Words are runs of bytes other than ASCII white space, numbered from 0. A run is a stretch of
    at least ``LEAST`` words and ``TIMES`` its smallest period that no neighbour extends. Runs
    are sorted by start, then period; ``top`` has the greatest length by period, ties to the
    first. ``collapsed`` has the words that no run holds after its first period, joined by one
    space. All words and lags of a text are compared, whatever its length: time and memory
    grow as its words times the logarithm of the longest period.

    NULL and empty texts have no words, an empty list of runs, no ``top`` and an empty text.
    Repeated rows and keys are rows of their own, NULLs in ``keep`` stay, other columns are
    ignored, and an empty table gives an empty result. Every row is found in its own task; there
    is no shuffle, so a lost executor costs its tasks only.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in keep)
    return rows.mapInArrow(_periodic(keep), f"{kinds}, {FOUND}")
