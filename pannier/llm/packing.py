"""Bounded-space online packing of token sequences."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pannier.llm.arrays import slices
from pannier.llm.tokens import batch_encoder
from pannier.sources.scratch import Scratch

PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"
SEQUENCES_PER_TASK = 1 << 32  # sequence ids: task number and number in the task


class Windows:
    """At most ``most`` open windows of ``size`` tokens; ``emit(window, closed)`` gets those that leave."""

    def __init__(self, size: int, most: int, least_cut: int, first: int):
        self.size, self.most, self.least_cut, self.next = size, most, least_cut, first
        self.free: list[tuple[int, int]] = []  # (tokens free, sequence id), ascending: the fullest is first
        self.held: dict[int, list[tuple]] = {}

    def _put(self, at: int | None, piece: tuple) -> list[tuple]:
        """Append a piece to the open window at this place, or to a new one; give its rows if now full."""
        if at is None:
            free, name = self.size, self.next
            self.next += 1
            self.held[name] = []
        else:
            free, name = self.free.pop(at)
        self.held[name].append((*piece, name, self.size - free))
        left = free - piece[2]
        if left == 0:
            return self.held.pop(name)
        insort(self.free, (left, name))
        return []

    def add(self, document, ids: np.ndarray) -> list[tuple]:
        """Place a document's ids and return the rows of windows that are closed by it."""
        rows, at, n = [], 0, len(ids)

        def piece(length: int) -> tuple:
            crc = zlib.crc32(ids[at : at + length].tobytes())
            return document, at, length, crc, n

        while n - at >= self.size:
            rows += self._put(None, piece(self.size))
            at += self.size
        while (need := n - at) > 0:
            fit = bisect_left(self.free, (need, -1))
            if fit < len(self.free):
                return rows + self._put(fit, piece(need))
            if len(self.free) < self.most:
                return rows + self._put(None, piece(need))
            room = self.free[0][0]
            if min(room, need - room) >= self.least_cut:  # fill the fullest by a cut
                rows += self._put(0, piece(room))
                at += room
            else:
                rows += self.held.pop(self.free.pop(0)[1])
        return rows

    def rest(self) -> list[tuple]:
        return [row for rows in self.held.values() for row in rows]


def _place(path: str, end_id: int, size: int, most: int, least_cut: int, schema: pa.Schema):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = batch_encoder(path), TaskContext.get().partitionId()
        windows = Windows(size, most, least_cut, part * SEQUENCES_PER_TASK)
        last = np.array([end_id], "<u4")

        def table(rows: list[tuple], closed: bool) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            columns += [[closed] * len(rows), [part] * len(rows)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for chunk in slices(batch, batch.schema.names[1], rows=4096):
                done: list[tuple] = []
                ids, offsets = encode(chunk.column(1))
                for document, begin, end in zip(chunk.column(0).to_pylist(), offsets[:-1], offsets[1:]):
                    done += windows.add(document, np.append(ids[begin:end], last))
                yield table(done, True)
        yield table(windows.rest(), False)

    return place


def _merge(size: int, key: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        """Best fit decreasing of whole leftover windows; none is cut."""
        fills = rows.groupby("sequence_id")["length"].sum()
        fills = sorted(((int(n), int(name)) for name, n in fills.items()), key=lambda x: (-x[0], x[1]))
        free: list[tuple[int, int]] = []
        target: dict[int, tuple[int, int]] = {}
        for fill, name in fills:
            fit = bisect_left(free, (fill, -1))
            room, into = free.pop(fit) if fit < len(free) else (size, name)
            target[name] = (into, size - room)
            if room > fill:
                insort(free, (room - fill, into))
        moved = rows["sequence_id"].map(target)
        return rows.assign(sequence_id=moved.str[0].astype("int64"), offset=rows["offset"] + moved.str[1].astype("int64"))[
            [key, *"start length ids_crc32 doc_tokens sequence_id offset".split()]
        ]

    return merge


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    end_id: int = 1,
    open_windows: int = 64,
    least_cut: int = 64,
    merged_tasks: int = 16,
) -> DataFrame:
    """Pack every document's ids, closed by ``end_id``, into sequences of at most ``size`` tokens.

    Each task keeps ``open_windows`` windows, puts what is left of a document after its full
    windows where it fits best, and emits the fullest window when none fits. That window is
    first filled by a cut where both parts have ``least_cut`` tokens, so less than this is
    padded. The windows open at the end of ``merged_tasks`` tasks are merged with each other;
    so no task holds more than ``merged_tasks * open_windows`` windows, however large the input.

    Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id and offset. NULL and
    empty texts are the end id alone. Repeated keys and rows are documents of their own, NULL
    keys stay NULL, other columns are ignored, and an empty table gives no piece.
    """
    kind = docs.schema[key].dataType.simpleString()
    place_as = f"`{key}` {kind}, {PIECE}, closed boolean, task bigint"
    rows = docs.select(key, text)
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [(key, types[kind]), *((n, pa.int64()) for n in "start length ids_crc32 doc_tokens sequence_id offset".split())]
    schema = pa.schema([*fields, ("closed", pa.bool_()), ("task", pa.int64())])
    placed = Scratch.of(docs.sparkSession).keep(
        rows.mapInArrow(_place(tokenizer_path, end_id, size, open_windows, least_cut, schema), place_as), "pieces"
    )
    left = placed.filter(~F.col("closed")).groupBy(F.floor(F.col("task") / merged_tasks).alias("of"))
    merged = left.applyInPandas(_merge(size, key), f"`{key}` {kind}, {PIECE}")
    return placed.filter("closed").drop("closed", "task").unionByName(merged)
