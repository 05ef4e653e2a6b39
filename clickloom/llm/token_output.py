"""Token ids as packed binary matrices.

Documents become ids and an end id; those longer than a row of the matrix are split without loss. Each task gathers
segments up to a bounded number of tokens, packs them best fit decreasing into rows (a segment tree over the free sizes
finds the fullest row with room) and writes the rows: ids as little-endian integers padded to the row's width, the
cumulative segment lengths, and the places where positions start again at 0. No ids are shuffled. A task leaves at most
its last rows underfull, and its memory is the bound, not its input.

Null texts are empty and give the end id alone. Repeated rows are segments of their own. An empty table gives no rows.
Input columns other than ``doc_id`` and ``text`` are not looked at. :func:`unpack` gives back every document's ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch_of, map_rows, slices, whole_text
from clickloom.llm.tokens import as_bytes, encoder

ROW_TOKENS = 4096
END_ID = 50256
PAD_ID = 50256
#: Tokens that a task holds and packs at a time.
GATHERED_TOKENS = 4096 * 2048
#: Rows handed on at a time.
BATCH_ROWS = 64

ROWS = (
    "row_id bigint, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, position_resets array<int>,"
    " doc_ids array<bigint>, pieces array<int>, starts array<bigint>"
)
ROW_NAMES = [part.split()[0] for part in ROWS.split(", ")]
ROW_TYPES = [
    *(pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())),
    *(pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())),
]


class FreeRows:
    """Rows by their free tokens, in a segment tree that finds the smallest free size that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        #: Rows below each node; a leaf is a free size.
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, free: int, by: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, row: int, free: int) -> None:
        if free:
            self.rows[free].append(row)
            self._change(free, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The fullest row with room for ``length`` and its free tokens; it is taken out. None if there is none."""
        node = self.leaves + length
        if not self.count[node]:
            # Climb until a right sibling holds rows, then go down to its smallest size.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        free = node - self.leaves
        self._change(free, -1)
        return self.rows[free].pop(), free


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each bin."""
    tree, bins = FreeRows(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[item])
        row, free = found or (len(bins), capacity)
        if found:
            bins[row].append(item)
        else:
            bins.append([item])
        tree.add(row, free - lengths[item])
    return bins


Segment = tuple[int | None, int, int, bytes]


def rows_of(segments: list[Segment], first: int, width: int, dtype: str, pad_id: int) -> Iterator[pa.RecordBatch]:
    """The packed rows of some segments (doc_id, piece, start, ids), numbered from ``first``."""
    bins = best_fit_decreasing([len(ids) // 4 for *_, ids in segments], width)
    padding, most = np.full(width, pad_id, dtype), np.iinfo(dtype).max
    for start in range(0, len(bins), BATCH_ROWS):
        out: list[list] = [[] for _ in ROW_NAMES]
        for number, members in enumerate(bins[start : start + BATCH_ROWS], first + start):
            parts = [segments[m] for m in members]
            lengths = [len(ids) // 4 for *_, ids in parts]
            ends = np.cumsum(lengths).tolist()
            matrix_row = padding.copy()
            row_ids = np.frombuffer(b"".join(ids for *_, ids in parts), "<u4")
            if row_ids.max() > most:
                raise ValueError(f"id {row_ids.max()} is more than {dtype} holds")
            matrix_row[: ends[-1]] = row_ids
            starts = [0, *ends[:-1]]
            row = (number, ends[-1], len(parts), matrix_row.tobytes(), [0, *ends], starts)
            for column, value in zip(out, (*row, *map(list, zip(*(p[:3] for p in parts)))), strict=True):
                column.append(value)
        yield batch_of(out, ROW_TYPES, ROW_NAMES)


def write_rows(
    batches: Iterator[pa.RecordBatch], path: str, width: int, end_id: int, pad_id: int, dtype: str, gathered: int
) -> Iterator[pa.RecordBatch]:
    """Encode, split and pack the documents of one partition."""
    encode, end = encoder(path).encode, as_bytes([end_id])
    segments: list[Segment] = []
    held, first = 0, TaskContext.get().partitionId() << 32
    for doc_ids, texts in slices(batches):
        for doc_id, text in zip(doc_ids, texts, strict=True):
            ids = encode(text) + end
            for piece, start in enumerate(range(0, len(ids) // 4, width)):
                segments.append((doc_id, piece, start, ids[4 * start : 4 * (start + width)]))
            held += len(ids) // 4
            if held >= gathered:
                for batch in rows_of(segments, first, width, dtype, pad_id):
                    first += batch.num_rows
                    yield batch
                segments, held = [], 0
    yield from rows_of(segments, first, width, dtype, pad_id)


def packed_rows(
    documents: DataFrame,
    path: str,
    width: int = ROW_TOKENS,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
    dtype: str = "<u2",
    gathered_tokens: int = GATHERED_TOKENS,
) -> DataFrame:
    """The packed matrix, a row per row: ids in ``dtype``, cumulative segment lengths, position resets, and which
    document, piece and token of the document each segment starts at.

    ``dtype`` must hold all ids, or the job fails; ``<u2`` does for vocabularies of up to 65,536. ``row_id`` only tells rows apart.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    settings = {"width": width, "end_id": end_id, "pad_id": pad_id, "dtype": dtype, "gathered": gathered_tokens}
    return map_rows(rows, partial(write_rows, path=path, **settings), ROWS)


def split_rows(batches: Iterator[pa.RecordBatch], dtype: str) -> Iterator[pa.RecordBatch]:
    """The segments of packed rows."""
    size = np.dtype(dtype).itemsize
    for ids, bounds, doc_ids, pieces, starts in slices(batches):
        out: list[list] = [[], [], [], []]
        for row, bound, *others in zip(ids, bounds, doc_ids, pieces, starts, strict=True):
            parts = [row[size * a : size * b] for a, b in zip(bound, bound[1:])]
            for column, values in zip(out, (*others, parts), strict=True):
                column.extend(values)
        yield batch_of(out, [pa.int64(), pa.int32(), pa.int64(), pa.binary()], ["doc_id", "piece", "start", "ids"])


def unpack(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """The segments again: ``doc_id, piece, start, ids``. Pieces of a document in order are its ids and the end id."""
    rows = packed.select("ids", "cu_seqlens", "doc_ids", "pieces", "starts")
    return map_rows(rows, partial(split_rows, dtype=dtype), "doc_id bigint, piece int, start bigint, ids binary")
