"""Packed token ids as binary matrix rows.

Documents are encoded and packed block by block: a block holds at least `block_tokens` ids (or what
the task has). A document longer than a row is cut into full rows and a rest, so no id is lost. The
pieces of a block go into rows by best fit, longest first: a segment tree over the free space 0 to
`width` says which open row has the least space that suffices. Each row is written with its ids,
the cumulative lengths of its segments, and positions that begin again at 0 in each segment.

Blocks are made within a task, so nothing is shuffled and a task's memory is bounded by a block and
its longest document. Row ids are the task's number and a count in it.

Nulls count as empty texts: one piece with the end token. Repeated rows are packed once each;
columns other than doc_id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleward.llm.batches import map_rows, texts
from sampleward.llm.byte_bpe import TOGETHER, load

ROWS = (
    "row_id long, n_tokens long, ids binary, cu_seqlens array<int>, positions binary, "
    "segments array<struct<doc_id: long, start: long, length: long, offset: int>>"
)


class FreeSpace:
    """Open rows by free space; finds the least free space that holds a piece."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]
        self.used = [False] * (2 * self.size)

    def add(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        i = space + self.size
        while i and not self.used[i]:
            self.used[i] = True
            i //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(free space, row) of the best fit, taken out; None if no open row suffices."""
        i = need + self.size
        while not self.used[i]:
            while i & 1:  # a right child: nothing further right below this parent
                i //= 2
            if i == 0:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.used[2 * i] else 2 * i + 1
        space = i - self.size
        row = self.rows[space].pop()
        if not self.rows[space]:
            while i and not (i < self.size and (self.used[2 * i] or self.used[2 * i + 1])):
                self.used[i] = False
                i //= 2
        return space, row


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Rows as lists of places in `lengths`, none of which exceeds the width."""
    free, rows = FreeSpace(width), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        if found := free.take(lengths[i]):
            space, row = found
        else:
            space, row = width, len(rows)
            rows.append([])
        rows[row].append(i)
        free.add(space - lengths[i], row)
    return rows


def matrix_row(row_id: int, pieces: list[tuple], width: int, pad_id: int) -> tuple:
    ids = np.full(width, pad_id, dtype="<u4")
    positions = np.zeros(width, dtype="<u4")
    at, ends, segments = 0, [0], []
    for doc_id, start, part in pieces:
        ids[at : at + len(part)] = part
        positions[at : at + len(part)] = np.arange(len(part))
        segments.append((doc_id, start, len(part), at))
        at += len(part)
        ends.append(at)
    segments = [dict(zip(("doc_id", "start", "length", "offset"), s)) for s in segments]
    return row_id, at, ids.tobytes(), ends, positions.tobytes(), segments


def pack_rows(
    docs: DataFrame, tokenizer_path: str, width: int = 2048, end_id: int = 50256, pad_id: int = 50256,
    block_tokens: int = 2_000_000,
) -> DataFrame:
    """One row per matrix row: `width` ids and positions, little-endian unsigned 32-bit.

    `n_tokens` ids are real and the rest is padding, whose positions are 0.
    """

    def blocks(rows) -> Iterator[list[tuple]]:
        bpe, block, held = load(tokenizer_path), [], 0
        end = np.array([end_id], dtype="<u4")
        for part in batched(rows, TOGETHER):
            doc_ids, together = zip(*part)
            for doc_id, ids in zip(doc_ids, bpe.encode_arrays(together)):
                ids = np.concatenate([ids, end])
                block += [(doc_id, s, ids[s : s + width]) for s in range(0, len(ids), width)]
                held += len(ids)
                if held >= block_tokens:
                    yield block
                    block, held = [], 0
        if block:
            yield block

    def run(rows):
        row_id = TaskContext.get().partitionId() << 33
        for block in blocks(rows):
            for places in best_fit_decreasing([len(p[2]) for p in block], width):
                yield matrix_row(row_id, [block[i] for i in places], width, pad_id)
                row_id += 1

    return map_rows(texts(docs), run, ROWS)


def write_rows(rows: DataFrame, path: str) -> None:
    """The matrix rows as Parquet: a file's column `ids` is its part of the matrix, row by row."""
    rows.write.parquet(path)


def rows_digest(rows: DataFrame) -> DataFrame:
    """Per segment: its document, place and row, with CRCs of the row's ids and positions."""
    row = rows.select(
        "row_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
        F.array_join(F.col("cu_seqlens").cast("array<string>"), ",").alias("cu_seqlens"),
        F.explode("segments").alias("s"),
    )
    return row.select("s.*", "row_id", "n_tokens", "ids_crc32", "positions_crc32", "cu_seqlens")
