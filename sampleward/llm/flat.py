"""Texts of an Arrow column as one array of bytes, without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of texts that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
SPACE = 32


class Slice(NamedTuple):
    """Some rows of a batch: the rows themselves, and their texts' UTF-8 bytes end to end."""

    rows: pa.RecordBatch
    data: np.ndarray  # uint8
    starts: np.ndarray  # where each text begins, and the end of the last


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a batch, so many bytes of texts at once; null texts count as empty."""
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        held = offsets[first : last + 1]
        yield Slice(batch.slice(first, last - first), data[held[0] : held[-1]], held - held[0])
        first = last


class Words(NamedTuple):
    """Words of some texts: their bytes, each followed by one space, and where they begin and end."""

    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray  # of the word, before its space
    first: np.ndarray  # per text, its first word; and the number of words


def words(part: Slice, table: np.ndarray) -> Words:
    """Words are runs of bytes that the table does not turn into spaces."""
    texts = len(part.starts) - 1
    # A space before and after each text keeps texts apart.
    bounds = part.starts + np.arange(texts + 1)
    spaced = np.full(len(part.data) + texts + 1, SPACE, dtype=np.uint8)
    inside = np.ones(len(spaced), dtype=bool)
    inside[bounds] = False
    spaced[inside] = table[part.data]
    in_word = spaced != SPACE
    kept = in_word.copy()
    kept[1:] |= in_word[:-1]
    place = np.cumsum(kept)
    data = spaced[kept]
    ends = np.flatnonzero(data == SPACE)
    begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    # Bytes kept up to a text's border, hence its first word.
    first = np.searchsorted(begins, place[bounds])
    return Words(data, begins, ends, first)
