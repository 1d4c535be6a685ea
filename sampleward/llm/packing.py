"""Packing by power-of-two decomposition.

Each document, with its end token, is cut into full pieces of the longest length and, for the rest,
one piece per binary digit that is set, longest first. A piece is a sequence of its own whose length
is a power of two, so no sequence crosses documents and none needs padding. Pieces of equal length
form a bucket, from which batches are drawn.

A task handles its own documents, so nothing is shuffled. A sequence id is the task's number and a
count in it: unique, and the same when a lost task runs again on its files.

Nulls count as empty texts: one piece with the end token. Repeated rows are packed once each;
columns other than doc_id and text are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sampleward.llm.batches import ROWS, texts
from sampleward.llm.flat import slices
from sampleward.llm.word_bpe import load

# Bytes of texts whose words are looked up together.
TOGETHER_BYTES = 1 << 22
# Ids that go back in one Arrow batch, or those of one piece.
BATCH_IDS = 1 << 24
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int, "
    "sequence_id long, offset long"
)


def binary_lengths(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the documents' pieces: powers of two that sum to a document's tokens, longest first.

    The pieces of all documents stand one after the other; the second array has each document's number of them.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest length {longest} is no power of two")
    powers = longest >> np.arange(longest.bit_length())
    counts = np.where(powers == longest, tokens[:, None] // longest, (tokens[:, None] & powers) > 0)
    return np.repeat(np.tile(powers, len(tokens)), counts.ravel()), counts.sum(axis=1)


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece; ids are little-endian unsigned 32-bit, bucket is the length's power of two."""
    binary_lengths(np.zeros(0, dtype=np.int64), longest)
    names = StructType.fromDDL(PIECES).names
    step = max(1, min(ROWS, BATCH_IDS // longest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 33
        for part in (part for batch in batches for part in slices(batch, 1, TOGETHER_BYTES)):
            ids, counts = words.encode_flat(part.rows.column(1))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4", copy=False)
            tokens = counts + 1
            lengths, pieces = binary_lengths(tokens, longest)
            # Ids of all documents stand end to end, and so do their pieces.
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            document = np.repeat(np.arange(len(tokens)), pieces)
            starts = bounds[:-1] - (np.cumsum(tokens) - tokens)[document]
            for low in range(0, len(lengths), step):
                of, at = document[low : low + step], bounds[low : low + step + 1]
                offsets = pa.py_buffer((4 * (at - at[0])).astype(np.int32))
                data = pa.py_buffer(ids[at[0] : at[-1]])
                columns = [
                    part.rows.column(0).take(pa.array(of)),
                    starts[low : low + step],
                    lengths[low : low + step],
                    pa.Array.from_buffers(pa.binary(), len(of), [None, offsets, data]),
                    tokens[of],
                    np.frexp(lengths[low : low + step])[1] - 1,
                    sequence + low + np.arange(len(of)),
                    np.zeros(len(of), dtype=np.int64),
                ]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=names)
            sequence += len(lengths)

    return texts(docs).mapInArrow(run, PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )
