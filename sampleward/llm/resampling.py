"""Importance resampling towards a target: documents drawn by how their features compare with the target's.

Features are all runs of 1 to `most_words` consecutive words, hashed by CRC-32 into buckets. A bucket's gain
compares its share in the target texts with its share in the documents; a document's weight is the sum of
its features' gains. Gumbel noise from a hash of doc_id is added, and the highest scores are drawn, which
draws without replacement in proportion to the exponentials of the weights.

The CRC of a span of bytes is, but for a constant of its length, the XOR of one number per byte, which depends
on the byte and its distance from the span's end alone. Those numbers are a table; a feature's bytes are looked
up together and `np.bitwise_xor.reduceat` folds each word's part. A byte stands in features that end with its own word,
the next one, and so on, so it is looked up once for each of these. Features longer than the table are folded in
blocks: the state so far is moved on by a block's length, itself a linear map, and the next block is added.

Two passes: one counts buckets (10,000 numbers a task), the other weighs with all gains, a table of
fixed size that goes to every task. Ranks need no window over all rows: scores are dealt by range and written in order, so a
row's rank is its place in its file and the rows of the files before. Nothing but counts reaches the driver.

Words are runs of digits, letters a-z and characters beyond ASCII after A-Z are put in lower case. Null and
empty texts have no features: weight 0, never drawn. Every row gives one row, and each repeated row counts; rows
alike in score and doc_id are ranked in any order. A row without doc_id takes its noise from the text "42:",
and comes after equal scores with one. Texts of any length are worked on whole, a bounded number of bytes at once. Columns
other than doc_id and text are ignored. Without target texts the gains compare with nothing but the smoothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleward.llm.batches import texts
from sampleward.llm.flat import SPACE, Slice, Words, slices, words
from sampleward.sources.shared import stage

BUCKETS = 10_000
# Features of more bytes are folded in blocks of so many.
DISTANCES = 256
CHUNK_WORDS = 1 << 17

WORD_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else SPACE for b in range(256)],
    dtype=np.uint8,
)


def position_table(distances: int = DISTANCES) -> np.ndarray:
    """[distance from the end, byte]: what a byte adds to a CRC-32, apart from the constant of the length."""
    zero = zlib.crc32(b"\0")
    table = np.empty((distances, 256), dtype=np.uint32)
    table[0] = [zlib.crc32(bytes([b])) ^ zero for b in range(256)]
    for d in range(1, distances):
        before = table[d - 1]
        # One more byte behind moves the state on by eight bits.
        table[d] = (before >> 8) ^ table[0][before & 255]
    return table


TABLE = position_table()
LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(DISTANCES + 1)], dtype=np.uint32)
# What a state's four bytes become behind DISTANCES more bytes.
MOVED = np.array([[zlib.crc32(bytes([*(b if k == i else 0 for k in range(4)), *[0] * (DISTANCES - 4)])) ^ zlib.crc32(bytes(DISTANCES)) for b in range(256)] for i in range(4)], dtype=np.uint32)


def folded(span: np.ndarray) -> int:
    """The CRC-32 of a span of any length, block by block."""
    first = len(span) % DISTANCES or DISTANCES
    head = span[:first]
    # The usual start is all ones in the first four bytes' place; it is that of the constant of the length.
    state = int(np.bitwise_xor.reduce(TABLE[np.arange(first - 1, -1, -1), head])) ^ int(LENGTHS[first]) ^ 0xFFFFFFFF
    reach = np.arange(DISTANCES - 1, -1, -1)
    for at in range(first, len(span), DISTANCES):
        moved = 0
        for i in range(4):
            moved ^= int(MOVED[i][(state >> (8 * i)) & 255])
        state = moved ^ int(np.bitwise_xor.reduce(TABLE[reach, span[at : at + DISTANCES]]))
    return state ^ 0xFFFFFFFF


def chunk_features(found: Words, low: int, high: int, most_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, CRC-32) of the features that begin with words low to high - 1."""
    last = min(high + most_words - 1, len(found.begins))
    begins, ends = found.begins[low:last], found.ends[low:last]
    data = found.data[begins[0] : ends[-1] + 1]
    begins, ends = begins - begins[0], ends - begins[0]
    word = np.repeat(np.arange(len(begins)), ends - begins + 1)
    here = np.arange(len(data))
    # Text borders: a feature's last word belongs to the text of its first.
    text_end = found.first[np.searchsorted(found.first, np.arange(low, high), side="right")] - low
    parts, starts, crcs = [], [], []
    for ahead in range(most_words):
        # Each byte's share in a feature that ends with the word `ahead` of its own.
        end = ends[np.minimum(word + ahead, len(ends) - 1)]
        distance = end - 1 - here
        shares = TABLE[np.clip(distance, 0, DISTANCES - 1), data]
        if ahead == 0:  # the space behind a feature is no part of it
            shares[ends] = 0
        parts.append(np.bitwise_xor.reduceat(shares, begins))
        begin = np.arange(high - low)
        begin = begin[begin + ahead < text_end]
        crc = parts[ahead][begin]
        for k in range(ahead):
            crc = crc ^ parts[k][begin + ahead - k]
        length = ends[begin + ahead] - begins[begin]
        long = np.flatnonzero(length > DISTANCES)
        crc = crc ^ LENGTHS[np.minimum(length, DISTANCES)]
        for i in long:
            crc[i] = folded(data[begins[begin[i]] : ends[begin[i] + ahead]])
        starts.append(begin + low)
        crcs.append(crc)
    return np.concatenate(starts), np.concatenate(crcs)


def features(found: Words, most_words: int = 3, chunk: int = CHUNK_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first word, CRC-32) of all features, some words at once."""
    for low in range(0, len(found.begins), chunk):
        yield chunk_features(found, low, min(low + chunk, len(found.begins)), most_words)


def bucket_counts(table: DataFrame, buckets: int, most_words: int) -> np.ndarray:
    """Features of all texts per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for _, crcs in features(words(part, WORD_BYTES), most_words):
                    counts += np.bincount(crcs % buckets, minlength=buckets)
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(buckets), "n": counts})

    text = table.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = np.zeros(buckets, dtype=np.int64)
    found = text.mapInArrow(run, "bucket long, n long").where("n > 0").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in found.collect():  # one row a bucket at most
        total[row.bucket] = row.n
    return total


def bucket_gains(docs: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the ratio of smoothed shares) per bucket."""
    over = (target + 1.0) * float(docs.sum() + len(docs))
    under = (docs + 1.0) * float(target.sum() + len(target))
    return np.floor(scale * np.log(over / under)).astype(np.int64)


def weigh(part: Slice, gains: np.ndarray, most_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, features and weight of each text of a slice."""
    found = words(part, WORD_BYTES)
    n = np.diff(found.first)
    # A text of so many words has that many features of each length, less the ones that would run over its end.
    count = sum(np.maximum(n - k, 0) for k in range(most_words))
    weight = np.zeros(len(found.begins) + 1, dtype=np.int64)
    for first, crcs in features(found, most_words):
        gained = gains[crcs % len(gains)]
        order = np.argsort(first, kind="stable")
        at = first[order]
        cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        weight[at[cuts] + 1] = np.add.reduceat(gained[order], cuts)
    total = np.cumsum(weight)
    return n, count, total[found.first[1:]] - total[found.first[:-1]]


def weights(docs: DataFrame, gains: np.ndarray, most_words: int = 3) -> DataFrame:
    """doc_id, n_words, n_features, weight for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                arrays = map(pa.array, weigh(part, shared.value, most_words))
                yield pa.RecordBatch.from_arrays(
                    [part.rows.column(0), *arrays], names=["doc_id", "n_words", "n_features", "weight"]
                )

    return texts(docs).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """rows numbered from 1 in an order, by ranges: each range is written in order, and begins where the others end."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stage(dealt.withColumn("__part", F.spark_partition_id()), name)
    counts = held.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    firsts = counts.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    numbered = held.withColumn("__place", F.col("_metadata.row_index")).join(F.broadcast(firsts), "__part")
    return numbered.select(*rows.columns, (F.col("__first") + F.col("__place") + 1).alias(name))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = BUCKETS,
    most_words: int = 3, seed: int = 42, scale: int = 1000,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) for each row of docs.

    Of the documents with `least_words` words or more, floor(percent / 100) of them are drawn.
    """
    counted = bucket_counts(docs, buckets, most_words), bucket_counts(target, buckets, most_words)
    held = weights(docs, bucket_gains(*counted, scale), most_words)
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    hashed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-scale * F.log(-F.log((hashed + 0.5) / F.lit(4294967296.0))))
    held = stage(held.withColumn("score", F.col("weight") + noise), "weights")
    able = F.col("n_words") >= least_words
    wanted = percent * held.where(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    able_rows = ranked(held.where(able).select(*columns), order)
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).cast("long")
    rest = held.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return able_rows.select(*columns, rank.alias("rank")).unionAll(rest)
