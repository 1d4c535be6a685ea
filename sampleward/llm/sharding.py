"""Shards of nearly equal size by a minimax contiguous partition.

Rows with equal texts form an atomic group. Groups are put in order by a hash of the text, and the order
is cut into contiguous shards such that the largest shard is as small as it can be: the least capacity is
found by binary search, each candidate checked greedily, and the order is cut there.

The driver never holds the groups. It holds ranges of hashes with their sizes, a few thousand at first.
A search that may cut inside any range, and one that may cut only between ranges, give bounds of
the capacity; only ranges in which a cut may fall are split and counted again by a Spark aggregation,
until both bounds agree. Ranges that hold a single group are not split. The result is exact.

A size is the text's UTF-8 bytes plus a fixed amount for the row; nulls count as empty texts. Repeated
rows are in one group and get a slot each. A group larger than the mean shard makes its shard larger
than the others; groups are never split. An empty table gives no rows. Columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleward.llm.batches import texts
from sampleward.sources.shared import stage

# Bits of the hash that the first ranges have, and that each split adds.
FIRST_BITS, SPLIT_BITS = 12, 6
# Ranges split in one round; the largest come first, others in the next rounds.
SPLIT_AT_ONCE = 2000
# Rows of one writing task that are numbered together: 2 to this power.
BLOCK_BITS = 16


class Range(NamedTuple):
    start: int  # the least hash, in signed order
    bits: int
    size: int
    single: bool


class Order:
    """Ranges side by side, and greedy cuts through them."""

    def __init__(self, ranges: list[Range]):
        self.ranges = sorted(ranges)
        self.ends, total = [], 0
        for r in self.ranges:
            total += r.size
            self.ends.append(total)
        self.starts = [0, *self.ends]
        self.total = total

    def greedy(self, capacity: int, shards: int, inside: bool) -> list[int]:
        """Where each shard ends. inside: a range of several groups may be cut anywhere."""
        cuts, at = [], 0
        for _ in range(shards):
            reach = at + capacity
            i = bisect_right(self.starts, reach) - 1  # the range that holds the place
            if not inside or i == len(self.ranges) or self.ranges[i].single:
                reach = self.starts[i]
            at = max(at, min(reach, self.total))
            cuts.append(at)
        return cuts

    def least(self, shards: int, inside: bool) -> int:
        """The least capacity with which the shards suffice."""
        low = max(-(-self.total // shards), *(r.size for r in self.ranges if r.single), 0)
        high = max(self.total, low)
        while low < high:
            middle = (low + high) // 2
            if self.greedy(middle, shards, inside)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low


def count_ranges(rows: DataFrame, bits: int, within: list[Range] | None = None) -> list[Range]:
    """Ranges of so many leading bits; within: only those inside the given ones."""
    spark, shift = rows.sparkSession, 64 - bits
    if within is not None:
        # A few thousand ranges at most, by the bound on splits.
        old = {r.bits for r in within}
        wanted = spark.createDataFrame([(r.bits, r.start) for r in within], "bits int, start long")
        parts = [
            rows.join(
                F.broadcast(wanted.where(F.col("bits") == b)),
                F.shiftleft(F.shiftright("hash", 64 - b), 64 - b) == F.col("start"),
                "left_semi",
            )
            for b in old
        ]
        counted = []
        for part, b in zip(parts, old):
            counted += count_ranges(part, min(64, b + SPLIT_BITS))
        return counted
    start = F.shiftleft(F.shiftright("hash", shift), shift) if shift else F.col("hash")
    found = rows.groupBy(start.alias("start")).agg(
        F.sum("size").alias("size"), (F.min("hash") == F.max("hash")).alias("single")
    )
    return [Range(r.start, bits, r.size, r.single) for r in found.collect()]


def cut_hashes(rows: DataFrame, shards: int) -> list[int]:
    """The least hash of every shard after the first; shards at the end may be empty."""
    ranges = count_ranges(rows, FIRST_BITS)
    while ranges:
        order = Order(ranges)
        low, high = order.least(shards, True), order.least(shards, False)
        if low == high:
            break
        first, last = order.greedy(low, shards, False), order.greedy(high, shards, True)
        unsure = set()
        for a, b in zip(first, last):
            i, j = bisect_right(order.starts, a) - 1, bisect_right(order.starts, b)
            unsure.update(r for r in order.ranges[max(0, i - 1) : j] if not r.single)
        split = sorted(unsure, key=lambda r: -r.size)[:SPLIT_AT_ONCE]
        ranges = [r for r in ranges if r not in set(split)] + count_ranges(rows, 0, split)
    if not ranges:
        return []
    cuts = []
    for at in order.greedy(high, shards, False)[:-1]:
        i = bisect_right(order.ends, at)
        if i < len(order.ranges):
            cuts.append(order.ranges[i].start)
    return cuts


def shard(docs: DataFrame, shards: int = 24, row_bytes: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in a shard), grown_shard (null)."""
    rows = stage(
        texts(docs).select(
            "doc_id",
            (F.octet_length("text") + row_bytes).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.xxhash64("text").alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sharding",
    )
    number = F.lit(0)
    for cut in cut_hashes(rows.select("hash", "size"), shards):
        number += (F.col("hash") >= cut).cast("int")
    block = F.shiftright("row", BLOCK_BITS)
    placed = rows.withColumn("shard", number).withColumn("block", block)
    # Slots: rows are numbered in their block, blocks by the counts before them in the shard.
    counts = placed.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("row"))
    numbered = placed.withColumn("within", within - 1).join(first, ["shard", "block"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
