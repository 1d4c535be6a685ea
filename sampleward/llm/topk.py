"""Exact top-k inner products by columnar branch and bound.

Vectors are kept in blocks, dimension by dimension. A query adds up its products with a block a few
dimensions at a time; by Cauchy-Schwarz, what the remaining dimensions can still add is at most the
product of the remaining masses (norms). Candidates whose sum and bound stay below the query's k-th
score so far are dropped, and the rest is compacted before the next dimensions are read.

Queries go through the candidates in slices of at most `slice_bytes`, one after the other: a slice is broadcast,
its tasks give k rows per query, which are written, and it is released before the next one, so the driver never holds
more than a slice. A window keeps the best. Blocks are written to the shared folder once.

Components become floor(256 * x), as longs. Sums are exact: in doubles where no sum can reach 2^53, else
in integers of any size, cut to the range of a long. Vectors that are null or have a null or non-finite
component take no part, nor do rows without vec_id. Missing dimensions count as zero. A candidate is every
row but the query's own, so repeats of its row are candidates; ties go to the smaller vec_id. An empty
table gives no rows. Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleward.llm.batches import map_rows
from sampleward.sources.shared import stage

BLOCK_ROWS, BLOCK_DIMENSIONS = 8192, 8
# Candidates of a block that are summed up in full for all queries, for their first k-th scores.
SEED_ROWS = 512
EXACT = 1 << 53
LONG = np.iinfo(np.int64)


class Block(NamedTuple):
    rows: np.ndarray  # row numbers
    ids: np.ndarray  # vec_ids
    values: np.ndarray  # dimensions x rows


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """row, vec_id, vector array<long> of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    taken = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return taken.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v)).alias("vector"),
    )


def blocks(vectors: DataFrame) -> DataFrame:
    """Vertical blocks of up to BLOCK_ROWS vectors as little-endian 64-bit numbers."""

    def pack(held: list[tuple]) -> tuple:
        width = max(len(v) for *_, v in held)
        values = np.zeros((width, len(held)), dtype="<i8")
        for i, (*_, v) in enumerate(held):
            values[: len(v), i] = v
        rows, ids = (np.array([h[k] for h in held], dtype="<i8") for k in (0, 1))
        return rows.tobytes(), ids.tobytes(), values.tobytes()

    def run(rows):
        held: list[tuple] = []
        for row in rows:
            held.append(row)
            if len(held) == BLOCK_ROWS:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    return map_rows(vectors, run, "rows binary, ids binary, values binary")


def read_block(rows: bytes, ids: bytes, values: bytes) -> Block:
    numbers = np.frombuffer(rows, dtype="<i8")
    return Block(
        numbers, np.frombuffer(ids, dtype="<i8"), np.frombuffer(values, dtype="<i8").reshape(-1, len(numbers))
    )


def fitted(values: np.ndarray, width: int) -> np.ndarray:
    """Dimensions x rows, cut or filled with zeros to so many dimensions."""
    if len(values) >= width:
        return values[:width]
    return np.vstack([values, np.zeros((width - len(values), values.shape[1]), dtype=values.dtype)])


class Search:
    """The best k candidates so far of each query of a slice."""

    def __init__(self, queries: list[tuple[int, int, list[int]]], k: int):
        self.k, self.rows = k, np.array([q[0] for q in queries], dtype=np.int64)
        self.width = max((len(q[2]) for q in queries), default=0)
        self.values = np.zeros((len(queries), self.width), dtype=np.int64)
        for i, (*_, vector) in enumerate(queries):
            self.values[i, : len(vector)] = vector
        self.best: list[list[tuple[int, int]]] = [[] for _ in queries]  # (-score, vec_id), best first
        self.largest = self.bound(self.values)
        self.cuts = list(range(0, self.width, BLOCK_DIMENSIONS))
        floats = self.values.astype(np.float64)
        self.floats = floats
        self.mass = self.masses(floats.T).T

    @staticmethod
    def bound(values: np.ndarray) -> int:
        return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0

    def masses(self, values: np.ndarray) -> np.ndarray:
        """Per cut, the norms of what comes after it; rounded up a little."""
        squares = values * values
        sums = [squares[cut + BLOCK_DIMENSIONS :].sum(axis=0) for cut in self.cuts]
        return np.sqrt(np.array(sums)).reshape(len(self.cuts), -1) * (1 + 1e-9)

    def put(self, query: int, scores, ids) -> None:
        found = self.best[query] + [(-int(s), int(i)) for s, i in zip(scores, ids)]
        self.best[query] = sorted(found)[: self.k]

    def add(self, block: Block) -> None:
        values = fitted(block.values, self.width)
        if self.largest * self.bound(values) * max(1, self.width) >= EXACT:
            self.add_large(block, values)
            return
        values = values.astype(np.float64)
        mass = self.masses(values)
        seed = self.floats @ values[:, :SEED_ROWS]
        for q, scores in enumerate(seed):
            self.put_top(q, scores, np.arange(len(scores)), block)
        rest = values[:, SEED_ROWS:]
        if not rest.shape[1]:
            return
        parts = [np.ascontiguousarray(rest[cut : cut + BLOCK_DIMENSIONS]) for cut in self.cuts]
        mass = mass[:, SEED_ROWS:]
        for q in range(len(self.floats)):
            self.branch(q, parts, mass, block)

    def put_top(self, q: int, scores: np.ndarray, places: np.ndarray, block: Block) -> None:
        """Adds the candidates that can be among the best k."""
        best = self.best[q]
        if len(best) == self.k:
            good = np.flatnonzero(scores >= -best[-1][0])
        else:
            good = np.arange(len(scores))
        good = good[block.rows[places[good]] != self.rows[q]]
        if len(good) > self.k:
            kth = np.partition(scores[good], len(good) - self.k)[len(good) - self.k]
            good = good[scores[good] >= kth]
        if len(good) > self.k:  # ties at the last place
            order = np.lexsort((block.ids[places[good]], -scores[good]))
            good = good[order[: self.k]]
        if len(good):
            self.put(q, scores[good], block.ids[places[good]])

    def branch(self, q: int, parts: list[np.ndarray], mass: np.ndarray, block: Block) -> None:
        query, places = self.floats[q], None
        sums = np.zeros(mass.shape[1])
        for j, (cut, part) in enumerate(zip(self.cuts, parts)):
            part = part if places is None else part[:, places]
            sums = sums + query[cut : cut + BLOCK_DIMENSIONS] @ part
            if len(self.best[q]) < self.k:
                continue
            left = mass[j] if places is None else mass[j, places]
            alive = np.flatnonzero(sums + self.mass[q, j] * left + 1e-6 >= -self.best[q][-1][0])
            if len(alive) < 0.7 * len(sums) or j == len(self.cuts) - 1:
                places = alive if places is None else places[alive]
                sums = sums[alive]
                if not len(places):
                    return
        places = np.arange(len(sums)) if places is None else places
        self.put_top(q, sums, places + SEED_ROWS, block)

    def add_large(self, block: Block, values: np.ndarray) -> None:
        """All sums in integers of any size."""
        large = values.astype(object)
        for q in range(len(self.rows)):
            sums = self.values[q].astype(object) @ large if self.width else np.zeros(len(block.rows), dtype=object)
            sums = [min(max(int(s), LONG.min), LONG.max) for s in sums]
            found = [(-s, int(i)) for s, i, r in zip(sums, block.ids, block.rows) if r != self.rows[q]]
            self.best[q] = sorted(self.best[q] + found)[: self.k]


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, slice_bytes: int = 16 << 20
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: queries are the rows whose vec_id `every` divides."""
    spark = vectors.sparkSession
    held = stage(blocks(integer_vectors(vectors, scale)), "vectors")

    def pick(rows: Iterator[tuple]) -> Iterator[tuple]:
        for block in map(lambda r: read_block(*r), rows):
            for i in np.flatnonzero(block.ids % every == 0):
                yield int(block.rows[i]), int(block.ids[i]), block.values[:, i].tolist()

    queries = stage(map_rows(held, pick, "row long, vec_id long, vector array<long>"), "queries")
    size = queries.agg(F.sum(F.size("vector") * 8 + 64)).first()[0] or 0
    slices = -(-size // slice_bytes)

    def results(number: int) -> DataFrame:
        part = queries.where(F.pmod(F.xxhash64("row"), F.lit(slices)) == number)
        sent = spark.sparkContext.broadcast([tuple(r) for r in part.orderBy("row").collect()])

        def run(rows):
            search = Search(sent.value, k)
            for row in rows:
                search.add(read_block(*row))
            for (row, query_id, _), best in zip(sent.value, search.best):
                for negative, vec_id in best:
                    yield row, query_id, vec_id, -negative

        found = stage(map_rows(held, run, "row long, query_id long, vec_id long, score long"), "nearest")
        sent.destroy()
        return found

    empty = spark.createDataFrame([], "row long, query_id long, vec_id long, score long")
    found = reduce(DataFrame.unionAll, map(results, range(slices)), empty)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
