"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Documents are indexed in blocks, each with the postings of the queries' terms: per term, the documents that hold it
and how often, and per document its number of terms. Statistics over all documents (their number,
their terms, the documents of each term) are sums over the blocks. Texts are read once per slice of queries.

A query goes through the blocks with the score of its k-th document so far as threshold. In a block, the
postings of its rare terms are summed up term by term into accumulators in the order of documents, and these
are one more list, whose greatest sum is its bound. That list and the long ones are then walked together,
some documents at once: a stretch whose greatest impacts stay below the threshold is skipped in all
lists; else the lists whose bounds together reach the threshold name the candidates, and the others are searched
for these only, those with the greatest bound first, while what they can still add may lift a candidate to the
threshold. Scores equal to the threshold are kept, as the smaller doc_id wins.

A task gives its k best documents per query, the best of which are found in two steps, so that no query gathers the
results of all tasks in one place. Queries are taken in slices of at most `slice_bytes` of text; a slice goes
to every task, and is released before the next one.

Terms are runs of digits, ASCII letters and characters beyond ASCII, A-Z in lower case. Null and empty texts have no
terms: such documents do not count and are never found, such queries give no rows. Every row of the
queries is a query, also if item_id repeats or is null; every row of the documents is one, and a copy takes a rank of its own.
Rows without doc_id come after equal scores with one. Texts of any length are indexed whole. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleward.llm.batches import map_rows, texts
from sampleward.sources.shared import stage

BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 1 << 19
# Documents that are walked through at once, and the share of a block up to which a list is short.
STRETCH, SHORT_SHARE = 2048, 1 / 16
SALTS = 64
LONG = np.iinfo(np.int64)

FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

INDEX = "ids binary, known binary, lengths binary, terms array<int>, sizes array<int>, docs binary, counts binary"
RESULT = "query long, item_id long, doc_id long, score long"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


class Queries(NamedTuple):
    """A slice of queries: numbers of their distinct terms, and per query its terms and how often it holds each."""

    vocabulary: dict[bytes, int]
    rows: list[tuple[int, int | None, np.ndarray, np.ndarray]]


def read_queries(rows: list[tuple[int, int | None, str]]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    held = []
    for query, item_id, text in rows:
        counts = Counter(terms(text))
        numbers = [vocabulary.setdefault(term, len(vocabulary)) for term in counts]
        held.append((query, item_id, np.array(numbers, dtype=np.int64), np.array(list(counts.values()), dtype=np.int64)))
    return Queries(vocabulary, held)


def blocks(docs: DataFrame, queries, block_docs: int, block_postings: int) -> DataFrame:
    """The index: a row per block."""

    def run(rows):
        vocabulary = queries.value.vocabulary
        ids, lengths, term, doc, count = [], [], [], [], []

        def block() -> tuple:
            order = np.argsort(np.array(term, dtype=np.int32), kind="stable")
            sorted_terms = np.array(term, dtype=np.int32)[order]
            found, sizes = np.unique(sorted_terms, return_counts=True)
            return (
                np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
                np.array([i is not None for i in ids], dtype=bool).tobytes(),
                np.array(lengths, dtype="<i8").tobytes(),
                found.tolist(), sizes.tolist(),
                np.array(doc, dtype="<i4")[order].tobytes(),
                np.array(count, dtype="<i8")[order].tobytes(),
            )

        for doc_id, text in rows:
            words = terms(text)
            if not words:
                continue
            counts = Counter(words)
            held = counts.keys() & vocabulary.keys()
            term.extend(map(vocabulary.__getitem__, held))
            count.extend(map(counts.__getitem__, held))
            doc.extend([len(ids)] * len(held))
            ids.append(doc_id)
            lengths.append(len(words))
            if len(ids) >= block_docs or len(doc) >= block_postings:
                yield block()
                ids, lengths, term, doc, count = [], [], [], [], []
        if ids:
            yield block()

    return map_rows(texts(docs), run, INDEX, size=1)


class Statistics(NamedTuple):
    documents: int
    terms: int
    weights: np.ndarray  # per term of the vocabulary


def statistics(index: DataFrame, vocabulary: int) -> Statistics:
    """Sums over all blocks; the table of terms is no larger than the slice of queries."""

    def run(rows):
        for (lengths,) in rows:
            held = np.frombuffer(lengths, dtype="<i8")
            yield len(held), int(held.sum())

    sums = map_rows(index.select("lengths"), run, "documents long, terms long")
    documents, total = sums.agg(F.sum("documents"), F.sum("terms")).first()
    holding = np.zeros(vocabulary, dtype=np.int64)
    lists = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("list"))
    for term, n in lists.groupBy("list.terms").agg(F.sum("list.sizes")).collect():
        holding[term] = n
    weights = np.floor(1000 * np.log((2 * (documents or 0) + 2) / (2 * holding + 1))).astype(np.int64)
    return Statistics(documents or 0, total or 0, weights)


def normalised(lengths: np.ndarray, known: Statistics) -> np.ndarray:
    """A document's length against the mean, in hundredths, a quarter of it counting."""
    if 25 * int(lengths.max(initial=0)) * known.documents > LONG.max:
        return np.array([75 + 25 * int(n) * known.documents // known.terms for n in lengths], dtype=np.int64)
    return 75 + 25 * lengths * known.documents // known.terms


class Postings(NamedTuple):
    """Documents of a block in order, and what each adds to the score."""

    docs: np.ndarray
    scores: np.ndarray

    @property
    def bound(self) -> int:
        return int(self.scores.max(initial=0))

    def between(self, low: int, high: int) -> Postings:
        first, last = np.searchsorted(self.docs, [low, high])
        return Postings(self.docs[first:last], self.scores[first:last])


def summed(lists: list[Postings]) -> Postings:
    """One list with the sums of several."""
    if len(lists) < 2:
        return lists[0] if lists else Postings(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
    docs = np.concatenate([p.docs for p in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], np.concatenate([p.scores for p in lists])[order]
    cuts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return Postings(docs[cuts], np.add.reduceat(scores, cuts))


def candidates(lists: list[Postings], least: int) -> Postings:
    """Documents of some lists, each with its whole score, none missing whose score reaches `least` (1 or more)."""
    lists = sorted((p for p in lists if len(p.docs)), key=lambda p: -p.bound)
    # What the lists from each one on can add together.
    after = np.cumsum([0, *(p.bound for p in reversed(lists))])[::-1].tolist()
    if after[0] < least:
        return summed([])
    # A document of none but the lists from `naming` on stays below.
    naming = next(i for i, rest in enumerate(after) if rest < least)
    docs, scores = summed(lists[:naming])
    for i in range(naming, len(lists)):
        alive = scores + after[i] >= least
        if not alive.all():
            docs, scores = docs[alive], scores[alive]
        if not len(docs):
            break
        other = lists[i]
        at = np.minimum(np.searchsorted(other.docs, docs), len(other.docs) - 1)
        scores = scores + np.where(other.docs[at] == docs, other.scores[at], 0)
    return Postings(docs, scores)


class Best:
    """The k best documents of a query so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.known, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """The least score that still matters."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        scores = np.concatenate([self.scores, scores[good]])
        known, ids = np.concatenate([self.known, known[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.known, self.ids = scores[order], known[order], ids[order]


class Block:
    """Postings of a block with their impacts."""

    def __init__(self, row: tuple, known: Statistics):
        ids, has_id, lengths, found, sizes, docs, counts = row
        self.ids, self.known = np.frombuffer(ids, dtype="<i8"), np.frombuffer(has_id, dtype=bool)
        lengths = normalised(np.frombuffer(lengths, dtype="<i8"), known)
        docs, counts = np.frombuffer(docs, dtype="<i4"), np.frombuffer(counts, dtype="<i8")
        weights = np.repeat(known.weights[found], sizes) if found else np.zeros(0, dtype=np.int64)
        impacts = weights * (1_000_000_000 * counts // (1000 * counts + 12 * lengths[docs]))
        ends = np.cumsum([0, *sizes])
        self.lists = {t: Postings(docs[a:b], impacts[a:b]) for t, a, b in zip(found, ends, ends[1:])}

    def search(self, numbers: np.ndarray, times: np.ndarray, best: Best, stretch: int, short_share: float) -> None:
        short, long = [], []
        for number, n in zip(numbers.tolist(), times.tolist()):
            if held := self.lists.get(number):
                held = held if n == 1 else Postings(held.docs, n * held.scores)
                (short if len(held.docs) <= short_share * len(self.ids) else long).append(held)
        lists = [summed(short), *long]
        if sum(p.bound for p in lists) < best.least:
            return
        for low in range(0, len(self.ids), stretch):
            part = [p.between(low, low + stretch) for p in lists]
            docs, scores = candidates(part, best.least)
            if len(docs):
                best.add(scores, self.known[docs], self.ids[docs])


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, slice_bytes: int = 16 << 20, block_docs: int = BLOCK_DOCS,
    block_postings: int = BLOCK_POSTINGS, stretch: int = STRETCH, short_share: float = SHORT_SHARE,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item, scores above 0 only."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    asked = items.select(
        F.monotonically_increasing_id().alias("query"), F.col("item_id").cast("long").alias("item_id"), text.alias("text")
    )
    asked = stage(asked.where(text != ""), "queries")
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    slices = -(-size // slice_bytes)

    def results(number: int) -> DataFrame:
        part = asked.where(F.pmod(F.xxhash64("query"), F.lit(slices)) == number)
        queries = read_queries([tuple(r) for r in part.orderBy("query").collect()])
        sent = spark.sparkContext.broadcast(queries)
        index = stage(blocks(docs, sent, block_docs, block_postings), "index")
        known = statistics(index, len(queries.vocabulary))
        shared = spark.sparkContext.broadcast(known)

        def run(rows):
            held = sent.value.rows
            best = [Best(k) for _ in held]
            for row in rows:
                block = Block(row, shared.value)
                for (*_, numbers, times), found in zip(held, best):
                    block.search(numbers, times, found, stretch, short_share)
            for (query, item_id, *_), found in zip(held, best):
                for score, has_id, doc_id in zip(found.scores.tolist(), found.known.tolist(), found.ids.tolist()):
                    yield query, item_id, doc_id if has_id else None, score

        found = stage(map_rows(index, run, RESULT), "found")
        for variable in (sent, shared):
            variable.unpersist()
        return found

    empty = spark.createDataFrame([], RESULT)
    found = reduce(DataFrame.unionAll, map(results, range(slices)), empty)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["query", "salt"], ["query"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))) if "salt" in keys else found
        found = salted.withColumn("rank", place).where(F.col("rank") <= k).select(*found.columns, "rank")
        found = found if keys == ["query"] else found.drop("rank")
    return found.select("item_id", "rank", "doc_id", "score")
