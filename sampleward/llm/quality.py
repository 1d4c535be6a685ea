"""Quality grades by ordinal cumulative-link regression on hashed text.

Ratings are grades 0, 1, 2, ... from worst to best. One weight per hashed feature is shared by all grades;
ordered thresholds separate them: P(grade > k) = sigmoid(score - threshold k). From it come the expected
grade and the tail probability P(grade >= wanted) by which documents are selected.

Features are a text's distinct words, in lower case and without marks at their ends, and thresholds
passed by measures of its style (share of marks, bars, capitals, repeated words, length), all hashed
into `1 << HASH_BITS` places. Weights are fitted on at most `sample` labelled documents, those of least
id hash; the sample goes to the driver as feature numbers. Every document is scored by its whole text.

Grades of the table labels: quality plus 1 if not toxic, so 2 is good and clean. Labels with nulls
are ignored; of several for one document the lowest counts. Of a labelled doc_id on several rows one text is
learned from. Null texts count as empty, texts of any length are read whole. Without labels
of two grades nothing is known: all documents then get the best grade's probability 1. Every row gives
one row, repeated ones too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleward.llm.batches import map_rows, texts
from sampleward.llm.merges import Remembered

HASH_BITS = 22
MARKS = ".,;:!?()[]{}\"'*_`<>«»¿¡"
SYMBOLS = re.compile(r"[^\w\s.,;:!?()'\"«»¿¡-]{2}")
STEPS = [0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def place(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode(), 5) >> (64 - HASH_BITS)


def _word_places(words: list[str]) -> list[int]:
    return [place("w:" + w.lower().strip(MARKS)) for w in words]


def style(words: list[str], text: str) -> Iterator[str]:
    """Names of the style thresholds that a text passes."""
    n = max(1, len(words))
    counts = Counter(words)
    shares = {
        "symbols": len(SYMBOLS.findall(text)) / n,
        "bars": (text.count("|") + text.count("#") + text.count("=")) / n,
        "exclaim": text.count("!") / n,
        "capital": sum(map(str.isupper, words)) / n,
        "repeated": 1 - len(counts) / n,
        "top": max(counts.values(), default=0) / n,
        "digits": sum(map(str.isdigit, words)) / n,
        "lines": 1 - len(set(lines := text.split("\n"))) / len(lines),
    }
    for name, share in shares.items():
        for step in STEPS:
            if share >= step:
                yield f"s:{name}>={step}"
    for power in range(len(words).bit_length()):
        yield f"s:words>={1 << power}"


class Features:
    """Places of a text's features."""

    def __init__(self):
        self.words = Remembered(_word_places)
        self.styles: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        places = self.words.of(list(set(words)))
        for name in style(words, text):
            if name not in self.styles:
                self.styles[name] = place(name)
            places.append(self.styles[name])
        return np.unique(np.array(places, dtype=np.int64))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one fewer than grades

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return sigmoid(score - self.thresholds)


def fit(
    rows: list[np.ndarray], grades: np.ndarray, rounds: int = 200, penalty: float = 2e-3,
    least_rows: int = 5, least_distance: float = 3.0,
) -> Model:
    """Maximum likelihood by Adam over all rows at once, with an L2 penalty.

    A feature is scaled by the log-odds of its presence in documents of the best grade, so that
    features which tell grades apart are penalised less; those in fewer than `least_rows` are left out, and those whose
    presence differs from chance by less than `least_distance` standard deviations.
    """
    if len(np.unique(grades)) < 2:
        return Model(np.zeros(1 << HASH_BITS, dtype=np.float32), np.full(2, -40.0))
    top = int(grades.max())
    counts = np.array([len(r) for r in rows])
    places, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), counts)
    best = grades == top
    used, local, present = np.unique(places, return_inverse=True, return_counts=True)
    in_best = np.bincount(local, best[owner], minlength=len(used))
    odds = np.log((in_best + 1) / (best.sum() + 2)) - np.log((present - in_best + 1) / ((~best).sum() + 2))
    share = best.mean()
    distance = np.abs(in_best - present * share) / np.sqrt(present * share * (1 - share))
    scale = np.where((present >= least_rows) & (distance >= least_distance), odds, 0.0)
    weights = np.zeros(len(used))
    # Thresholds begin at the grades' shares; gaps stay positive as exponentials.
    above = np.array([(np.sum(grades > k) + 1) / (len(grades) + 2) for k in range(top)])
    starts = -np.log(above / (1 - above))
    cuts = np.concatenate([starts[:1], np.log(np.maximum(np.diff(starts), 0.1))])
    state = np.concatenate([weights, cuts])
    first, second = np.zeros_like(state), np.zeros_like(state)
    # All grades count alike, however rare.
    weight = len(grades) / (len(np.unique(grades)) * np.bincount(grades)[grades])
    lower_of, upper_of = np.maximum(grades - 1, 0), np.minimum(grades, top - 1)
    for step in range(1, rounds + 1):
        weights, cuts = state[: len(used)], state[len(used) :]
        gaps = np.exp(cuts[1:])
        thresholds = cuts[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, (weights * scale)[local], minlength=len(rows))
        # P(grade) = P(>= grade) - P(>= grade + 1)
        low = np.where(grades > 0, sigmoid(score - thresholds[lower_of]), 1.0)
        high = np.where(grades < top, sigmoid(score - thresholds[upper_of]), 0.0)
        chance = np.maximum(low - high, 1e-9)
        at_low, at_high = weight * low * (1 - low) / chance, weight * high * (1 - high) / chance
        by_score = at_low - at_high
        slope = scale * np.bincount(local, by_score[owner], minlength=len(used)) / len(rows) - penalty * weights
        by_cut = np.bincount(upper_of, at_high * (grades < top), minlength=top)
        by_cut -= np.bincount(lower_of, at_low * (grades > 0), minlength=top)
        by_gap = np.cumsum(by_cut[::-1])[::-1] / len(rows)
        gradient = np.concatenate([slope, by_gap[:1], by_gap[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        state = state + 0.08 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    cuts = state[len(used) :]
    weights = np.zeros(1 << HASH_BITS, dtype=np.float32)
    weights[used] = state[: len(used)] * scale
    return Model(weights, cuts[0] + np.concatenate([[0.0], np.cumsum(np.exp(cuts[1:]))]))


def label_grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade per labelled document."""
    grade = F.col("quality").cast("int") + 1 - F.col("toxic").cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
    known = known.where("doc_id IS NOT NULL AND grade BETWEEN 0 AND 2")
    return known.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> Model:
    """Weights from at most `sample` labelled documents; the bound is on rows sent to the driver."""
    # A few thousand rows, so they may be broadcast.
    chosen = label_grades(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rated = texts(docs).join(F.broadcast(chosen), "doc_id")
    # One row per labelled document, however often its id occurs: that of least text hash.
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    rated = rated.groupBy("doc_id", "grade").agg(one).select("doc_id", "text", "grade")

    def run(rows):
        features = Features()
        for doc_id, text, grade in rows:
            yield doc_id, grade, features.of(text).astype("<i4").tobytes()

    found = map_rows(rated, run, "doc_id long, grade int, places binary")
    rows = sorted((r.doc_id, r.grade, bytes(r.places)) for r in found.toLocalIterator())
    if not rows:
        return fit([], np.array([], dtype=np.int64))
    return fit(
        [np.frombuffer(p, dtype="<i4").astype(np.int64) for *_, p in rows], np.array([g for _, g, _ in rows])
    )


def grade(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """doc_id, expected_grade, p_usable P(grade >= 1), p_good P(grade >= 2), keep (p_good >= least)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        features, model = Features(), shared.value
        for doc_id, text in rows:
            tails = model.tails(float(model.weights[features.of(text)].sum()))
            yield doc_id, float(tails.sum()), float(tails[0]), float(tails[-1]), bool(tails[-1] >= least)

    schema = "doc_id long, expected_grade double, p_usable double, p_good double, keep boolean"
    return map_rows(texts(docs), run, schema)


def select(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """The documents whose tail probability reaches `least`, with their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, model = Features(), shared.value  # kept for the whole task
        for text in parts:
            scores = [float(model.weights[features.of(t)].sum()) for t in text.fillna("")]
            yield pd.Series([bool(model.tails(s)[-1] >= least) for s in scores], dtype=bool)

    return docs.where(good(F.col("text")))
