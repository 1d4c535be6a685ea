"""Languages of texts by hierarchical discrimination: the family first, then one language of it.

Features are runs of 2 to 5 bytes within words, in lower case, with a space before and after each word, hashed
into `1 << HASH_BITS` places. A text's family is the one with the greatest mean log-probability of its features (naive
Bayes with smoothing). Within a family, each two languages have a linear support vector machine on the shares of the
features; a text takes the language with most votes, of equal ones that with the greatest sum of margins.

Families are those of FAMILIES; a language that is not listed there is a family of its own. Models are fitted on at most `sample`
documents of each language, those of least text hash, which go to the driver as numbers of features. Documents are judged by their whole texts.
Weights are whole numbers, so sums do not depend on how texts are put together for the work.

A text that is null or has no letter is `und` with score 0, and so is every text where no language was learned. Labels that are null
or empty are ignored, and so are rows without doc_id, whose hash is unknown: they are neither learned from nor held out. The score is
the probability of the family, tempered, times the least probability that its language wins against another of the family. Every row gives
one row, repeated ones too; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleward.llm.batches import texts
from sampleward.llm.flat import SPACE, Slice, slices, words

UNKNOWN = "und"
HASH_BITS = 17
ORDERS = (2, 3, 4, 5)
# Features that are worked on at once, and parts in which weights are counted.
CHUNK, UNIT = 1 << 18, 1 << 20

# Families of ISO 639-1 codes.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "semitic": ["am", "ar", "he", "mt"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "malay": ["id", "jv", "mg", "ms", "su", "tl"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

ASCII_LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
LETTERS = np.array(
    [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else SPACE for b in range(256)], dtype=np.uint8
)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def lower(batch: pa.RecordBatch, column: int) -> pa.RecordBatch:
    """The batch with a column of texts in lower case."""
    lowered = pc.utf8_lower(batch.column(column).fill_null(""))
    return batch.set_column(column, batch.schema.field(column).name, lowered)


def places(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, place) of all features of a slice's texts, a bounded number at once, in the order of texts within each."""
    found = words(part, LETTERS)
    # A space before each word as well: that of the word before, but for the first one.
    data = np.concatenate([np.full(1, SPACE, np.uint8), found.data, np.full(max(ORDERS), SPACE, np.uint8)])
    borders = np.concatenate([found.begins, [len(found.data)]])[found.first]  # where each text begins, in bytes
    n = len(found.data)
    for low in range(0, n, CHUNK):
        high = min(low + CHUNK, n)
        raw = data[low : high + max(ORDERS)].astype(np.uint64)
        text = np.searchsorted(borders, np.arange(low, high), side="right") - 1
        code, inside = raw[: high - low].copy(), np.ones(high - low, dtype=bool)
        for order in range(2, max(ORDERS) + 1):
            if order > 2:  # the byte that is now within the run
                inside &= raw[order - 2 : order - 2 + high - low] != SPACE
            code |= raw[order - 1 : order - 1 + high - low] << np.uint64(8 * (order - 1))
            if order in ORDERS:
                hashed = ((code ^ np.uint64(order << 56)) * FACTOR) >> np.uint64(64 - HASH_BITS)
                yield text[inside], hashed[inside].astype(np.int64)


def has_letter(part: Slice, column: pa.Array) -> np.ndarray:
    """Per text of a slice, whether it holds a letter of any script."""
    counts = np.concatenate([[0], np.cumsum(ASCII_LETTERS[part.data])])
    found = counts[part.starts[1:]] > counts[part.starts[:-1]]
    for i in np.flatnonzero(~found & (np.diff(part.starts) > 0)):
        found[i] = any(map(str.isalpha, column[int(i)].as_py()))
    return found


class Pair(NamedTuple):
    """Which of two languages: a positive margin speaks for the first."""

    first: int
    second: int
    weights: np.ndarray
    bias: float


class Model(NamedTuple):
    langs: list[str]
    families: list[list[int]]  # languages by number
    log_odds: np.ndarray  # per family and place, in units
    pairs: list[Pair]


def in_units(weights: np.ndarray) -> np.ndarray:
    return np.round(weights * UNIT).astype(np.int64)


def support_vectors(rows: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, rounds: int = 60, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights per share of a feature and a bias, by least squared hinge loss with an L2 penalty.

    rows are places and counts; first tells which of them are of the first language. Shares are scaled by the
    square roots of their means. Both languages count alike. Accelerated gradient steps over all rows.
    """
    counts = np.array([len(p) for p, _ in rows])
    used, local = np.unique(np.concatenate([p for p, _ in rows]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    shares = np.concatenate([c / c.sum() for _, c in rows])
    mean = np.bincount(local, shares, minlength=len(used)) / len(rows)
    scale = 1 / np.sqrt(mean + 1e-5)
    values, sign = shares * scale[local], np.where(first, 1.0, -1.0)
    weight = len(rows) / (2 * np.where(first, first.sum(), (~first).sum()))
    owner = np.repeat(np.arange(len(rows)), counts)
    # The step is safe by the greatest squared length of a row.
    step = 1 / (2 * (weight.max() * (np.bincount(owner, values**2).max() + 1)) + penalty)
    w, b = np.zeros(len(used)), 0.0
    seen_w, seen_b, t = w, b, 1.0
    for _ in range(rounds):
        margin = sign * (np.add.reduceat(values * seen_w[local], starts) + seen_b)
        slope = -2 * weight * sign * np.maximum(0, 1 - margin) / len(rows)
        next_w = seen_w - step * (np.bincount(local, values * slope[owner], minlength=len(used)) + penalty * seen_w)
        next_b = seen_b - step * slope.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        seen_w, seen_b = next_w + (before - 1) / t * (next_w - w), next_b + (before - 1) / t * (next_b - b)
        w, b = next_w, next_b
    weights = np.zeros(1 << HASH_BITS)
    weights[used] = w * scale
    return weights, b


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """The model of rows (language, places, counts)."""
    langs = sorted({lang for lang, *_ in rows})
    groups: dict[str, list[int]] = {}
    for number, lang in enumerate(langs):
        groups.setdefault(family(lang), []).append(number)
    families = [groups[name] for name in sorted(groups)]
    of = {lang: [(p, c) for held, p, c in rows if held == lang] for lang in langs}
    log_odds = np.zeros((len(families), 1 << HASH_BITS), dtype=np.int64)
    for i, numbers in enumerate(families):
        counts = np.full(1 << HASH_BITS, 0.5)
        # Languages count alike, and so do documents.
        for number in numbers:
            for p, c in of[langs[number]]:
                counts[p] += 1000 * c / c.sum() / len(of[langs[number]])
        log_odds[i] = in_units(np.log(counts / counts.sum()))
    pairs = []
    for numbers in families:
        for a, b in combinations(numbers, 2):
            both = of[langs[a]] + of[langs[b]]
            first = np.arange(len(both)) < len(of[langs[a]])
            weights, bias = support_vectors(both, first)
            pairs.append(Pair(a, b, in_units(weights), bias))
    return Model(langs, families, log_odds, pairs)


def sums(part: Slice, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of features, and the sums of what each table gives for them."""
    n = len(part.starts) - 1
    count, total = np.zeros(n, dtype=np.int64), np.zeros((len(tables), n), dtype=np.int64)
    for text, place in places(part):
        if not len(text):
            continue
        cuts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        count[text[cuts]] += np.diff([*cuts, len(text)])
        for i, table in enumerate(tables):
            total[i, text[cuts]] += np.add.reduceat(table[place], cuts)
    return count, total


def predict(model: Model, part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of its language, and the score."""
    count, total = sums(part, list(model.log_odds) + [pair.weights for pair in model.pairs])
    n = np.maximum(count, 1)
    means = total / UNIT / n
    logs = means[: len(model.families)] * np.minimum(n, 50)
    chances = np.exp(logs - logs.max(axis=0))
    chances = chances / chances.sum(axis=0)
    chosen = total[: len(model.families)].argmax(axis=0)
    margins = {(p.first, p.second): m + p.bias for p, m in zip(model.pairs, means[len(model.families) :])}
    lang, score = np.zeros(len(count), dtype=np.int64), np.zeros(len(count))
    for i, numbers in enumerate(model.families):
        of = {}
        for number in numbers:
            sides = [m if a == number else -m for (a, b), m in margins.items() if number in (a, b)]
            of[number] = np.array(sides).reshape(len(sides), len(count))
        votes = np.array([(side > 0).sum(axis=0) for side in of.values()])
        strength = np.array([side.sum(axis=0) for side in of.values()])
        # Most votes, then the greatest margins, then the first by name.
        most = votes == votes.max(axis=0)
        winner = np.where(most, strength, -np.inf).argmax(axis=0)
        least = np.array([1 / (1 + np.exp(-np.clip(4 * side, -40, 40).min(axis=0, initial=40.0))) for side in of.values()])
        here = chosen == i
        lang[here] = np.array(numbers)[winner[here]]
        score[here] = chances[i, here] * least[winner[here], np.flatnonzero(here)]
    return lang, score


def remainder(folds: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def train(docs: DataFrame, sample: int = 600, folds: int = 5) -> Model:
    """The model of at most `sample` documents of each language, none of them held out."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).where((F.col("text") != "") & (F.col("lang") != "") & (remainder(folds) != 0))
    known = known.withColumn("hash", F.xxhash64("text", "doc_id"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # a row a language
    if not counts:
        return fit([])
    # Hashes up to a mark that lets enough through: a task gives few rows, not `sample` whole texts of each language.
    mark = F.lit(None).cast("long")
    for lang, n in sorted(counts.items()):
        share = min(1.0, 2.0 * sample / n + 50 / n)
        mark = F.coalesce(mark, F.when(F.col("lang") == lang, F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    chosen = known.where(F.col("hash") <= mark).withColumn("place", place).where(F.col("place") <= sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(lower(batch, 1), 1, 0):  # one text at a time
                held = np.zeros(1 << HASH_BITS, dtype=np.int64)
                for _, place in places(part):
                    held += np.bincount(place, minlength=len(held))
                used = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.rows.column(0),
                        pa.array([used.astype("<i4").tobytes()], pa.binary()),
                        pa.array([held[used].astype("<i4").tobytes()], pa.binary()),
                    ],
                    names=["lang", "places", "counts"],
                )

    found = chosen.select("lang", "text").mapInArrow(run, "lang string, places binary, counts binary")
    rows = sorted((r.lang, bytes(r.places), bytes(r.counts)) for r in found.toLocalIterator())
    held = [(lang, *(np.frombuffer(x, dtype="<i4").astype(np.int64) for x in numbers)) for lang, *numbers in rows]
    return fit([row for row in held if len(row[1])])


def identify(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(lower(batch, 1), 1):
                known = has_letter(part, part.rows.column(1))
                if model.langs:
                    lang, score = predict(model, part)
                else:
                    known = np.zeros(len(known), dtype=bool)
                    lang, score = known.astype(np.int64), known.astype(float)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.rows.column(0),
                        part.rows.column(2),
                        pa.array(names[np.where(known, lang, len(names) - 1)], pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    held_out = F.coalesce(remainder(folds) == 0, F.lit(False)).alias("held_out")
    return texts(docs).select("doc_id", "text", held_out).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )
