"""Lexical search, resampling and language identification against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from helpers import documents, odd_documents, words
from sampleward.llm import flat, language, lexical, resampling


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def items(spark, texts):
    return spark.createDataFrame(texts, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "1 AS rank")


# Lexical search


def slow_search(docs, asked, k=20):
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    held = [(i, Counter(found), len(found)) for i, t in docs if (found := pattern.findall(folded(t)))]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, counts, _ in held for t in counts)
    rows = []
    for item_id, text in asked:
        scored = []
        for doc_id, counts, n in held:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = 0
            for term in pattern.findall(folded(text)):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * (1_000_000_000 * counts[term] // (1000 * counts[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            rows.append((item_id, rank, None if null else doc_id, -score))
    return sorted(map(str, rows))


def test_search_equals_brute_force(spark):
    draw = random.Random(11)
    texts = [words(i, draw.randrange(1, 120), 60) for i in range(150)] + [words(500, 40, 60)] * 30
    rows, docs = odd_documents(spark, texts)
    asked = [
        (1, "w1 w2 w3 w59 w59"), (2, words(77, 30, 60)), (3, None), (4, ""), (5, "nowhere"), (6, "W1, w2; ab a A é"),
        (7, words(500, 40, 60)), (7, "w3"), (7, "w3"), (None, "w4 w5"), (9, " .. "),
    ]
    want = slow_search(rows, asked)
    settings = [
        {}, {"block_docs": 7, "stretch": 3, "short_share": 1}, {"stretch": 1, "short_share": 0.5},
        {"block_postings": 50, "short_share": 0, "slice_bytes": 300},
    ]
    for setting in settings:
        found = lexical.search(docs, items(spark, asked), **setting)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(str(tuple(r)) for r in found.collect()) == want, setting


def test_search_of_empty_tables(spark):
    _, docs = odd_documents(spark)
    asked = items(spark, [(1, "word a")])
    assert lexical.search(docs.limit(0), asked).count() == 0
    assert lexical.search(docs, asked.limit(0)).count() == 0
    assert lexical.search(documents(spark, [(1, None), (2, " ")]), asked).count() == 0
    # A term in each of many documents weighs nothing.
    many = documents(spark, [(i, "a") for i in range(600)])
    assert lexical.search(many, items(spark, [(1, "a")])).count() == 0


def test_candidates_keep_all_that_reach_the_least_score():
    draw = np.random.default_rng(2)
    for _ in range(300):
        lists = []
        for _ in range(draw.integers(0, 6)):
            docs = np.flatnonzero(draw.random(30) < draw.random()).astype(np.int32)
            lists.append(lexical.Postings(docs, draw.integers(0, 20, len(docs))))
        want = Counter()
        for held in lists:
            want.update(dict(zip(held.docs.tolist(), held.scores.tolist())))
        least = int(draw.integers(1, 50))
        found = lexical.candidates(lists, least)
        got = dict(zip(found.docs.tolist(), found.scores.tolist()))
        assert all(want[d] == s for d, s in got.items())
        assert {d for d, s in want.items() if s >= least} <= set(got)


# Resampling


def slow_features(text):
    found = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded(text))
    return found, [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]


def slow_resample(docs, target, percent=5, least_words=20):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in slow_features(t)[1])

    s, t = counts(x for _, x in docs), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    rows, able = [], []
    for i, (doc_id, text) in enumerate(docs):
        found, features = slow_features(text)
        weight = 0
        for f in features:
            b = zlib.crc32(f.encode()) % 10_000
            weight += math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(features), weight, score, None])
        if len(found) >= least_words:
            able.append((-score, doc_id is None, doc_id or 0, i))
    for rank, (*_, i) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        rows[i][4] = rank
    return sorted(map(str, rows))


def test_resampling_equals_brute_force(spark):
    draw = random.Random(12)
    texts = [words(i, draw.randrange(1, 90), 300) for i in range(250)] + ["Ab " * 30, "x" * 3000 + " yy", "A-b_c 9é ÉÉ"]
    texts += [" ".join("k" * draw.randrange(100, 600) for _ in range(30))]
    rows, docs = odd_documents(spark, texts)
    target = [words(i, 50, 300) for i in range(6)] + [None, "", "word word word"]
    found = resampling.resample(docs, items(spark, enumerate(target)))
    assert sorted(str(list(r)) for r in found.collect()) == slow_resample(rows, target)
    assert found.where("rank IS NOT NULL").count() == 10
    # All of them, so that every rank is seen, and none without target texts.
    found = resampling.resample(docs, items(spark, [(1, None)]), percent=100, least_words=0)
    assert sorted(str(list(r)) for r in found.collect()) == slow_resample(rows, [], 100, 0)


def test_resampling_of_empty_tables(spark):
    _, docs = odd_documents(spark)
    assert resampling.resample(docs.limit(0), items(spark, [(1, "a b")])).count() == 0
    assert resampling.resample(docs, items(spark, [(1, "a")]).limit(0)).where("rank > 0").count() == 0


def test_crc_of_features_by_position(spark):
    draw = random.Random(13)
    texts = [None, "", " ", "a", "x" * 255, "x" * 256, "x" * 257, "x" * 513 + " y " + "z" * 300, "é É ẞ 12"]
    texts += [" ".join(draw.choice(["ab", "é", "X" * draw.randrange(1, 400), ".."]) for _ in range(draw.randrange(30))) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"text": ["dropped", *texts]}).slice(1)
    want = [sorted(zlib.crc32(f.encode()) for f in slow_features(t)[1]) for t in texts]
    for limit in (1, 100, 1 << 20):
        for chunk in (1, 3, 1 << 20):
            got = []
            for part in flat.slices(batch, 0, limit):
                found = flat.words(part, resampling.WORD_BYTES)
                held = [[] for _ in range(part.rows.num_rows)]
                for first, crcs in resampling.features(found, 3, chunk):
                    for text, crc in zip(np.searchsorted(found.first, first, side="right") - 1, crcs):
                        held[text].append(int(crc))
                got += map(sorted, held)
            assert got == want


def test_long_spans_are_folded_by_blocks():
    draw = np.random.default_rng(3)
    for n in (1, 2, 4, 255, 256, 257, 511, 512, 513, 10_000):
        span = draw.integers(0, 256, n, dtype=np.uint8)
        assert resampling.folded(span) == zlib.crc32(span.tobytes())


# Languages

ALPHABETS = {"de": "schunge", "nl": "ijkenaa", "es": "adoclas", "pt": "aosqeiç", "xx": "жзклмно"}


def invented(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    letters = ALPHABETS[lang]
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def tongues(spark):
    draw = random.Random(4)
    rows = [(i, invented(lang, i, draw.randrange(5, 60)), lang) for i, lang in enumerate(draw.choices(list(ALPHABETS), k=400))]
    rows += [(900, None, "de"), (901, "", "de"), (902, "12 !? 34", "de"), (903, "aosq eiç", None), (904, "жз", ""), (None, "schun ge", "zz")]
    rows += [(905, "SCHUNGE, SCHEN!", None), (906, invented("pt", 1, 30_000), None), (907, "日本", None), (907, "日本", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' AS source", "2.0 AS score")


def test_languages_of_held_out_texts(spark, tongues):
    rows, docs = tongues
    model = language.train(docs)
    assert model.langs == sorted(ALPHABETS)
    assert [[model.langs[i] for i in f] for f in model.families] == [["de", "nl"], ["es", "pt"], ["xx"]]
    assert [(p.first, p.second) for p in model.pairs] == [(0, 2), (1, 3)]
    found = language.identify(docs, model).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    got = {r.doc_id: r for r in found}
    for doc_id, _, lang in rows[:400]:
        assert got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        if got[doc_id].held_out:
            assert got[doc_id].lang_pred == lang
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 904, 905, 906)] == ["und", "und", "und", "pt", "xx", "de", "pt"]
    assert [got[i].score for i in (900, 901, 902)] == [0.0] * 3
    assert got[907].lang_pred in ALPHABETS and got[None].held_out is False


def test_held_out_labels_and_other_columns_change_nothing(spark, tongues):
    rows, docs = tongues
    want = sorted(map(str, language.identify(docs, language.train(docs)).collect()))
    changed = docs.selectExpr(
        "doc_id", "text", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 'en', lang) AS lang", "doc_id AS source"
    )
    model = language.train(changed)
    assert sorted(map(str, language.identify(changed.drop("lang", "source"), model).collect())) == want


def test_languages_without_labels_and_of_one_label(spark, tongues):
    _, docs = tongues
    none = language.train(docs.where("lang IS NULL"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, none).collect()} == {("und", 0.0)}
    one = language.train(docs.where("lang = 'es'"))
    assert {r.lang_pred for r in language.identify(docs, one).collect()} == {"und", "es"}
    assert language.identify(docs.limit(0), one).count() == 0


def test_bounded_sample_of_each_language(spark, tongues):
    _, docs = tongues
    model = language.train(docs, sample=12)
    found = language.identify(docs, model).where("held_out").join(docs.selectExpr("doc_id AS d", "lang"), [language.F.col("doc_id") == language.F.col("d")])
    assert found.where("lang_pred = lang").count() >= 0.9 * found.count()


def test_sums_equal_plain_features(tongues):
    rows, _ = tongues
    texts = [t for _, t, _ in rows[:60]] + ["", "a", "AB 9 ß", "x" * 20]
    draw = np.random.default_rng(5)
    table = draw.integers(-1000, 1000, 1 << language.HASH_BITS)

    def place(run):
        code = int.from_bytes(run, "little") ^ (len(run) << 56)
        return (code * int(language.FACTOR) % 2**64) >> (64 - language.HASH_BITS)

    batch = language.lower(pa.RecordBatch.from_pydict({"text": texts}), 0)
    for limit in (1, 200, 1 << 20):
        got = []
        for part in flat.slices(batch, 0, limit):
            got += zip(*(x.tolist() for x in (lambda c, t: (c, t[0]))(*language.sums(part, [table]))))
        want = []
        for text in texts:
            data = bytes(language.LETTERS[b] for b in text.lower().encode())
            runs = [
                padded[i : i + k] for w in data.split() for padded in [b" " + w + b" "] for k in language.ORDERS for i in range(len(padded) - k + 1)
            ]
            want.append((len(runs), sum(int(table[place(r)]) for r in runs)))
        assert got == want
