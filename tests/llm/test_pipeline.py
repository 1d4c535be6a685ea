"""The classifier, near-duplicate documents and the pipeline on small fixtures."""

import math
import random

import numpy as np

import corpus_pipeline
from helpers import ODD, documents, words
from sampleward.llm import quality, secret_scan, simhash
from sampleward.sources.shared import stage


def labelled(spark, n=240):
    """Plain texts, texts full of marks, and plain texts with a bad word."""
    draw, rows, labels = random.Random(3), [], []
    for i in range(n):
        text = words(i, 60 + draw.randrange(80), 300)
        kind = i % 6
        if kind == 0:
            text = " ".join(f"{w}###" for w in text.split(" "))
        elif kind == 1:
            text += " foulword " + words(i + 9000, 20, 300)
        rows.append((i, text))
        labels.append((i, int(kind != 0), int(kind == 1)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_grades(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows)
    model = quality.train(docs, labels.where("doc_id < 160"))
    assert (np.diff(model.thresholds) > 0).all()
    found = {r.doc_id: r for r in quality.grade(docs, model).collect()}
    assert sum(found[i].keep == (i % 6 > 1) for i in range(160, 240)) >= 76
    for i in range(160, 240):
        assert 0 <= found[i].p_good <= found[i].p_usable <= 1
        assert abs(found[i].expected_grade - found[i].p_good - found[i].p_usable) < 1e-9


def test_cumulative_link_gradient_orders_three_grades():
    draw = random.Random(1)
    rows = [np.array([g, 10 + draw.randrange(30)]) for g in (0, 1, 2) for _ in range(60)]
    grades = np.repeat([0, 1, 2], 60)
    model = quality.fit(rows, grades)
    expected = [model.tails(float(model.weights[r].sum())).sum() for r in rows]
    means = [np.mean(expected[k * 60 : k * 60 + 60]) for k in range(3)]
    assert means[0] < 0.5 < means[1] < 1.5 < means[2]


def plain_objective(rows, grades, weights, thresholds):
    """Mean weighted log-likelihood, each grade counting alike."""
    shares = {g: len(grades) / (3 * list(grades).count(g)) for g in set(grades)}
    total = 0.0
    for row, g in zip(rows, grades):
        score = sum(weights[i] for i in row)
        above = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds), 0.0]
        total += shares[g] * math.log(above[g] - above[g + 1])
    return total / len(rows)


def test_fit_is_the_maximum_of_the_plain_likelihood():
    draw = random.Random(2)
    rows, grades = [], []
    for _ in range(300):
        row = [i for i in range(6) if draw.random() < 0.5]
        noisy = sum((0.9, -0.7, 0.5, 0.0, -0.4, 0.2)[i] for i in row) + draw.gauss(0, 1.2)
        rows.append(np.array(row, dtype=np.int64))
        grades.append(0 if noisy < -0.3 else 1 if noisy < 0.6 else 2)
    model = quality.fit(rows, np.array(grades), rounds=1500, penalty=0.0, least_rows=1, least_distance=0.0)
    best = plain_objective(rows, grades, model.weights, model.thresholds)
    for _ in range(60):
        weights, thresholds = model.weights[:6].astype(float), model.thresholds.copy()
        if draw.random() < 0.7:
            weights[draw.randrange(6)] += draw.choice([-0.2, -0.05, 0.05, 0.2])
        else:
            thresholds[draw.randrange(2)] += draw.choice([-0.1, 0.1])
        assert plain_objective(rows, grades, weights, thresholds) < best + 1e-4


def test_scores_equal_plain_sums(spark):
    rows, labels = labelled(spark, 120)
    docs = documents(spark, [*rows, (500, None), (501, " ".join(ODD))])
    model = quality.train(docs, labels)
    for r in quality.grade(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        words = (r.text or "").split()
        names = {"w:" + w.lower().strip(quality.MARKS) for w in words} | set(quality.style(words, r.text or ""))
        score = sum(float(model.weights[place]) for place in {quality.place(n) for n in names})
        tails = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert abs(r.p_usable - tails[0]) < 1e-5 and abs(r.p_good - tails[1]) < 1e-5 and abs(r.expected_grade - sum(tails)) < 1e-5


def test_a_labelled_id_on_many_rows_counts_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, grades: seen.append(len(rows)))
    many = spark.range(60_000).selectExpr("IF(id < 40, id, 7) AS doc_id", "concat('word ', id) AS text")
    labels = spark.range(40).selectExpr("id AS doc_id", "1 AS quality", "int(id % 2) AS toxic")
    quality.train(many, labels)
    quality.train(many, labels, sample=10)
    assert seen == [40, 10]


def test_odd_documents_and_labels(spark):
    rows = [*enumerate(ODD), (50, None), (50, None), (None, "x y z")]
    docs = documents(spark, rows).selectExpr("*", "1 AS grade", "2 AS keep")
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, 0, 1), (1, 1, 0), (2, None, 0), (None, 1, 1), (77, 1, 0), (50, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.train(docs, labels)
    assert quality.grade(docs, model).count() == len(rows)
    assert quality.select(docs, model).columns == docs.columns
    unknown = quality.train(docs, labels.limit(0))
    assert all(r.keep for r in quality.grade(docs, unknown).collect())
    assert quality.select(docs, unknown).count() == len(rows)
    assert quality.grade(docs.limit(0), model).count() == 0


def near_rows():
    draw, rows = random.Random(5), []
    for group in range(15):
        base = words(group, 900, 10**6).split(" ")
        for _ in range(4):
            copy = list(base)
            for _ in range(draw.randrange(0, 3)):
                copy[draw.randrange(len(copy))] = "zz"
            rows.append(" ".join(copy))
    rows += [words(1000 + i, 120, 10**6) for i in range(60)]  # alone
    half = words(5000, 150, 10**6)
    rows += [f"{half} {words(6000 + i, 150, 10**6)}" for i in range(6)]  # similar by a third
    draw.shuffle(rows)
    return rows


def test_distinct_documents_equal_brute_force(spark):
    texts = [*near_rows(), *ODD, None, "  ", "A a", "a  A"]
    rows = list(enumerate(texts)) + [(7, texts[7]), (7, texts[7]), (None, texts[9]), (None, "alone without id"), (None, "alone without id")]
    docs = documents(spark, rows).selectExpr("*", "'x' AS node", "'y' AS fingerprint", "'z' AS root", "1 AS place")
    prints = [simhash.simhash(simhash.shingle_hashes(t or "", 3)) & (1 << 64) - 1 for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    classes = {}
    for i, (d, t) in enumerate(rows):
        classes.setdefault(root(i), []).append((d is None, -1 if d is None else d, t))
    want = sorted(min(c, key=lambda r: r[:2])[:2] for c in classes.values())
    assert len(rows) - len(want) > 30
    # Rows with and without places in files, in shards of one tree and of many, of one block and of four.
    written = stage(docs.repartition(5))
    for source, setting in [(docs, {}), (written, {"tree_size": 2}), (written, {"blocks": 6})]:
        got = simhash.distinct_documents(source, **setting)
        assert got.columns == docs.columns
        assert sorted((r.doc_id is None, -1 if r.doc_id is None else r.doc_id) for r in got.collect()) == want
    assert simhash.distinct_documents(docs.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rows, labels = labelled(spark, 120)
    clean = [i for i, _ in rows if i % 6 > 1]
    copies = [(1000 + k, rows[i][1]) for k, i in enumerate(clean[:5])]
    secret = [(2000, words(77, 90, 300) + " password = abcdefgh1 " + words(78, 40, 300))]
    table = documents(spark, [*rows, *copies, *secret])
    table.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, str(tmp_path))
        assert out.columns == table.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r.doc_id: r for r in docs.collect()})
    after_quality, after_copies, after_secrets = kept
    assert set(after_quality) == {*clean, *(i for i, _ in copies), 2000}
    assert set(after_copies) == set(after_secrets) == {*clean, 2000}
    assert "abcdefgh1" not in after_secrets[2000].text and secret_scan.MASK in after_secrets[2000].text
    assert all(r.n_chars == len(r.text) for r in after_secrets.values())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(after_secrets)
    assert all(p.length & (p.length - 1) == 0 for p in pieces)
