"""Near-duplicates, sharding, fingerprints and top-k against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import xxhash

from helpers import ODD, documents, odd_documents, words
from sampleward.llm import components, sharding, simhash, sketches, topk


def edited(text, draw, most=3):
    parts = text.split(" ")
    for _ in range(draw.randrange(most)):
        parts[draw.randrange(len(parts))] = "zz"
    return " ".join(parts)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (7, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots) == 201 + 100
    assert all(roots[n] == (0 if n <= 200 else 1000) for n in roots)


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = [p for p in re.split("[ \t-\r]+", lower) if p]
    runs = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(3)
    near = [edited(words(k, 150), draw) for k in range(12) for _ in range(9)]
    rows, df = odd_documents(spark, near)
    prints = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = [(d, f"{prints[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows)]
    for tree_size, blocks in ((2048, None), (2, None), (2, 6), (2048, 5)):
        got = simhash.near_duplicates(df, tree_size=tree_size, blocks=blocks).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_bk_tree_finds_all_within_the_radius():
    draw, tree = random.Random(8), simhash.BKTree()
    base = [draw.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(5))) for b in base for _ in range(20)}
    for p in prints:
        tree.add(p & (1 << 64) - 1)
    for probe in list(prints)[:100]:
        for radius in (0, 2, 5):
            got = {tree.prints[i] for i in tree.near(probe, radius)}
            assert got == {p for p in tree.prints if (p ^ probe).bit_count() <= radius}


def least_capacity(sizes, shards):
    low, high = max([*sizes, 0]), sum(sizes)
    while low < high:
        middle, used, held = (low + high) // 2, 1, 0
        for s in sizes:
            if held + s > middle:
                used, held = used + 1, 0
            held += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_sharding_is_minimax_and_keeps_groups_together(spark):
    draw = random.Random(6)
    texts = [words(draw.randrange(150), draw.randrange(1, 80), 30) for _ in range(500)] + ["giant " * 50] * 150
    rows, df = odd_documents(spark, texts)
    for shards in (1, 4, 24):
        found = sharding.shard(df, shards=shards).collect()
        want = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows]
        assert sorted(map(str, ((r.doc_id, r.size, r.text_crc32) for r in found))) == sorted(map(str, want))
        slots, load, groups = defaultdict(list), defaultdict(int), defaultdict(set)
        for r in found:
            slots[r.shard].append(r.slot)
            load[r.shard] += r.size
            groups[r.text_crc32, r.size].add(r.shard)
            assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(len(s) == 1 for s in groups.values())
        by_hash = defaultdict(int)
        for _, t in rows:
            signed = xxhash.xxh64_intdigest((t or "").encode(), 42)
            by_hash[signed - (1 << 64) if signed >> 63 else signed] += len((t or "").encode()) + 8
        assert max(load.values()) == least_capacity([by_hash[h] for h in sorted(by_hash)], shards)
    assert sharding.shard(df.limit(0)).count() == 0


def shingle_set(text):
    parts = [p for p in re.split("[ \t-\r]+", (text or "").lower()) if p]
    if len(parts) < 5:
        return {tuple(parts)} if parts else set()
    return {tuple(parts[i : i + 5]) for i in range(len(parts) - 4)}


def test_fingerprints(spark):
    texts = [words(i // 3, 60 + 100 * (i % 2), 5000) for i in range(40)] + [words(99, 4000, 10**6)]
    rows = list(enumerate([*ODD, None, *texts]))
    random.Random(1).shuffle(rows)
    found = sketches.fingerprints_digest(sketches.edited_fingerprints(documents(spark, rows))).collect()
    text = dict(rows)
    assert sorted(r.doc_id for r in found) == list(range(len(rows)))
    ids = sorted(text)
    errors = []
    for r in found:
        own, following = text[r.doc_id] or "", text[ids[(ids.index(r.doc_id) + 1) % len(ids)]] or ""
        cut = len(own) // 4
        edit = own[: len(own) - cut] + following[:cut]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert (r.fingerprint == "") == (not own.split())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b, c = shingle_set(own), shingle_set(edit), shingle_set(following)
        if len(a) > 100:
            errors.append(r.near_edited - len(a & b) / len(a | b))
        if a and a == c:
            assert r.near_next == 1.0
        if not a & c and a | c:
            assert r.near_next == 0.0
    assert abs(sum(errors)) / len(errors) < 0.05 and max(map(abs, errors)) < 0.35
    prints = defaultdict(set)
    for r in found:
        prints[text[r.doc_id] or ""].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_odd_tables(spark):
    rows, df = odd_documents(spark)
    found = sketches.edited_fingerprints(df).collect()
    assert len(found) == len(rows)
    at_3 = [r for r in found if r.doc_id == 3]
    assert len(at_3) == 3 and len({r.edited for r in at_3}) == 1
    none = [r for r in found if r.doc_id is None]  # nulls come first, so document 0 is next
    assert sorted(r.n_chars for r in none) == [0, 5] and all(r.next_sketch == [] for r in none)
    assert sketches.edited_fingerprints(df.limit(0)).count() == 0
    alone = sketches.edited_fingerprints(documents(spark, [(5, "abcdefgh")])).first()
    assert alone.edited == "abcdefab"


def test_sketches_merge_and_contain(spark):
    long, short = words(1, 3000, 10**6), words(1, 3000, 10**6).split(" ")
    rows = [(long, " ".join(short[:1000]), " ".join(short[996:]))]
    df = spark.createDataFrame(rows, "whole string, part string, rest string")
    for name in ("whole", "part", "rest"):
        df = sketches.with_sketch(df, name, f"{name}_sketch")
    merged = sketches.merge(df.part_sketch, df.rest_sketch)
    row = df.select(
        sketches.containment(df.part_sketch, df.whole_sketch).alias("inside"),
        sketches.likeness(df.part_sketch, df.whole_sketch).alias("like"),
        sketches.likeness(merged, df.whole_sketch).alias("union"),
    ).first()
    assert row.inside == 1.0 and abs(row.like - 1 / 3) < 0.1 and row.union == 1.0


def slow_sketch(shingles, fraction=1 / 4):
    """The hashes of a set of shingles that lie below the fraction, and the least one."""
    hashes = set()
    for shingle in shingles:
        at = 42
        for word in shingle:
            at = xxhash.xxh64_intdigest(xxhash.xxh64_intdigest(word.encode(), 42).to_bytes(8, "little"), at)
        hashes.add((at - (1 << 64) if at >> 63 else at) >> 32)
    below = sketches.LEAST + int(fraction * (1 << 32))
    return sorted({h for h in hashes if h < below} | ({min(hashes)} if hashes else set()))


def test_sketches_equal_brute_force(spark):
    texts = [*ODD, *(words(i, i % 9, 40) for i in range(60)), words(7, 3000, 10**6), "Naïve ÉTÉ\x0b b c d e  f"]
    rows = [(i, t or "") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for fraction in (1 / 4, 1 / 64, 1.0):
        found = sketches.with_sketch(df, "text", "sketch", fraction=fraction)
        found = found.withColumn("print", sketches.fingerprint(found.sketch))
        for r in found.collect():
            want = slow_sketch(shingle_set(r.text), fraction)
            assert r.sketch == want, r.text
            assert r.print == "".join(f"{h - sketches.LEAST:08x}" for h in want)


def test_merged_sketches_equal_those_made_at_once(spark):
    # Texts of one to nine words, of which many have no hash below the fraction.
    texts = ["", *(words(i, 1 + i % 9, 10**6) for i in range(40))]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    for fraction in (1 / 4, 1 / 16):
        df = pairs
        for name in "ab":
            df = sketches.with_sketch(df, name, f"{name}_sketch", fraction=fraction)
        merged = df.withColumn("merged", sketches.merge(df.a_sketch, df.b_sketch, fraction)).collect()
        want = [slow_sketch(shingle_set(r.a) | shingle_set(r.b), fraction) for r in merged]
        assert [r.merged for r in merged] == want
        below = sketches.threshold(fraction)
        assert any(r.a_sketch and r.a_sketch[0] >= below > r.b_sketch[0] for r in merged if r.b_sketch)


def slow_top_k(rows, every, k):
    valid = []
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            valid.append((n, i, [math.floor(256 * x) for x in v]))
    out = []
    for n, i, v in valid:
        if i % every == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j) for m, j, w in valid if m != n]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    draw = random.Random(9)
    vectors = [[draw.gauss(0, 1) for _ in range(20)] for _ in range(300)]
    vectors += [vectors[7]] * 30 + [[1.0, 2.0], [], None, [1.0, None], [float("nan")] * 20, [float("inf")]]
    rows = [*enumerate(vectors), (None, vectors[1]), (10, vectors[2]), (10, vectors[2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS row")
    for block, seed in ((8192, 512), (16, 3)):
        monkeypatch.setattr(topk, "BLOCK_ROWS", block)
        monkeypatch.setattr(topk, "SEED_ROWS", seed)
        for slice_bytes in (1 << 24, 2000):
            got = topk.top_k(df, k=5, every=10, slice_bytes=slice_bytes).collect()
            assert sorted(map(tuple, got)) == slow_top_k(rows, 10, 5)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    rows = [(0, [3e6, 1e6]), (1, [4e6, -2e6]), (2, [1e6, 5e6]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, k=2).collect())) == slow_top_k(rows, 50, 2)
    few = spark.createDataFrame(rows[:2], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few).collect()] == slow_top_k(rows[:2], 50, 5)


def test_search_compacts_but_loses_nothing():
    draw = random.Random(2)
    import numpy as np

    values = np.array([[draw.randrange(-300, 300) for _ in range(2000)] for _ in range(64)])
    block = topk.Block(np.arange(2000), np.arange(2000), values)
    search = topk.Search([(5, 5, values[:, 5].tolist())], 5)
    search.add(block)
    scores = values[:, 5] @ values
    want = sorted((-int(s), i) for i, s in enumerate(scores) if i != 5)[:5]
    assert search.best[0] == want
