"""Encoding, counting, packing and binary output against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import BYTE_BPE, ODD, WORD_BPE, odd_documents
from sampleward.llm import binary_output, byte_bpe, merges, packing, token_counts, word_bpe


def strange_texts(n, seed=5):
    draw = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "é", "1", "'s", "'", "中", "́", "ß", "Σ", "<|endoftext|>", "\x85", "Don't"]
    for _ in range(n):
        odd = [chr(draw.choice([draw.randrange(1, 0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(3)]
        yield "".join(draw.choice(parts + odd) for _ in range(draw.randrange(1, 30)))


TEXTS = [*ODD, *strange_texts(800)]


@cache
def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_byte_ids_equal_the_library():
    want = [library(BYTE_BPE).encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert byte_bpe.load(BYTE_BPE).encode(TEXTS) == want


def test_every_letter_is_cut_as_in_the_library():
    bpe, lib = byte_bpe.load(BYTE_BPE), library(BYTE_BPE).pre_tokenizer
    letters = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1{c}! {c}" for c in letters]
    assert [bpe.pre_tokens(t) for t in texts] == [
        [t[a:b] for _, (a, b) in lib.pre_tokenize_str(t)] for t in texts
    ]


def test_word_ids_equal_the_library():
    plain = [f"a{chr(c)}b{chr(c)}1{chr(c)}" for c in range(1, 0x250)]
    texts = [*TEXTS, *plain]
    want = [library(WORD_BPE).encode(t, add_special_tokens=False).ids for t in texts]
    assert word_bpe.load(WORD_BPE).encode(texts) == want


def test_decoding_any_ids_equals_the_library():
    draw, bpe, lib = random.Random(2), byte_bpe.load(BYTE_BPE), library(BYTE_BPE)
    for _ in range(500):
        ids = [draw.randrange(50257) for _ in range(draw.randrange(9))]
        assert bpe.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_short_and_long_merges_agree():
    draw = random.Random(1)
    pairs = {(a, b): (draw.randrange(10**6), 10 + a * 10 + b) for a in range(10) for b in range(10)}
    tree = merges.Merges(pairs, 200)
    strings = [[draw.randrange(10) for _ in range(draw.randrange(60))] for _ in range(300)]
    symbols, lengths = np.array([x for s in strings for x in s]), np.array(list(map(len, strings)))
    assert tree.merge(symbols, lengths) == [tree.merge_long(s) if len(s) > 1 else tuple(s) for s in strings]


def test_remembered_forgets_and_stays_right():
    seen = []
    memory = merges.Remembered(lambda keys: seen.extend(keys) or [k * 2 for k in keys], {"a": "first"}, most=3)
    for _ in range(3):
        assert memory.of(["a", "b", "c"]) == ["first", "bb", "cc"]
        assert memory.of([f"{i}" for i in range(9)]) == [f"{i}{i}" for i in range(9)]
    assert memory.of(["x" * 100]) == ["x" * 200] and "x" * 100 not in memory.known


def test_ids_in_arrays_equal_the_library():
    bpe = byte_bpe.ByteBpe(BYTE_BPE)
    want = [library(BYTE_BPE).encode(t, add_special_tokens=False).ids for t in TEXTS]
    bpe.remembered.most = 50  # so that pre-tokens are forgotten, and some of them met again
    for size in (1, 7, len(TEXTS)):
        got = [ids for k in range(0, len(TEXTS), size) for ids in bpe.encode_arrays(TEXTS[k : k + size])]
        assert [ids.tolist() for ids in got] == want and {ids.dtype for ids in got} == {np.dtype("uint32")}
    assert bpe.encode_arrays([]) == []


def test_known_pre_tokens_are_looked_up_once(monkeypatch):
    class Counted(str):
        hashed = 0

        def __hash__(self):
            Counted.hashed += 1
            return super().__hash__()

    bpe, text = byte_bpe.ByteBpe(BYTE_BPE), "the house xqzvw the the"
    ids = bpe.encode([text])
    assert ids == [library(BYTE_BPE).encode(text, add_special_tokens=False).ids]
    keys = list(map(Counted, bpe.cut(text)))
    monkeypatch.setattr(bpe, "cut", lambda _: keys)
    assert bpe.encode([text]) == ids and Counted.hashed == len(keys)


def test_flat_memory_forgets_and_stays_right():
    seen = []

    def many(keys):
        seen.extend(keys)
        return np.array([ord(c) for k in keys for c in k], dtype=np.int64), np.array([len(k) for k in keys], dtype=int)

    def symbols(keys):
        return [i for k in keys for i in ([7, 8] if k == "a" else map(ord, k))]

    memory = merges.RememberedFlat(many, {"a": (7, 8)}, most=3)
    texts = [["a", "bc", "c"], [], ["abcdefghi"[:i] for i in range(9)], ["x" * 100, "bc", "a"]]
    for _ in range(3):
        for some in (*([text] for text in texts), texts):
            assert [ids.tolist() for ids in memory.of(some)] == list(map(symbols, some))
        assert "x" * 100 not in memory.known and "x" * 100 not in memory.older
        assert len(memory.known.symbols) < 100
    assert "a" not in seen
    assert memory.of([]) == [] and memory.of([[]])[0].tolist() == []


def test_word_ids_are_right_when_words_are_forgotten():
    ids = word_bpe.WordIds(WORD_BPE)
    want = [library(WORD_BPE).encode(t, add_special_tokens=False).ids for t in TEXTS]
    ids.runs.most = ids.odd.most = 20
    for size in (1, 7, len(TEXTS)):
        assert [x for k in range(0, len(TEXTS), size) for x in ids.encode(TEXTS[k : k + size])] == want
    assert ids.encode([]) == [] and ids.encode(["", " \n"]) == [[], []]


def test_each_different_word_of_a_batch_is_cut_once(monkeypatch):
    cut, runs = [], word_bpe.RUNS
    monkeypatch.setattr(word_bpe, "RUNS", lambda text: cut.append(text) or runs(text))
    text = "The house, the\thouse, 12 xqzvw"
    want = library(WORD_BPE).encode(text, add_special_tokens=False).ids
    assert word_bpe.WordIds(WORD_BPE).encode([text] * 50) == [want] * 50
    assert sorted(" ".join(cut).split()) == ["12", "house,", "the", "the", "xqzvw"]


@pytest.mark.parametrize("longest", [2048, 64, 1])
def test_binary_lengths_equal_brute_force(longest):
    tokens = [0, 1, 2, 3, 63, 64, 65, 2047, 2048, 2049, 10_000]
    want = []
    for n in tokens:
        pieces = []
        for length in (1 << d for d in range(longest.bit_length() - 1, -1, -1)):
            while sum(pieces) + length <= n:
                pieces.append(length)
        want.append(pieces)
    lengths, counts = packing.binary_lengths(np.array(tokens), longest)
    assert counts.tolist() == list(map(len, want)) and lengths.tolist() == sum(want, [])


def test_packing_by_batches_of_any_size(spark, monkeypatch):
    _, df = odd_documents(spark, TEXTS[:100])
    df = df.coalesce(1)
    whole = sorted(map(str, packing.pack(df, WORD_BPE, longest=64).collect()))
    monkeypatch.setattr(packing, "TOGETHER_BYTES", 50)
    monkeypatch.setattr(packing, "BATCH_IDS", 200)
    assert sorted(map(str, packing.pack(df, WORD_BPE, longest=64).collect())) == whole


def test_round_trip_digests(spark):
    rows, df = odd_documents(spark)
    lib, want = library(BYTE_BPE), []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text))))
    got = [tuple(r) for r in byte_bpe.round_trip_digest(df, BYTE_BPE).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert byte_bpe.encode_decode(df.limit(0), BYTE_BPE).count() == 0


def test_token_counts(spark):
    rows, df = odd_documents(spark, TEXTS[:300])
    lib, want = library(BYTE_BPE), []
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 30))
    got = [tuple(r) for r in token_counts.count_tokens(df, BYTE_BPE, limit=30).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_whole_tokens_encode_alone():
    lib = library(BYTE_BPE)
    whole = token_counts.whole_tokens(BYTE_BPE)
    alone = [t for t in whole if len(lib.encode(t, add_special_tokens=False).ids) == 1]
    assert alone == whole and len(whole) > 45_000


@pytest.mark.parametrize("longest", [2048, 64, 1])
def test_packing(spark, longest):
    rows, df = odd_documents(spark)
    lib, found = library(WORD_BPE), defaultdict(list)
    pieces = packing.pack(df, WORD_BPE, longest=longest).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for p in pieces:
        assert p.length == 1 << p.bucket <= longest and p.offset == 0 and len(p.ids) == 4 * p.length
        found[p.doc_id].append(p)
    for i in {i for i, _ in rows}:
        want = [[*lib.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows if d == i]
        ids = b"".join(p.ids for p in sorted(found[i], key=lambda p: p.start) if len(want) == 1)
        if len(want) == 1:
            assert np.frombuffer(ids, "<u4").tolist() == want[0]
            assert {p.doc_tokens for p in found[i]} == {len(want[0])}
        assert sum(p.length for p in found[i]) == sum(map(len, want))
        assert len(found[i]) <= sum(len(w) // longest + longest.bit_length() for w in want)
    digest = packing.pieces_digest(packing.pack(df, WORD_BPE)).collect()
    whole = {p.sequence_id: p.ids for p in packing.pack(df, WORD_BPE).collect()}
    assert all(d.ids_crc32 == zlib.crc32(whole[d.sequence_id]) for d in digest)
    assert packing.pack(df.limit(0), WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, WORD_BPE, longest=3)


def test_best_fit_decreasing_equals_brute_force():
    draw = random.Random(4)
    for width in (1, 7, 64, 100):
        for _ in range(30):
            lengths = [draw.randrange(1, width + 1) for _ in range(draw.randrange(40))]
            space, rows = [], []
            for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
                fits = [s for s in space if s >= lengths[i]]
                k = space.index(min(fits)) if fits else len(space)
                if not fits:
                    space.append(width)
                space[k] -= lengths[i]
            got = binary_output.best_fit_decreasing(lengths, width)
            assert sorted(width - sum(lengths[i] for i in r) for r in got) == sorted(space)
            assert sorted(i for r in got for i in r) == list(range(len(lengths)))


def test_binary_rows_hold_every_id_once(spark, tmp_path):
    rows, df = odd_documents(spark)
    lib, width = library(BYTE_BPE), 256
    packed = binary_output.pack_rows(df, BYTE_BPE, width=width, end_id=7, pad_id=9, block_tokens=3000)
    binary_output.write_rows(packed, str(tmp_path / "rows"))
    found = spark.read.parquet(str(tmp_path / "rows")).collect()
    assert len({r.row_id for r in found}) == len(found)
    ids_of = defaultdict(list)
    for r in found:
        ids, positions = (np.frombuffer(b, "<u4") for b in (r.ids, r.positions))
        assert len(ids) == len(positions) == width and (ids[r.n_tokens :] == 9).all()
        assert r.cu_seqlens == [0, *np.cumsum([s.length for s in r.segments]).tolist()]
        for s, begin, end in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:]):
            assert s.offset == begin and positions[begin:end].tolist() == list(range(end - begin))
            ids_of[s.doc_id].append((s.start, ids[begin:end].tolist()))
    for i in {i for i, _ in rows}:
        want = [[*lib.encode(t or "", add_special_tokens=False).ids, 7] for d, t in rows if d == i]
        if len(want) == 1:
            assert [x for _, part in sorted(ids_of[i]) for x in part] == want[0]
        assert sum(len(part) for _, part in ids_of[i]) == sum(map(len, want))
    digest = binary_output.rows_digest(packed).collect()
    assert len(digest) == sum(len(r.segments) for r in found)
    assert binary_output.pack_rows(df.limit(0), BYTE_BPE).count() == 0
