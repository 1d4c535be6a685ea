"""Byte-level BPE: encoding by a segment tree over pair ranks, and decoding.

A text is cut into pre-tokens, whose bytes are merged as `merges` says. Ids are those of the tokenizers
library for the same file.

Nulls count as empty texts, which give no ids. Every row gives one row, repeated ones too; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import batched, chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sampleward.llm.batches import map_rows, texts
from sampleward.llm.merges import Merges, RememberedFlat

# White space by the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
# The published pre-token pattern of this vocabulary, white space spelled out.
PRE_TOKENS = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
# Stands before a special string among pre-tokens, where this lone surrogate cannot occur.
SPECIAL = "\ud800"
# Texts that are encoded together.
TOGETHER = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in plain)
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def read_merges(model: dict) -> dict[tuple[int, int], tuple[int, int]]:
    """(left id, right id) -> (rank, merged id) of a tokenizer file's BPE model."""
    vocab, out = model["vocab"], {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        out[vocab[a], vocab[b]] = (rank, vocab[a + b])
    return out


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is no byte-level BPE")
        if before["add_prefix_space"] or not before["use_regex"] or model["ignore_merges"]:
            raise ValueError(f"{path} uses options that are not supported")
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        vocab: dict[str, int] = model["vocab"]
        self.letter_ids = np.array([vocab[letter] for letter in letters], dtype=np.int64)
        self.merges = Merges(read_merges(model), len(vocab))
        added = spec["added_tokens"]
        self.specials = {t["content"]: t["id"] for t in added}
        # Longer strings first: of those that begin at one place, the longest counts.
        strings = sorted(self.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.specials.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token if c in byte_of)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.pattern = regex.compile(PRE_TOKENS)
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.latin, self.latin_pattern = self._latin()
        self.unlike = regex.compile(f"[{self._unlike()}\\U00010000-\\U0010ffff]")
        known = {SPECIAL + content: (i,) for content, i in self.specials.items()}
        self.remembered = RememberedFlat(self.merge_flat, known)

    @staticmethod
    def _latin() -> tuple:
        """The same pattern for texts of Latin letters alone, which the standard library cuts faster."""
        low = [chr(c) for c in range(0x250)]
        letter, number = (
            "".join(re.escape(c) for c in low if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}")
        )
        white = "\t-\r \x85\xa0"
        pattern = (
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{white}{letter}{number}]+"
            f"|[{white}]+(?![^{white}])|[{white}]+"
        )
        return re.compile("[\x00-\u024f]*").fullmatch, re.compile(pattern).findall

    def _unlike(self) -> str:
        """Letters that the two libraries' Unicode tables class differently, for a character class.

        Texts with any of them, or with letters beyond the first 65,536, are cut by the
        tokenizer library itself, which is slower.
        """
        found = []
        for code in chain(range(1, 0xD800), range(0xE000, 0x10000)):
            text = "a{0}1{0}! {0}".format(chr(code))
            cut = [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
            if cut != self.pattern.findall(text):
                found.append(f"\\u{code:04x}")
        return "".join(found)

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if self.latin(text):
            return self.latin_pattern(text)
        if self.unlike.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text, special strings among them."""
        if self.special is None or not self.special.search(text):
            return self.pre_tokens(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out += [SPECIAL + part] if i % 2 else self.pre_tokens(part)
        return out

    def letters(self, pre_tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens' bytes end to end, and how many each has."""
        encoded = list(map(str.encode, pre_tokens))
        letters = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        return self.letter_ids[letters], lengths

    def merge(self, pre_tokens: list[str]) -> list[tuple[int, ...]]:
        """Ids of each pre-token."""
        return self.merges.merge(*self.letters(pre_tokens))

    def merge_flat(self, pre_tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens end to end, and how many each has."""
        return self.merges.merge_flat(*self.letters(pre_tokens))

    def encode_arrays(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text, 32-bit. All new pre-tokens of the texts are merged together."""
        return self.remembered.of(map(self.cut, texts))

    def encode(self, texts: Iterable[str]) -> list[list[int]]:
        """Ids of each text."""
        return [ids.tolist() for ids in self.encode_arrays(texts)]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """The vocabulary, read once per Python process. The path must exist on every executor."""
    return ByteBpe(path)


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids array<int>, decoded string for each row."""

    def run(rows):
        bpe = load(tokenizer_path)
        for part in batched(rows, TOGETHER):
            doc_ids, together = zip(*part)
            for doc_id, ids in zip(doc_ids, bpe.encode(together)):
                yield doc_id, ids, bpe.decode(ids)

    return map_rows(texts(docs), run, "doc_id long, ids array<int>, decoded string")


def round_trip_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what encode_decode() gives.

    They are made beside the ids, so that ids and texts need not leave the Python worker.
    """

    def run(rows):
        bpe = load(tokenizer_path)
        decimal = list(map(str, range(len(bpe.bytes_of))))
        for part in batched(rows, TOGETHER):
            doc_ids, together = zip(*part)
            for doc_id, ids in zip(doc_ids, bpe.encode(together)):
                listed = hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode())
                decoded = hashlib.sha256(bpe.decode(ids).encode())
                yield doc_id, len(ids), listed.hexdigest(), decoded.hexdigest()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(texts(docs), run, schema)
