"""Ids of a lower-casing word tokenizer, remembered by word."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from sampleward.llm.byte_bpe import byte_letters, read_merges
from sampleward.llm.merges import Merges, RememberedFlat, gather

# Lower-case letters to U+017F; the runs that lower-case text of these letters is cut into.
LETTERS = "a-zß-öø-ÿĀ-ſ"
RUNS = re.compile(f"[{LETTERS}]+|[0-9]|[^0-9{LETTERS} \t-\r]+").findall


class WordIds:
    """Ids as the tokenizers library gives them for a file that lower-cases and drops white space.

    No token of such a file spans white space, so a text's ids are those of its words one after
    the other. Arrow cuts many texts into words, of which each different one is worked on once. Words of
    Latin letters, digits and harmless marks are cut into runs, which are merged here, many at once, and
    remembered. All other words, such as those with special strings, apostrophes or letters of other
    scripts, go through the library itself and are remembered too.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path} is no lower-casing BPE with word ends")
        self.merges = Merges(read_merges(model), len(model["vocab"]))
        letters = byte_letters()
        self.inner, self.last = (
            np.array([model["vocab"][c + end] for c in letters], dtype=np.int64) for end in ("", "</w>")
        )
        odd = {"'", *(t["content"][0] for t in spec["added_tokens"])}
        marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in odd)
        self.plain = re.compile(rf"[a-zA-Z0-9{re.escape(marks)}À-įıĲ-ſ]*").fullmatch
        self.runs, self.odd = RememberedFlat(self.run_ids), RememberedFlat(self.odd_ids)

    def run_ids(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs end to end, and how many each has."""
        encoded = list(map(str.encode, runs))
        letters = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        symbols, ends = self.inner[letters], np.cumsum(lengths) - 1
        symbols[ends] = self.last[letters[ends]]
        return self.merges.merge_flat(symbols, lengths)

    def odd_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words, by the library."""
        ids = [self.library.encode(word, add_special_tokens=False).ids for word in words]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.array(list(chain.from_iterable(ids)), dtype=np.uint32), counts

    def plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words, by their runs."""
        runs = RUNS(" ".join(words).lower())
        ids, counts = self.runs.each(runs)
        # Runs leave nothing of a word out, and lower-casing keeps its length: it ends where its last run ends.
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        run_ends = np.cumsum(np.fromiter(chain([0], map(len, runs)), dtype=np.int64, count=len(runs) + 1))
        id_ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(run_ends, ends)]
        return ids, np.diff(id_ends, prepend=0)

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for all kinds of words without white space."""
        if self.plain("".join(words)):
            return self.plain_ids(words)
        kinds = [self.plain(word) is not None for word in words]
        plain = np.array(kinds)
        ids, of_plain = self.plain_ids(list(compress(words, kinds)))
        odd, of_odd = self.odd.each(list(compress(words, ~plain)))
        counts, starts = np.zeros((2, len(words)), dtype=np.int64)
        counts[plain], counts[~plain] = of_plain, of_odd
        starts[plain] = np.cumsum(of_plain) - of_plain
        starts[~plain] = len(ids) + np.cumsum(of_odd) - of_odd
        return gather(np.concatenate([ids, odd]), starts, counts), counts

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow column's texts end to end, 32-bit, and how many each text has."""
        words = pc.ascii_split_whitespace(texts)
        found = words.flatten().dictionary_encode()
        ids, counts = self.word_ids(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        places, starts = found.indices.to_numpy(), np.cumsum(counts) - counts
        each = counts[places]
        last = np.cumsum(pc.list_value_length(words).to_numpy())  # words to the end of each text
        ends = np.concatenate([[0], np.cumsum(each)])[last]
        return gather(ids, starts[places], each), np.diff(ends, prepend=0)

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        ids, counts = self.encode_flat(pa.array(texts, pa.string()))
        flat, ends = ids.tolist(), np.cumsum(counts).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


@lru_cache(maxsize=4)
def load(path: str) -> WordIds:
    """The vocabulary, read once per Python process. The path must exist on every executor."""
    return WordIds(path)
