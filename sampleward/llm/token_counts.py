"""Token counts without encoding: most pre-tokens are a whole token.

Once, on the driver, each vocabulary string is tried: it counts as whole if it is one pre-token and
its merges end in its own id alone. Tasks then count one for each pre-token among the whole strings
and merge only the others. The list of whole strings has at most as many entries as the vocabulary.

Nulls count as empty texts with 0 tokens. Every row gives one row, repeated ones too; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

from itertools import batched, chain, islice

from pyspark.sql import DataFrame

from sampleward.llm.batches import map_rows, texts
from sampleward.llm.byte_bpe import SPECIAL, TOGETHER, load
from sampleward.llm.merges import Remembered


def whole_tokens(tokenizer_path: str) -> list[str]:
    """Vocabulary strings that encode alone as one token."""
    bpe, candidates = load(tokenizer_path), {}
    special = set(bpe.specials.values())
    for i, token in enumerate(bpe.bytes_of):
        try:
            text = token.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if text and i not in special and bpe.cut(text) == [text]:
            candidates[text] = (i,)
    merged = zip(candidates.items(), bpe.merge(list(candidates)))
    return [text for (text, alone), ids in merged if ids == alone]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def run(rows):
        bpe = load(tokenizer_path)
        known = dict.fromkeys(shared.value, 1) | {SPECIAL + s: 1 for s in bpe.specials}
        counts = Remembered(lambda tokens: list(map(len, bpe.merge(tokens))), known)
        for part in batched(rows, TOGETHER):
            cut = [bpe.cut(text) for _, text in part]
            each = iter(counts.of(list(chain.from_iterable(cut))))
            for (doc_id, text), pre_tokens in zip(part, cut):
                tokens = sum(islice(each, len(pre_tokens)))
                yield doc_id, len(text.encode()), tokens, tokens > limit

    return map_rows(texts(docs), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
