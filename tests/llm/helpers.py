"""Small tables with the odd cases that every operator must handle."""

import random

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "  \t\n", "a", "a  b", "Ünïcode ẛ̣ é", "ΑΣ ΣΑΣ İ", "x<|endoftext|>y <|startoftext|>",
    "it's we'll 12345 !!! \n\n x", "\x1c\x1d a\x85b\xa0c", "\U0001f600 hi ՘", "word " * 400, "ab" * 3000,
]


def documents(spark, texts, columns="doc_id long, text string, lang string, source string, n_chars long"):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, columns)


def odd_documents(spark, more=()):
    """Odd texts, nulls, repeated rows, a null id, and columns named like those that operators make."""
    texts = [*ODD, None, None, *more]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, "a"), (3, "a"), (None, "no id"), (None, None)]
    df = documents(spark, rows)
    clashing = ["shard", "slot", "fingerprint", "node", "ids", "tokens", "rank", "row", "hash", "size", "part"]
    for name in clashing:
        df = df.selectExpr("*", f"'x' AS {name}")
    return rows, df


def words(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))
