"""Document fingerprints by threshold-scaled sketches, with DataFrame functions alone.

A sketch holds every distinct 32-bit shingle hash below a fixed fraction of the hash range, so its size follows
the document's, sketches of parts merge by union, and the containment of a short text in a long one can
be estimated. The least hash is always kept too, so that only a text without words has an empty sketch.
A shingle is five words in lower case, or all words where there are fewer; words stand between spaces
and the characters 9 to 13.

Nulls count as empty texts. Equal texts have equal fingerprints. The likeness of two empty sketches is
1, of an empty and another one 0. Repeated rows give a row each; columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleward.llm.batches import texts
from sampleward.sources.shared import stage

LEAST = -(1 << 31)


def threshold(fraction: float) -> int:
    """Hashes below it make up this fraction of all."""
    return LEAST + int(fraction * (1 << 32))


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def with_sketch(df: DataFrame, text: str, name: str, words: int = 5, fraction: float = 1 / 4) -> DataFrame:
    """df with an array of hashes, ascending, for a text column."""
    hashed = df.withColumn("__words", word_hashes(F.col(text)))
    n, at = F.size("__words"), lambda i: F.get(F.col("__words"), i)

    def short(hash_: Column) -> Column:
        return F.shiftright(hash_, 32).cast("int")

    shingles = F.when(
        n >= words,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - words, F.lit(0))),
            lambda i: short(F.xxhash64(*(at(i + k) for k in range(words)))),
        ),
    ).when(n > 0, F.array(short(F.xxhash64(F.col("__words")))))
    hashed = hashed.withColumn("__hashes", shingles)
    kept = F.filter("__hashes", lambda h: h < threshold(fraction))
    least = F.array(F.array_min("__hashes"))
    kept = F.when(F.col("__hashes").isNull(), F.array().cast("array<int>")).otherwise(
        F.array_sort(F.array_distinct(F.concat(kept, least)))
    )
    return hashed.withColumn(name, kept).drop("__words", "__hashes")


def merge(a: Column, b: Column, fraction: float = 1 / 4) -> Column:
    """The sketch of both documents' shingles together, of sketches with this fraction.

    A least hash above the threshold stays only while no hash of either lies below it, as in a sketch made at once.
    """
    both = F.array_union(a, b)
    kept = F.array_sort(F.filter(both, lambda h: h < threshold(fraction)))
    return F.when(F.size(kept) > 0, kept).when(F.size(both) > 0, F.array(F.array_min(both))).otherwise(both)


def containment(a: Column, b: Column) -> Column:
    """The estimated share of a's shingles that b has; 1 for an empty a."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def fingerprint(sketch: Column) -> Column:
    """The sketch as text: 8 hexadecimal digits per hash, counted from the least possible one."""
    digits = F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h.cast("long") - LEAST), 8, "0")))
    return F.array_join(digits, "")


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, next_id per distinct doc_id, ascending, nulls first; the last is followed by the first.

    Ids are dealt by ranges and numbered within them; only one row per range meets in one task.
    """
    ids = docs.groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    ids = ids.repartitionByRange(F.asc_nulls_first("doc_id")).withColumn("part", F.spark_partition_id())
    ids = stage(ids, "order")
    firsts = ids.groupBy("part").agg(
        F.min_by(F.struct("doc_id"), F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first")
    )
    parts = Window.orderBy("part")
    following = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(parts),
            F.first("first").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("following"),
    )
    own = F.lead(F.struct("doc_id")).over(Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id")))
    linked = ids.withColumn("own", own).join(following, "part")
    next_id = F.coalesce("own", "following").getField("doc_id")
    return linked.select("doc_id", "n_chars", "copies", next_id.alias("next_id"))


def edited_fingerprints(docs: DataFrame, words: int = 5, fraction: float = 1 / 4) -> DataFrame:
    """Sketches of each text and of its edit, in which the next document replaces the last quarter.

    Columns: doc_id, n_chars, edited, sketch, edited_sketch, next_sketch. Of a doc_id that several rows
    share, the least text is the next document.
    """
    plain = texts(docs)
    order = stage(successors(plain.withColumn("n_chars", F.char_length("text"))), "successors")
    need = order.select(
        F.col("next_id").alias("of"), F.col("doc_id").alias("before"),
        F.expr("n_chars div 4").alias("need"),
    )
    rows = with_sketch(plain, "text", "sketch", words, fraction)
    heads = rows.join(need, F.col("doc_id").eqNullSafe(F.col("of"))).select(
        "before", F.substring("text", F.lit(1), F.col("need").cast("int")).alias("head"),
        F.col("sketch").alias("next_sketch"),
    )
    if not order.where("copies > 1").isEmpty():
        least = F.min(F.struct("head", "next_sketch")).alias("least")
        heads = heads.groupBy("before").agg(least).select("before", "least.*")
    n = F.char_length("text")
    cut = F.expr("char_length(text) div 4").cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut)
    )
    joined = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("before")))
    joined = joined.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch"
    )
    return with_sketch(joined, "edited", "edited_sketch", words, fraction)


def fingerprints_digest(found: DataFrame) -> DataFrame:
    """Fingerprints as text, the digest of the edited text, and likenesses."""
    return found.select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
