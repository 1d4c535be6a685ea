"""Near-duplicates by SimHash fingerprints and BK-trees.

Fingerprints are 64 bits, each the majority of that bit over the hashes of a text's word shingles.
Two fingerprints link when they differ in at most `radius` bits. They are put into shards so that
each linked pair meets in one at least: the bits are cut into blocks, and fingerprints that agree in all
blocks but `radius` share the shard of these values, since `radius` differing bits touch no more blocks than that.
With more blocks a shard's key is longer, so shards stay small at any number of fingerprints.

Every shard has a BK-tree, in which a child hangs below its parent by their Hamming distance; a probe
follows only edges whose distance can lead into the radius. A shard with more fingerprints than
`tree_size` is dealt over several trees, and each tree is sent to every group of that shard's
fingerprints, by shuffle: no tree passes through the driver, whatever the number of fingerprints. Of the
links in a tree only a spanning forest is kept. No candidate is capped.

Classes are the connected components of the links. Nulls count as empty texts, whose fingerprint is
zero and links like any other. Equal fingerprints are one node, so copies cost nothing further. A
repeated row gives a row each. Rows without doc_id are linked, but name no class: a class in which no
row has a doc_id has component_id null. Texts of any length are hashed whole. Columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, groupby
from operator import itemgetter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleward.llm.batches import map_rows, texts
from sampleward.llm.components import components
from sampleward.operators.first_rows import FILE, PLACE, has_columns
from sampleward.sources.shared import stage

SEED, BITS = 42, 64
# Fingerprints up to which a shard's key is one block; shards of a block of 21 bits then have some hundred each.
FEW = 1 << 29


def shingles(text: str, words: int) -> list[bytes]:
    """Runs of so many words, ASCII letters in lower case; the whole sequence if there are fewer.

    Words are what stands between spaces and the characters 9 to 13.
    """
    all_words = text.encode().lower().split()
    if len(all_words) <= words:
        return [b" ".join(all_words)] if all_words else []
    return list(map(b" ".join, zip(*(all_words[i:] for i in range(words)))))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles(text, words)], dtype=np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 3, placed: bool = False) -> DataFrame:
    """doc_id, fingerprint long for each row, and if asked its file and place there."""

    def run(rows):
        for text, *others in rows:
            yield *others, simhash(shingle_hashes(text, words))

    others, schema = ["doc_id"], "doc_id long"
    if placed:
        docs = docs.withColumns({"__file": F.col(FILE), "__place": F.col(PLACE)})
        others, schema = ["doc_id", "__file", "__place"], "doc_id long, __file string, __place long"
    return map_rows(texts(docs, others=others[1:]).select("text", *others), run, f"{schema}, fingerprint long")


class BKTree:
    """Fingerprints by distance: node i has `children[i]`, from distance to child."""

    def __init__(self):
        self.prints: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, print_: int) -> int:
        """The node of a fingerprint, made where it is new."""
        prints, children, node = self.prints, self.children, 0
        if not prints:
            prints.append(print_)
            children.append({})
            return 0
        while distance := (prints[node] ^ print_).bit_count():
            if (child := children[node].get(distance)) is None:
                children[node][distance] = child = len(prints)
                prints.append(print_)
                children.append({})
                return child
            node = child
        return node

    def near(self, print_: int, radius: int) -> Iterator[int]:
        """Nodes within the radius."""
        prints, children = self.prints, self.children
        waiting = [0] if prints else []
        while waiting:
            node = waiting.pop()
            distance = (prints[node] ^ print_).bit_count()
            if distance <= radius:
                yield node
            for edge, child in children[node].items():
                if distance - radius <= edge <= distance + radius:
                    waiting.append(child)


class Forest:
    """Which of the nodes seen so far are joined."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.get(node, node)) != node:
            parent[node] = parent.get(up, up)
            node = up
        return node

    def join(self, a: int, b: int) -> bool:
        """False if they were joined already."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def shard_links(
    members: Iterable[tuple[int, bool]], radius: int, within: bool
) -> Iterator[tuple[int, int]]:
    """Spanning links of one cell's members (fingerprint, is in the tree).

    Members of the tree come first; they probe it only where links within the tree are asked for.
    """
    tree, forest, unsigned = BKTree(), Forest(), (1 << BITS) - 1
    for node, in_tree in members:
        print_ = node & unsigned
        for place in tree.near(print_, radius) if within or not in_tree else ():
            other = tree.prints[place]
            if other != print_ and forest.join(other, print_):
                yield _signed(other), node
        if in_tree:
            tree.add(print_)


def _signed(print_: int) -> int:
    return print_ - (1 << BITS) if print_ >> (BITS - 1) else print_


def deal(members: DataFrame, tree_size: int) -> DataFrame:
    """Members (shard, node) with the tree they belong to or probe: cell, in_tree.

    A shard of up to tree_size members is one cell. A larger one is dealt into parts by a hash; for
    parts i <= j there is a cell with the tree of part i, probed by part j.
    """
    large = members.groupBy("shard").count().where(F.col("count") > tree_size)
    large = large.select("shard", F.ceil(F.col("count") / tree_size).cast("int").alias("parts"))
    dealt = members.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return cells.withColumn("cell", F.struct(low.alias("tree"), high.alias("probe"))).withColumn(
        "in_tree", F.col("part") == low
    )


def links(members: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """(a, b) spanning links of nodes in members (shard, node), a node being its fingerprint."""
    cells = deal(members, tree_size).select("shard", "cell.tree", "cell.probe", (~F.col("in_tree")).alias("probing"), "node")
    cells = cells.repartition("shard", "tree", "probe").sortWithinPartitions("shard", "tree", "probe", "probing", "node")

    def run(rows):
        for (_, tree, probe), cell in groupby(rows, key=itemgetter(0, 1, 2)):
            yield from shard_links(((node, not probing) for *_, probing, node in cell), radius, tree == probe)

    return map_rows(cells, run, "a long, b long")


def shards(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(shard, node): each fingerprint in the shard of each choice of all blocks but `radius`."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(masks, blocks - radius)):
        value = F.col("fingerprint").bitwiseAND(F.lit(_signed(sum(chosen))).cast("long"))
        keys.append(F.struct(F.lit(number).alias("choice"), value.alias("value")))
    return prints.select(F.explode(F.array(*keys)).alias("shard"), F.col("fingerprint").alias("node"))


def linked(prints: DataFrame, radius: int, tree_size: int, blocks: int | None = None) -> DataFrame:
    """(node, root) of all fingerprints that link with another; root is the least one of the class."""
    if blocks is None:
        # Either number of blocks gives the same links.
        blocks = radius + 1 if prints.count() <= FEW else radius + 4
    distinct = prints.select("fingerprint").distinct()
    return components(links(shards(distinct, radius, blocks), radius, tree_size))


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, tree_size: int = 2048, blocks: int | None = None
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the class) for each row."""
    prints = stage(fingerprints(docs, words), "simhash")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    joined = first.join(linked(prints, radius, tree_size, blocks), F.col("fingerprint") == F.col("node"), "left")
    joined = joined.withColumn("root", F.coalesce("root", "fingerprint"))
    classes = joined.join(joined.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    classes = classes.select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def distinct_documents(
    docs: DataFrame, words: int = 3, radius: int = 2, tree_size: int = 2048, blocks: int | None = None
) -> DataFrame:
    """One document of each class of near-duplicates, with its columns as they are.

    The document of least doc_id stays, one without doc_id only if the class has no other; of repeated rows one stays.
    Rows are told apart by their places in files, so texts are read once for the fingerprints and once for the
    result; rows without such places are written to the shared folder first.
    """
    held = docs if has_columns(docs, FILE, PLACE) else stage(docs, "distinct")
    prints = stage(fingerprints(held, words, placed=True), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__file", "__place")
    first = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    joined = first.join(linked(prints, radius, tree_size, blocks), F.col("fingerprint") == F.col("node"), "left")
    kept = joined.groupBy(F.coalesce("root", "fingerprint")).agg(F.min("first").alias("kept"))
    kept = kept.select("kept.__file", "kept.__place")
    placed = held.withColumns({"__file": F.col(FILE), "__place": F.col(PLACE)})
    return placed.join(kept, ["__file", "__place"], "left_semi").select(*docs.columns)
