"""Similarity join on word n-grams with a MinHash LSH forest and exact verification.

Each text has `trees` signatures of `depth` minima, read as paths in that many tries; texts that share a
prefix of a path are candidates. Prefixes are shortened from the full depth to the first at which texts at
the threshold share one with the target recall. Candidates are put together by the tries' nodes, and all
texts of such a neighbourhood are compared exactly, in blocks, so that no task holds a large one whole
and no list of pairs is ever made: a block pair gives each text's number of links and a spanning forest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.graph import components
from lakeworks.llm.shingles import digest, mixed, shingle_set, word_hashes
from lakeworks.llm.texts import clean, in_slices
from lakeworks.runtime import materialise


@dataclass(frozen=True)
class Forest:
    """Shape of the forest and of the comparison blocks (rows and shingles that a block holds at most,
    but always one row)."""

    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    trees: int = 16
    depth: int = 8
    block_rows: int = 128
    block_shingles: int = 2_000_000

    def prefix(self) -> int:
        """The longest prefix that texts at the threshold share in some tree with the target recall."""
        for length in range(self.depth, 0, -1):
            if 1 - (1 - self.threshold**length) ** self.trees >= self.recall:
                return length
        raise ValueError("this forest does not reach the recall; add trees")


def _sketch(batches, forest: Forest):
    """Per row: a digest of its set, the set's size, and its trie node in each tree."""
    prefix = forest.prefix()
    rng = np.random.default_rng(11)
    many = forest.trees * prefix
    factor = (rng.integers(0, 1 << 32, many, np.uint64) | np.uint64(1)).astype(np.uint32)
    shift = rng.integers(0, 1 << 32, many, np.uint64).astype(np.uint32)
    tree = np.arange(forest.trees, dtype=np.uint64)
    for batch in in_slices(batches, 1 << 20):
        texts = batch.column(2).to_pylist()
        words, starts = word_hashes(texts)
        digests, sizes, nodes = [], [], []
        for text, a, b in zip(texts, starts[:-1], starts[1:], strict=True):
            found = shingle_set(words[a:b], forest.words)
            sizes.append(len(found))
            if not len(found):  # no words: like its copies only
                digests.append(digest(repr(text).encode()))
                nodes.append([])
                continue
            digests.append(digest(found.tobytes()))
            small = (found >> np.uint64(32)).astype(np.uint32)
            least = np.full(many, 0xFFFFFFFF, np.uint32)
            for at in range(0, len(small), 4096):
                least = np.minimum(least, (small[at : at + 4096, None] * factor + shift).min(0))
            node = tree
            for column in least.reshape(forest.trees, prefix).T:
                node = mixed(node * np.uint64(0x9E3779B97F4A7C15) + column)
            nodes.append(node.view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))],
            ["uid", "doc_id", "digest", "size", "nodes"],
        )


def _sets(batches, words: int):
    """The shingle sets of texts, after the columns that name them."""
    for batch in in_slices(batches, 1 << 20):
        at = batch.schema.get_field_index("text")
        hashes, starts = word_hashes(batch.column(at).to_pylist())
        sets = [shingle_set(hashes[a:b], words).tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        kept = [i for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in kept), pa.array(sets, pa.binary())],
            [*(batch.schema.names[i] for i in kept), "shingles"],
        )


def _compare(rows: pa.Table, threshold: float) -> pa.Table:
    """All pairs across the two blocks of a block pair (or within one block): links of each text to others,
    and a spanning forest of the links."""
    first, second = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    seen: dict[int, tuple[int, bytes]] = {}
    for node, block, data in zip(*(rows.column(c).to_pylist() for c in ("node", "block", "shingles")), strict=True):
        seen.setdefault(node, (block, data))
    order = sorted(seen)
    sets = [np.frombuffer(seen[n][1], np.uint64) for n in order]
    blocks = np.array([seen[n][0] for n in order])
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    distinct, index = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(distinct), bool)
    links, parent, forest = np.zeros(len(order), np.int64), list(range(len(order))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(order)):
        own = index[starts[i] : starts[i] + sizes[i]]
        marked[own] = True
        shared = np.add.reduceat(marked[index], starts)
        marked[own] = False
        like = shared >= threshold * (sizes + sizes[i] - shared) - 1e-9
        like[: i + 1] = False
        if first != second:
            like &= blocks != blocks[i]
        for j in np.flatnonzero(like).tolist():
            links[i] += 1
            links[j] += 1
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                forest.append((order[i], order[j]))
    found = [(order[i], None, int(n)) for i, n in enumerate(links.tolist()) if n] + [(a, b, 0) for a, b in forest]
    return pa.table(
        [pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["node", "other", "links"]
    )


def classes(df: DataFrame, text: str = "text", key: str = "doc_id", forest: Forest = Forest()) -> DataFrame:
    """Per row: uid (of key and text), doc_id, class_id, n_links, class_uid.

    A class holds texts that links join, a link being a Jaccard similarity of at least the threshold between
    the texts' sets of word n-grams; class_id is the least key in it (null keys last) and class_uid that
    row's uid. n_links counts the other sets of n-grams that a row's set is linked to: copies count once.
    A text with fewer words than n is one n-gram; texts without words, empty and null ones are linked to
    nothing, and only equal ones share a class. Repeated rows share their uid. An empty table gives none.
    """
    rows = clean(df, doc_id=key, text=text).select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketch = rows.mapInArrow(
        lambda b: _sketch(b, forest), f"uid long, doc_id {kind}, digest binary, size long, nodes array<long>"
    )
    sketch = materialise(sketch.withColumn("set", F.xxhash64("digest")), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.col("uid").alias("uid"))
    sets = materialise(
        sketch.groupBy("set").agg(F.min(F.struct(order.alias("o"), "size", "nodes")).alias("m"))
        .select("set", F.col("m.o").alias("first"), F.col("m.size").alias("size"), F.col("m.nodes").alias("nodes")),
        "sets",
    )
    linked = _linked(sets, rows, forest)
    labels = components(linked.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = linked.where("links > 0").groupBy("node").agg(F.sum("links").alias("n_links"))
    named = (
        sets.select("set", "first")
        .join(labels, F.col("set") == F.col("node"), "left").drop("node")
        .join(counts, F.col("set") == F.col("node"), "left").drop("node")
        .select("set", "first", F.coalesce("root", "set").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    named = materialise(named, "named-sets")
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    named = named.join(heads, "root").select(
        "set", "n_links", F.col("head.id").alias("class_id"), F.col("head.uid").alias("class_uid")
    )
    return sketch.select("uid", "doc_id", "set").join(named, "set").select("uid", "doc_id", "class_id", "n_links", "class_uid")


def _linked(sets: DataFrame, rows: DataFrame, forest: Forest) -> DataFrame:
    """Verified links as (node, other, links): a spanning forest, and numbers of links to be added up."""
    at_nodes = sets.select(F.explode("nodes").alias("trie"), "set")
    heads = at_nodes.groupBy("trie").agg(F.min("set").alias("least"), F.max("set").alias("most")).where("least != most")
    near = components(at_nodes.join(heads, "trie").select(F.col("set").alias("a"), F.col("least").alias("b")))
    near = materialise(near.unionByName(near.select(F.col("root").alias("node"), "root").distinct()), "near")
    members = near.join(sets.select(F.col("set").alias("node"), "first", "size"), "node")
    blocks = members.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count("*") / forest.block_rows), F.ceil(F.sum("size") / forest.block_shingles)
        ).cast("int").alias("blocks")
    )
    wanted = members.join(blocks, "root").select(
        F.col("first.uid").alias("uid"), "node", "root", "blocks", F.expr("cast(pmod(hash(node, 7), blocks) as int)").alias("block")
    )
    texts = rows.select("uid", "text").join(wanted, "uid").select("node", "root", "blocks", "block", "text")
    found = texts.mapInArrow(
        lambda b: _sets(b, forest.words), "node long, root long, blocks int, block int, shingles binary"
    )
    dealt = found.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", "node", "block", "shingles", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")
    )
    threshold = forest.threshold
    compared = dealt.groupBy("root", "i", "j").applyInArrow(
        lambda table: _compare(table, threshold), "node long, other long, links long"
    )
    return materialise(compared, "linked")


def one_of_each(df: DataFrame, text: str = "text", key: str = "doc_id", forest: Forest = Forest()) -> DataFrame:
    """The rows of `df` that stand for their class: the least key's, once. All columns stay."""
    found = classes(df, text, key, forest)
    kept = found.where("uid = class_uid").select(F.col("uid").alias("_kept")).distinct()
    from pyspark.sql import Window

    row = F.row_number().over(Window.partitionBy("_kept").orderBy(F.lit(1)))
    names = [F.col(f"d.`{c}`") for c in df.columns]
    uid = F.xxhash64(F.col(f"d.`{key}`"), F.col(f"d.`{text}`"))
    return df.alias("d").join(kept, uid == F.col("_kept")).withColumn("_row", row).where("_row = 1").select(*names)
