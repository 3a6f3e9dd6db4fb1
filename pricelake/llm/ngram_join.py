"""Similarity join on word n-grams: a MinHash LSH forest with exact verification.

Every distinct text has one label per tree, the sequence of ``depth`` min-hashes. A tree's prefix trie is its labels in
sorted order: texts that agree on a prefix are neighbours. Matched prefixes are shortened from the full depth until pairs
of the wanted similarity meet in some tree with the target recall (:func:`matched_depth`); texts that share that prefix in
a tree are candidates, those with longer common prefixes among them. The exact Jaccard similarity of the shingle sets then
decides.

No pair is a row: candidates of a prefix are verified inside a task, which returns each text's number of links and a
spanning forest. A prefix with many texts is split into blocks and its pairs of blocks are verified by different tasks. A
pair that meets in several trees counts in the first one. Equal texts are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import column_bytes, mix, shingle_hashes, small_batches, word_hashes, written
from pricelake.llm.components import components

TREES, DEPTH = 10, 6
_SEEDS = np.random.default_rng(99).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)


def matched_depth(similarity: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which pairs of ``similarity`` meet in some tree with probability ``recall`` at least."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text), size))


def labels(shingles: np.ndarray) -> bytes:
    """The labels of all trees, two bytes for each min-hash, most significant first."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, ((shingles[None, at : at + 4096] ^ (_SEEDS[:, None] >> np.uint64(7))) * _SEEDS[:, None]).min(1))
    return (mix(least) >> np.uint64(48)).astype(">u2").tobytes()


def text_key(text: Column) -> Column:
    """128 bits of the text's digest; null is empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def signed(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(doc_id, key, n shingles, labels) of every row, written."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            sets = [shingle_set(t, size) for t in column_bytes(b.column(2))]
            columns = [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64())]
            columns.append(pa.array([labels(s) if len(s) else None for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n", "labels"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(run, f"doc_id {id_type}, key binary, n long, labels binary"), "signed")


def _intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles sets[a[i]] and sets[b[i]] share."""
    lengths = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(at) > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    rows, columns, n = np.repeat(np.arange(len(sets)), lengths)[keep], column[at][keep], int(shared.sum())
    if len(a) * 64 < len(sets) ** 2 or n > 64 * lengths.mean() + 4096:
        own = np.split(columns, np.cumsum(np.bincount(rows, minlength=len(sets)))[:-1])
        return np.array([len(np.intersect1d(own[i], own[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for first in range(0, n, 4096):
        low, high = np.searchsorted(columns, [first, first + 4096])
        part = np.zeros((len(sets), min(4096, n - first)), np.float32)
        part[rows[low:high], columns[low:high] - first] = 1
        total += part @ part.T
    return total[a, b].astype(np.int64)


def _verifier(depth: int, similarity: float):
    """For applyInArrow over (tree, prefix, i, j): the links among block i, or between blocks i and j."""
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(table):
        m = table.num_rows
        tree, one_block = table.column("tree")[0].as_py(), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        sizes = table.column("n").to_numpy()
        marks = np.frombuffer(b"".join(x.as_py() for x in table.column("labels")), ">u2").reshape(m, TREES, DEPTH)[:, :tree, :depth]
        a, b = np.triu_indices(m, 1)
        ok = sizes[a] * (1 / similarity) + 1e-9 >= sizes[b]
        ok &= sizes[b] * (1 / similarity) + 1e-9 >= sizes[a]
        if not one_block:
            ok &= block[a] != block[b]
        a, b = a[ok], b[ok]
        for t in range(tree):  # pairs that have met in an earlier tree
            prefix = np.ascontiguousarray(marks[:, t]).view(f"V{2 * depth}").ravel()
            _, group = np.unique(prefix, return_inverse=True)
            new = group[a] != group[b]
            a, b = a[new], b[new]
        if not len(a):
            return schema.empty_table()
        sets = [np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in table.column("shingles")]
        common = _intersections(sets, a, b)
        linked = common >= similarity * (sizes[a] + sizes[b] - common) - 1e-9
        a, b = a[linked], b[linked]
        links = np.bincount(a, minlength=m) + np.bincount(b, minlength=m)
        root = np.arange(m)
        while True:  # the smallest number reached, over and over
            least = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, least)
            np.minimum.at(new, b, least)
            if (new == root).all():
                break
            root = new
        keys, at = table.column("key").to_pylist(), np.flatnonzero(links)
        columns = [pa.array([keys[i] for i in at], pa.binary()), pa.array(links[at], pa.int64()), pa.array([keys[root[i]] for i in at], pa.binary())]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def verified(docs: DataFrame, marks: DataFrame, text_col: str, size: int, similarity: float, recall: float, block_rows: int, block_shingles: int) -> DataFrame:
    """(key, links, root) of texts with links, written: partial numbers of links and the edges of spanning forests."""
    depth = matched_depth(similarity, recall)
    texts = marks.where("labels IS NOT NULL").groupBy("key").agg(F.first("n").alias("n"), F.first("labels").alias("labels"))
    trees = F.array(
        *[
            F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), F.substring("labels", 2 * DEPTH * t + 1, 2 * depth)).alias("prefix"))
            for t in range(TREES)
        ]
    )
    spots = texts.select("key", "n", F.explode(trees).alias("at")).select("key", "n", "at.tree", "at.prefix")
    sizes = (
        spots.groupBy("tree", "prefix")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("key")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("x2"))
        .where("rows > 1")
    )
    # prefixes with the same texts in several trees: the first tree is enough
    once = sizes.groupBy("rows", "total", "x1", "x2").agg(F.min(F.struct("tree", "prefix")).alias("at")).select(
        "at.tree", "at.prefix", F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("total") / block_shingles)).alias("blocks")
    )
    cand = spots.join(once, ["tree", "prefix"]).select("key", "tree", "prefix", "blocks")
    cand = cand.withColumn("block", F.pmod(F.xxhash64("key", F.lit(9)), "blocks").cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1), lambda j: F.struct(F.least(j, "block").alias("i"), F.greatest(j, "block").alias("j")))
    cand = written(cand.select("key", "tree", "prefix", "block", pairs.alias("pairs")), "candidates")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            sets = [shingle_set(t, size).view(np.int64) for t in column_bytes(b.column(2))]
            columns = [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "labels", "n", "shingles"])

    needed = cand.select("key").distinct().join(texts.select("key", "labels"), "key")
    bodies = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text")).join(needed.select("key"), "key", "left_semi")
    bodies = bodies.groupBy("key").agg(F.first("text").alias("text")).join(needed, "key").select("key", "labels", "text")
    sets = bodies.mapInArrow(shingles, "key binary, labels binary, n long, shingles array<long>")
    placed = cand.join(sets, "key").withColumn("pair", F.explode("pairs"))
    found = (
        placed.select("tree", "prefix", "pair.i", "pair.j", "block", "key", "labels", "n", "shingles")
        .groupBy("tree", "prefix", "i", "j").applyInArrow(_verifier(depth, similarity), "key binary, links long, root binary")
    )
    return written(found, "links")


def similarity_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    similarity: float = 0.8,
    recall: float = 0.99,
    block_rows: int = 400,
    block_shingles: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, n_copies, and the digests key (of the text), root (of the
    class).

    Texts with a Jaccard similarity of at least ``similarity`` of their sets of ``size``-word shingles are linked; classes
    are connected texts, named by their smallest doc_id. n_links is the number of other texts linked to the row's own,
    n_copies the number of rows with the same text. Equal texts, null being empty, are of one class. A text of fewer than
    ``size`` words has one shingle of all its words; one without words has no links. Null ids stay and name no class
    unless all ids of the class are null. Other columns are ignored; an empty table gives no rows."""
    marks = signed(docs, id_col, text_col, size)
    found = verified(docs, marks, text_col, size, similarity, recall, block_rows, block_shingles)
    roots = written(components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))), "roots")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    texts = marks.groupBy("key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    named = texts.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    names = named.groupBy("root").agg(F.min("first").alias("class_id"))
    whole = written(named.join(names, "root").join(links, "key", "left").select("key", "root", "class_id", "links", "n_copies"), "texts")
    return marks.select("doc_id", "key").join(whole, "key").select(
        "doc_id", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "n_copies", "key", "root"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those whose class has a row of smaller id (null is the
    largest; of equal ids, of smaller text digest). Rows of equal id and text stay or go together."""
    rows = written(similarity_classes(docs, id_col, text_col, **options).select("doc_id", "key", "root"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = rows.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key")))
    gone = rows.join(first, "root").where(other).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    same = docs[id_col].eqNullSafe(F.col("__id")) & (text_key(docs[text_col]) == F.col("__key"))
    return docs.join(gone, same, "left_anti")
