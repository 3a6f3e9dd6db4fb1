"""Benchmark decontamination over a distributed positional inverted index.

:func:`build_index` stores the postings of every training word: a segment holds whole documents of about
``segment_words`` words, and each (segment, word) row holds the sorted positions of the word there. :func:`search`
cuts the benchmark texts into windows of consecutive words, joins the index with the benchmark's words, and intersects,
segment by segment, the position lists shifted by each word's offset, beginning with the window's rarest word. What is
left are the exact phrase matches (``slop`` > 0: proximity matches, every word at most that far from its place).

The benchmark is searched in blocks of bounded size, so what is broadcast is bounded. All positions of a document are in
one segment, and a segment is bounded unless one document is longer.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import column_bytes, words, written

#: Position lists are stored as differences of unsigned 32-bit integers. This term holds each document's first position.
DOC_STARTS = b""
BLOCK_BYTES = 4 << 20


def _segment(number: int, found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """found: (doc_id, words). Positions skip one between documents, so that no run of words crosses documents."""
    sizes = np.array([len(w) for _, w in found], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ids: dict[bytes, int] = defaultdict(count().__next__)
    total = int(sizes.sum())
    terms = np.fromiter((ids[w] for _, ws in found for w in ws), np.int64, total)
    places = np.arange(total) + np.repeat(np.arange(len(found)), sizes)
    order = (terms << 32) | places
    order.sort()
    counts = np.bincount(terms, minlength=len(ids)) if total else np.zeros(0, np.int64)
    firsts = np.cumsum(counts) - counts
    places = order & 0xFFFFFFFF
    steps = np.diff(places, prepend=0)
    steps[firsts] = places[firsts]
    offsets = np.append(firsts, total).astype(np.int32) * 4
    postings = pa.Array.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(steps.astype("<u4").tobytes())]
    )
    names = ["segment", "is_doc", "term", "n", "postings", "doc_id", "place"]

    def batch(n, is_doc, term, sizes, posted, doc_ids, place):
        flag = pa.array(np.full(n, is_doc))
        columns = [pa.array(np.full(n, number)), flag, term, pa.array(sizes, pa.int64()), posted, doc_ids, place]
        return pa.RecordBatch.from_arrays(columns, names=names)

    n = len(found)
    start_list = [np.diff(starts, prepend=0).astype("<u4").tobytes()]
    yield batch(len(ids), False, pa.array(list(ids), pa.binary()), counts, postings, pa.nulls(len(ids), pa.string()), pa.nulls(len(ids), pa.int32()))
    yield batch(1, False, pa.array([DOC_STARTS], pa.binary()), [n], pa.array(start_list, pa.binary()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()))
    yield batch(n, True, pa.nulls(n, pa.binary()), sizes, pa.nulls(n, pa.binary()), pa.array([d for d, _ in found], pa.string()), pa.array(range(n), pa.int32()))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = 1_000_000) -> DataFrame:
    """The written index of whole ``docs``: rows (segment, term, n, postings) and, with is_doc, one per document
    (segment, place, doc_id as text, n words). Null text has no words; null and repeated ids stay apart by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0), column_bytes(b.column(1)), strict=True):
                ws = words(text)
                if found and size + len(ws) > segment_words:
                    yield from _segment(number, found)
                    number, found, size = number + 1, [], 0
                found.append((doc_id.as_py(), ws))
                size += len(ws) + 1
        if found:
            yield from _segment(number, found)

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(
        run, "segment long, is_doc boolean, term binary, n long, postings binary, doc_id string, place int"
    )
    return written(rows, "index")


def windows_of(items: list[tuple[str, bytes]], size: int) -> dict[tuple[bytes, ...], list[str]]:
    """Each distinct window of ``size`` words (a shorter text: all its words) with the ids of its items."""
    found: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - size + 1) if ws else 0):
            found[tuple(ws[i : i + size])].append(item)
    return dict(found)


def _match(lists: dict[bytes, np.ndarray], window: tuple[bytes, ...], slop: int) -> np.ndarray:
    """Where ``window`` begins: the rarest word's positions, kept while every other word is at its offset."""
    if any(w not in lists for w in window):
        return np.zeros(0, np.int64)
    order = sorted(range(len(window)), key=lambda i: len(lists[window[i]]))
    begins = lists[window[order[0]]] - order[0]
    for i in order[1:]:
        if not len(begins):
            break
        places = lists[window[i]]
        near = np.searchsorted(places, begins + i - slop)
        begins = begins[(near < len(places)) & (places[np.minimum(near, len(places) - 1)] <= begins + i + slop)]
    return begins[begins >= 0]


def _matcher(shared: Broadcast, slop: int) -> Callable:
    """The matches of the broadcast windows in one segment's lists, by document."""

    def run(table):
        segment = table.column("segment")[0].as_py()
        lists = {
            t.as_py(): np.cumsum(np.frombuffer(p.as_py(), "<u4").astype(np.int64))
            for t, p in zip(table.column("term"), table.column("postings"), strict=True)
        }
        starts = lists.pop(DOC_STARTS)
        hits: dict[int, list] = defaultdict(list)
        of: dict[int, set] = defaultdict(set)
        for window, items in shared.value.items():
            for at in _match(lists, window, slop).tolist():
                doc = int(np.searchsorted(starts, at, "right")) - 1
                hits[doc].append((at - int(starts[doc]), at - int(starts[doc]) + len(window)))
                of[doc].update(items)
        out = []
        for doc, spans in hits.items():
            joined: list[list[int]] = []
            for first, end in sorted(spans):
                if joined and first <= joined[-1][1]:
                    joined[-1][1] = max(end, joined[-1][1])
                else:
                    joined.append([first, end])
            out.append({"segment": segment, "place": doc, "spans": [{"first": a, "end": b} for a, b in joined], "items": sorted(of[doc])})
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        return pa.Table.from_pylist(out, pa.schema([("segment", pa.int64()), ("place", pa.int32()), ("spans", span), ("items", pa.list_(pa.string()))]))

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items (id, text) in blocks of about ``block_bytes``, a block at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        yield [(r["id"], r["text"].encode()) for r in part.collect()]


def search(
    index: DataFrame,
    items: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    size: int = 10,
    slop: int = 0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document with a match: segment, place, spans (array of first and end word), items (array of ids as
    text, sorted, distinct). A null item text has no words; a null item id is the text ``null``."""
    spark = index.sparkSession
    items = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text"))
    schema = "segment long, place int, spans array<struct<first:int,end:int>>, items array<string>"
    found = spark.createDataFrame([], schema)
    for block in _blocks(items.where("text IS NOT NULL"), block_bytes):
        windows = windows_of(block, size)
        if not windows:
            continue
        shared = spark.sparkContext.broadcast(windows)
        vocabulary = spark.createDataFrame([(w,) for w in {DOC_STARTS}.union(*windows)], "term binary")
        lists = index.where("NOT is_doc").join(F.broadcast(vocabulary), "term").select("segment", "term", "postings")

        found = found.unionByName(lists.groupBy("segment").applyInArrow(_matcher(shared, slop), schema))
    return found.groupBy("segment", "place").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    slop: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside any match), n_items, items_sha256,
    contaminated, and items and spans. Null or empty texts have no words and no hits; an item of fewer than ``size``
    words, but not none, is one window; empty tables give no rows or no hits; other columns are ignored."""
    index = build_index(docs, id_col, text_col)
    found = search(index, items, item_col, item_text_col, size, slop)
    per_doc = index.where("is_doc").select("segment", "place", "doc_id", F.col("n").alias("n_words"))
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["end"] - 1))))
    joined = per_doc.join(found, ["segment", "place"], "left").withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>"))
    )
    n_hit = F.coalesce(F.size(places), F.lit(0)).cast("long")
    return joined.select(
        F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id"),
        "n_words",
        F.when(F.col("spans").isNull(), F.lit(0)).otherwise(n_hit).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
        "items",
        "spans",
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without a match of ``items``."""
    row = F.concat_ws(":", F.col(id_col).cast("string"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    found = decontaminate(docs.select(row.alias("row"), F.col(text_col).alias("text")), items, "row", "text", **options)
    gone = found.where("contaminated").select(F.col("doc_id").alias("__row")).distinct()
    return docs.join(gone, row == F.col("__row"), "left_anti")
