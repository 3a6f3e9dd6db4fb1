"""Exact duplicates by sorting whole contents (DataFrame functions only).

Spark samples splitters of (leading characters, content hash, salt), deals the rows out by range, and sorts each range
externally by the whole content, so that equal contents are adjacent. The window over the sorted rows closes a group
where a row's full content differs from its neighbour's. The splitters hold a bounded key instead of the content, as
Spark gathers sampled keys at the driver; equal contents have equal keys, so a group is never torn by a splitter.

A content that occurs more than ``hot_rows`` times is salted into sub-groups of about that many rows, which fall into
different ranges; the first rows of its sub-groups, a few, are then compared by full content again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import written

#: Contents that are salted, the most frequent ones first: what bounds the broadcast (16 bytes each). Any others have
#: less than 1 / HOT_KEYS of all rows each and are sorted as one group; results don't depend on it.
HOT_KEYS = 65_536


def content_sort(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda c: c,
    keep: str = "smallest",
    hot_rows: int = 250,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Of the rows with equal normalised text, the one with the smallest (``keep="largest"``: largest) id is kept. Null
    text is empty. A null id is kept only where the whole group has none. Of rows with equal text and equal id, one
    is kept. An empty table gives no rows; other columns are ignored.
    """
    sign = F.desc_nulls_last if keep == "largest" else F.asc_nulls_last
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(normalise(F.col(text_col)), F.lit("")).alias("content"))
    base = base.withColumn("fp", F.xxhash64("content"))
    hot = (
        base.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
        .orderBy(F.desc("n"), "fp").limit(HOT_KEYS)
        .select("fp", F.ceil(F.col("n") / hot_rows).alias("parts"))
    )
    rows = (
        base.join(F.broadcast(hot), "fp", "left")
        .withColumn("split", F.col("parts").isNotNull())
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")), F.lit(0)).cast("int"))
        .withColumn("lead", F.substring("content", 1, 16))
    )
    ranged = rows.drop("parts").repartitionByRange("lead", "fp", "salt")
    w = Window.partitionBy("lead", "fp", "salt", "content").orderBy(sign("id"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranged.select(
        "*",
        F.row_number().over(w).alias("rank"),
        F.first("id").over(whole).alias("sub_keep"),
        F.count(F.lit(1)).over(whole).alias("sub_size"),
    )
    slim = written(
        ranged_columns(ranked).withColumn("front", F.when(F.col("split") & (F.col("rank") == 1), F.col("content")))
        .drop("content"),
        "sorted",
    )
    best = F.struct(F.col("sub_keep").isNull().alias("none"), F.col("sub_keep").alias("id"), F.col("salt"))
    if keep == "largest":
        best = F.struct(F.col("sub_keep").isNotNull().alias("some"), F.col("sub_keep").alias("id"), F.col("salt"))
    classes = (
        slim.where("split AND rank = 1").groupBy("front")
        .agg(
            F.first("sha").alias("sha"),
            (F.max(best) if keep == "largest" else F.min(best)).alias("best"),
            F.sum("sub_size").alias("size"),
        )
        .select("sha", F.lit(True).alias("split"), "best", "size")
    )  # one row per salted content: at most HOT_KEYS
    out = slim.drop("front").join(F.broadcast(classes), ["sha", "split"], "left")
    first = F.col("rank") == 1
    return out.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("split"), F.col("best.id")).otherwise(F.col("sub_keep")).alias("keep_id"),
        F.when(F.col("split"), F.col("size")).otherwise(F.col("sub_size")).cast("long").alias("group_size"),
        (first & (~F.col("split") | (F.col("salt") == F.col("best.salt")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def ranged_columns(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        "id", "content", "split", "salt", "rank", "sub_keep", "sub_size", F.sha2("content", 256).alias("sha")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that :func:`content_sort` keeps, with all their columns. Of rows of equal id (null equals
    null) and equal text any one stays."""
    found = content_sort(docs, id_col, text_col, keep=keep)
    gone = found.where(~F.col("kept") & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    left = _without(docs, gone, id_col, text_col, "left_anti")
    twice = found.where("group_size > 1").groupBy("doc_id", "text_sha256").count().where("count > 1")
    if twice.isEmpty():
        return left
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    once = _without(left, twice, id_col, text_col, "left_semi").groupBy(id_col, text_col).agg(*[F.first(c).alias(c) for c in rest])
    return _without(left, twice, id_col, text_col, "left_anti").unionByName(once.select(*docs.columns))


def _without(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """``docs`` joined to (doc_id, text_sha256) of ``found`` by ``how`` (left_anti or left_semi)."""
    keys = found.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    return docs.join(keys, docs[id_col].eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), how)
