"""Substring matching over long and many names by a sorted suffix table.

A value is contained in a name iff one of the name's suffixes begins with it. Each name gives one row per place, with the
first ``KEY`` characters of the suffix that begins there, so the table is linear in the names' length. A value's hits are
a run of the sorted suffix keys. Keys and the two ends of every value's run are range-partitioned and sorted together
(Spark samples the splitters) and counted along that order: the counts at a run's ends are the ranks between which its
keys lie. Long runs are looked up by whole blocks of ranks, so neither a short value nor a frequent suffix makes one row
per pair in one task, and every join is an equi-join. Values longer than ``KEY`` are compared in full afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.dims import assign_ids
from pricelake.operators.match import match_key
from pricelake.session import cut_lineage

KEY, BLOCK, PIECE = 24, 1024, 256


def text_windows(df: DataFrame, text: str, keep: Sequence[str], width: int, out: str = "key", full: bool = False) -> DataFrame:
    """``keep``, ``pos`` (from 1) and ``out``, the ``width`` characters from there on, for every place of ``text`` (with
    ``full`` only where that many are left). Long texts are cut into overlapping pieces first: the place of a character is
    found from the text's beginning, which would cost the square of its length."""
    length = F.length(text)
    pieces = df.where(length > 0).select(*keep, F.col(text), F.explode(F.sequence(F.lit(0), F.floor((length - 1) / PIECE).cast("int"))).alias("__p"))
    pieces = pieces.select(*keep, (F.col("__p") * PIECE).alias("__from"), F.substring(text, F.col("__p") * PIECE + 1, F.lit(PIECE + width - 1)).alias("__t"))
    last = F.length("__t") - (width - 1 if full else 0)
    last = F.least(last, F.lit(PIECE))
    places = pieces.where(last > 0).select(*keep, "__from", "__t", F.explode(F.sequence(F.lit(1), last)).alias("__i"))
    return places.select(*keep, (F.col("__from") + F.col("__i")).alias("pos"), F.substring("__t", F.col("__i"), F.lit(width)).alias(out))


def _running_ranks(marks: DataFrame) -> DataFrame:
    """``marks`` (k, side) with ``rank``, the number of rows of side 1 up to it in the order of (k, side)."""
    order = [F.col("k"), F.col("side")]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = marks.repartitionByRange(*order).sortWithinPartitions(*order)
    base = cut_lineage(ranged.select("k", "side", F.spark_partition_id().alias("p"), place.alias("place")))
    is_key = (F.col("side") == 1).cast("long")
    sums = base.groupBy("p").agg(F.sum(is_key).alias("n"))  # a row per partition
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("p").orderBy("place")
    return base.withColumn("__n", F.sum(is_key).over(within)).join(sums, "p").select("k", "side", (F.col("__n") + F.col("before")).alias("rank"))


def _ranks_of(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(probe, rank) and (probe, block): single ranks at the ends of a run, whole blocks of ranks within it."""
    first, last = F.col("lo") + 1, F.col("hi")
    full_from, full_to = F.ceil(first / BLOCK), F.floor((last + 1) / BLOCK) - 1  # blocks [b * BLOCK, (b + 1) * BLOCK)
    runs = runs.select("probe", first.alias("a"), last.alias("z"), full_from.alias("f"), full_to.alias("t"))
    has = F.col("t") >= F.col("f")
    upto = F.when(has, F.col("f") * BLOCK - 1).otherwise(F.col("z"))
    since = F.when(has, (F.col("t") + 1) * BLOCK).otherwise(F.col("z") + 1)

    def span(a: Column, z: Column) -> Column:
        return F.when(z >= a, F.sequence(a, z)).otherwise(F.array().cast("array<long>"))

    ends = runs.select("probe", F.explode(F.concat(span(F.col("a"), upto), span(since, F.col("z")))).alias("rank"))
    blocks = runs.where(has).select("probe", F.explode(F.sequence("f", "t")).alias("block"))
    return ends, blocks


def suffix_hits(values: DataFrame, names: DataFrame) -> DataFrame:
    """(v, id), each once: ``values`` has distinct non-empty texts v, ``names`` (id, name) distinct names; v is contained
    in the name."""
    suffixes = text_windows(names, "name", ["id"], KEY)
    keys = suffixes.select("key").distinct()
    probes = values.select("v", F.substring("v", 1, KEY).alias("probe"))
    texts = probes.select("probe").distinct()
    ends = F.explode(F.array(F.struct(F.col("probe").cast("binary").alias("k"), F.lit(0).alias("side")),
                             F.struct(F.concat(F.col("probe").cast("binary"), F.lit(bytes([255]))).alias("k"), F.lit(2).alias("side"))))
    marks = texts.select(ends.alias("e")).select("e.*").unionByName(keys.select(F.col("key").cast("binary").alias("k"), F.lit(1).alias("side")))
    ranked = cut_lineage(_running_ranks(marks))
    probe = F.when(F.col("side") == 2, F.expr("substring(k, 1, length(k) - 1)")).otherwise(F.col("k")).cast("string")
    runs = ranked.where("side <> 1").groupBy(probe.alias("probe")).agg(F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("hi > lo")
    key_ranks = ranked.where("side = 1").select(F.col("k").cast("string").alias("key"), "rank")
    places = suffixes.join(key_ranks, "key").select("rank", F.floor(F.col("rank") / BLOCK).alias("block"), "id", "pos")
    single, blocks = _ranks_of(runs)
    hits = single.join(places, "rank").select("probe", "id", "pos").unionByName(blocks.join(places, "block").select("probe", "id", "pos"))
    short = hits.join(probes.where(F.length("v") <= KEY), "probe").select("v", "id")
    long = hits.join(probes.where(F.length("v") > KEY), "probe").join(names, "id")
    long = long.where(F.substring("name", F.col("pos"), F.length("v")) == F.col("v")).select("v", "id")
    return short.unionByName(long).distinct()


def suffix_matches(
    values: DataFrame, value_col: str, dim: DataFrame, name_col: str, take: Sequence[str], fold: bool = False
) -> DataFrame:
    """Pairs (value, dimension row) where the dimension name contains the value, as
    :func:`pricelake.operators.match.substring_matches` gives them (case-insensitive; accent-folded when ``fold``). Values
    and names that are null or empty match nothing; equal rows stay."""
    rows = dim.select(match_key(F.col(name_col), fold).alias("__name"), *take).where(F.length("__name") > 0)
    names = cut_lineage(assign_ids(rows.select(F.col("__name").alias("name")).distinct(), "name", "id"))
    v = values.select(F.col(value_col), match_key(F.col(value_col), fold).alias("__v")).where(F.length("__v") > 0)
    hits = suffix_hits(v.select(F.col("__v").alias("v")).distinct(), names).join(names, "id").select(F.col("v").alias("__v"), F.col("name").alias("__name"))
    return v.join(hits.join(rows, "__name").select("__v", *take), "__v").select(value_col, *take)
