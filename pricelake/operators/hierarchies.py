"""Hierarchies: values rolled up to every ancestor (R3), distinct members as bitmaps that add up over runs (A7, A8, A10),
ordered lists of members (A11)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import _col
from pricelake.session import cut_lineage


# ---------------------------------------------------------------------------------------------------------------- R3
def closure(edges: DataFrame, child: str = "child", parent: str = "parent", max_depth: int = 64) -> DataFrame:
    """(node, ancestor, depth): every node with itself (depth 0) and all its ancestors, each at its least depth. A
    recursive query, each step of which is an equi-join of the last step's rows. A child may have several parents; edges
    with a null end, and repeated ones, add nothing; a node that is nobody's child is there with itself. A cycle, or a
    chain of more than ``max_depth`` steps, is an error."""
    spark = edges.sparkSession
    e = edges.select(F.col(child).alias("child"), F.col(parent).alias("parent")).where("child IS NOT NULL AND parent IS NOT NULL").distinct()
    e = cut_lineage(e)
    key = "spark.sql.cteRecursionRowLimit"  # meant for runaway queries; the depth bounds this one
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = cut_lineage(
            spark.sql(
                f"""
                WITH RECURSIVE up (node, ancestor, depth) MAX RECURSION LEVEL {int(max_depth) + 2} AS (
                  SELECT child, parent, 1 FROM {{e}}
                  UNION ALL
                  SELECT up.node, e.parent, up.depth + 1 FROM up JOIN {{e}} AS e ON up.ancestor = e.child WHERE up.depth <= {int(max_depth)}
                ) SELECT * FROM up
                """,
                e=e,
            )
        )
    finally:
        spark.conf.set(key, before)
    if not found.where((F.col("node") == F.col("ancestor")) | (F.col("depth") > max_depth)).isEmpty():
        raise ValueError(f"the hierarchy has a cycle or more than {max_depth} levels")
    nodes = e.select(F.col("child").alias("node")).union(e.select("parent")).distinct()
    own = nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))
    return found.groupBy("node", "ancestor").agg(F.min("depth").alias("depth")).unionByName(own)


def rollup(values: DataFrame, node: str, value: str, edges: DataFrame, by: Sequence[str] = (), child: str = "child", parent: str = "parent") -> DataFrame:
    """(``by``..., node, value, n_nodes): the sum of ``value`` over each node and all nodes below it, each counted once
    however many ways lead up, and how many nodes with values that are. Values are summed per node before they meet the
    closure, so a hot node is one row. Rows whose node is in no edge count for themselves; null nodes go."""
    own = values.where(F.col(node).isNotNull()).groupBy(*by, F.col(node).alias("node")).agg(F.sum(value).alias("__v"))
    up = closure(edges, child, parent)
    joined = own.join(up.select("node", "ancestor"), "node", "left").withColumn("ancestor", F.coalesce("ancestor", "node"))
    return joined.groupBy(*by, F.col("ancestor").alias("node")).agg(F.sum("__v").alias("value"), F.count(F.lit(1)).cast("long").alias("n_nodes"))


# ------------------------------------------------------------------------------------------------------- A7, A8, A10
def distinct_bitmaps(df: DataFrame, group: Sequence[str], ids: Mapping[str, Column | str]) -> DataFrame:
    """(``group``..., measure, bucket, bits): which non-negative ids each measure has in each group, as bitmaps of 32,768 ids
    a row. All measures in one pass; bitmaps are built before the shuffle, so a hot group moves a few rows a task."""
    stacked = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), _col(c).cast("long").alias("id")) for name, c in ids.items()]))
    rows = df.select(*group, stacked.alias("m")).where("m.id IS NOT NULL").select(*group, "m.measure", "m.id")
    bucket = F.bitmap_bucket_number("id").alias("bucket")
    return rows.groupBy(*group, "measure", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_bitmaps(state: DataFrame | None, fresh: DataFrame, group: Sequence[str]) -> DataFrame:
    """The bitmaps of both: what was counted before isn't read again."""
    if state is None:
        return fresh
    return state.unionByName(fresh).groupBy(*group, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(state: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(``group``..., n_<measure>...): the exact numbers of distinct ids."""
    sums = [F.coalesce(F.sum(F.when(F.col("measure") == m, F.bitmap_count("bits"))), F.lit(0)).cast("long").alias(f"n_{m}") for m in measures]
    return state.groupBy(*group).agg(*sums)


# --------------------------------------------------------------------------------------------------------------- A11
def ordered_list(df: DataFrame, group: Sequence[str], value: Column | str, sep: str = ", ", distinct: bool = False, out: str = "names") -> DataFrame:
    """(``group``..., ``out``, n): the values of each group in ascending order, joined by ``sep`` (null without any), and how
    many there are. Equal values are counted before they are listed, so a group with a third of all rows moves a row per
    distinct value and task."""
    rows = df.select(*group, _col(value).cast("string").alias("__v")).groupBy(*group, "__v").agg(F.count(F.lit(1)).alias("__n"))
    times = F.when(F.col("__v").isNull(), 0).otherwise(F.lit(1) if distinct else F.col("__n"))
    rows = rows.withColumn("__n", times.cast("long"))
    one = F.col("__v") if distinct else F.array_join(F.array_repeat("__v", F.col("__n").cast("int")), sep)
    rows = rows.withColumn("__t", F.when(F.col("__v").isNotNull(), one))
    literal = sep.replace("\\", "\\\\").replace("'", "\\'")
    return rows.groupBy(*group).agg(F.expr(f"listagg(__t, '{literal}') WITHIN GROUP (ORDER BY __v)").alias(out), F.sum("__n").alias("n"))
