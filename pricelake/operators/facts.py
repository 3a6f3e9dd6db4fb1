"""Fact operators: polymorphic reference, top-1 dedupe, null-safe upsert, name-based overrides
(P14, J6, J7, W1, U1, U3, Q-10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions.text import _col, upper_trim


def poly_ref(type_col: Column | str, by_type: Mapping[str, Column | str]) -> Column:
    """Reference id chosen by type (``{'T1': variety_id, 'T3': product_id}``); other types give NULL."""
    out = None
    for t, c in by_type.items():
        out = F.when(_col(type_col) == F.lit(t), _col(c)) if out is None else out.when(_col(type_col) == F.lit(t), _col(c))
    return out.otherwise(F.lit(None)) if out is not None else F.lit(None)


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rn: str = "__rn") -> DataFrame:
    """One row per key, the first by ``order`` (give a total order: the source system had none, Q26).

    ``row_number() == 1`` lets Catalyst insert a partial WindowGroupLimit before the shuffle, so a hot key is
    cut to one row per map partition before it moves.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def desc_nulls_as(c: Column | str, value) -> Column:
    """``ORDER BY ISNULL(c, value) DESC``."""
    return F.coalesce(_col(c), F.lit(value)).desc()


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
) -> DataFrame:
    """MERGE as a new table version.

    Keys match null-safely (``<=>``). Matched rows take ``update_cols`` from the source and keep the rest of the
    target row; unmatched source rows are inserted; unmatched target rows stay. Columns are the target's; the
    source must carry them all (with typed NULLs, trap T9). Source keys must be unique (dedupe first).
    """
    cols = target.columns
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.select(*cols).withColumn("__s", F.lit(True)).alias("s")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full")
    from_source = F.col("s.__s").isNotNull()
    matched = from_source & F.col("t.__t").isNotNull()
    out = []
    for c in cols:
        if c in update_cols:
            out.append(F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in keys:
            out.append(F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(matched | ~from_source, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


def resolve_overrides(
    overrides: DataFrame,
    provinces: DataFrame,
    name_col: str = "correct_province_name",
    prov_name: str = "nom_province_prefecture",
    prov_id: str = "id_province_prefecture",
    region_id: str = "id_region",
) -> DataFrame:
    """J7 (first half): overrides carry a province **name** (Q30); resolve it to the province id and its region id."""
    p = provinces.select(upper_trim(prov_name).alias("__pname"), F.col(prov_id), F.col(region_id))
    o = overrides.withColumn("__pname", upper_trim(name_col))
    return o.join(p, "__pname", "left").drop("__pname")


def apply_overrides(
    facts: DataFrame,
    resolved: DataFrame,
    key: str = "agglomeration_raw",
    prov_id: str = "id_province_prefecture",
    region_id: str = "id_region",
    label: str = "match_quality",
) -> DataFrame:
    """Rows without a region whose raw city has a resolved override take its province and region ids and
    the label MATCHED_MANUAL. Adds ``__overridden`` for the Q-10 report."""
    from pricelake.operators.dims import one_per_key

    m = one_per_key(
        resolved.where(F.col(prov_id).isNotNull()).select(F.col(key), F.col(prov_id).alias("__op"), F.col(region_id).alias("__or")),
        key,
        ["__op", "__or"],
    )
    j = facts.join(m, key, "left")
    hit = F.col(region_id).isNull() & F.col("__op").isNotNull()
    new = {
        prov_id: F.when(hit, F.col("__op")).otherwise(F.col(prov_id)),
        region_id: F.when(hit, F.col("__or")).otherwise(F.col(region_id)),
        label: F.when(hit, F.lit(K.MATCHED_MANUAL)).otherwise(F.col(label)),
    }
    # one projection (each withColumn would re-analyse the whole plan)
    cols = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in facts.columns]
    return j.select(*cols, hit.alias("__overridden"))


def override_report(
    applied: DataFrame, resolved: DataFrame, key: str = "agglomeration_raw", expected: str = "row_count"
) -> DataFrame:
    """Q-10: per override, the expected row count next to the rows actually fixed."""
    fixed = applied.where(F.col("__overridden")).groupBy(key).agg(F.count(F.lit(1)).alias("rows_fixed"))
    r = resolved.select(key, F.col(expected).cast("long").alias("rows_expected"))
    return (
        r.join(fixed, key, "left")
        .withColumn("rows_fixed", F.coalesce(F.col("rows_fixed"), F.lit(0)).cast("long"))
        .withColumn("delta", F.col("rows_fixed") - F.col("rows_expected"))
    )
