"""Reference-table cleaning and hierarchy-code repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import _col, is_blank, normalize_code, py_strip


def clean_ref(
    df: DataFrame,
    code: Column | str,
    name: Column | str,
    parent: Column | str | None = None,
    out: tuple[str, str, str] = ("code", "name", "parent_code"),
    order_by: Column | str | None = None,
) -> DataFrame:
    """Code via the code normaliser, name stripped and upper-cased, exact duplicates dropped, blank code or
    name dropped; a missing parent column gives ''.

    With ``order_by`` (Q15 fix) one row per code is kept: the first by that order. The choice is an aggregate
    (``min_by``), so a hot code is pre-combined map-side instead of landing whole in one task.
    """
    code_c, name_c, parent_c = out
    parent_expr = normalize_code(parent) if parent is not None else F.lit("")
    cols = [
        normalize_code(code).alias(code_c),
        F.upper(py_strip(F.coalesce(_col(name).cast("string"), F.lit("")))).alias(name_c),
        parent_expr.alias(parent_c),
    ]
    if order_by is None:
        cleaned = df.select(*cols).dropDuplicates()
    else:
        ranked = df.select(*cols, _col(order_by).alias("__ord"))
        cleaned = (
            ranked.groupBy(code_c)
            .agg(F.min_by(F.struct(name_c, parent_c), F.struct("__ord", name_c, parent_c)).alias("__v"))
            .select(code_c, F.col(f"__v.{name_c}").alias(name_c), F.col(f"__v.{parent_c}").alias(parent_c))
        )
    return cleaned.where((F.col(code_c) != "") & (F.col(name_c) != ""))


def fill_parent_code(
    df: DataFrame,
    code: str,
    parent: str,
    prefix_len: int | None = None,
    drop_last: int | None = None,
    min_len: int = 0,
) -> DataFrame:
    """A blank parent code takes a prefix of the row's own code.

    ``prefix_len=n`` takes the first n characters (province -> region: 2; commune -> province: 5). ``drop_last=n``
    (Q12 fix) keeps everything but the last n characters, so ``1511`` -> ``1`` and ``10261`` -> ``10``.
    ``min_len`` requires the trimmed code to be at least that long.
    """
    c = F.col(code)
    clen = F.length(F.rtrim(c))
    if drop_last is not None:
        prefix = F.when(clen > drop_last, F.expr(f"substring(rtrim(`{code}`), 1, length(rtrim(`{code}`)) - {drop_last})"))
    elif prefix_len is not None:
        prefix = F.substring(c, 1, prefix_len)
    else:
        raise ValueError("give prefix_len or drop_last")
    cond = is_blank(F.col(parent)) & c.isNotNull() & (clen >= F.lit(min_len))
    return df.withColumn(parent, F.when(cond & prefix.isNotNull(), prefix).otherwise(F.col(parent)))


def fill_commune_province(df: DataFrame, code: str = "commune_code", parent: str = "province_code") -> DataFrame:
    """Commune loader rule: blank province code <- first 5 characters of the commune code, then first 4 if that is
    still blank (Q14: the second step only fires for an empty code)."""
    c = F.col(code)
    first = F.when(is_blank(F.col(parent)), F.substring(c, 1, 5)).otherwise(F.col(parent))
    second = F.when(is_blank(first), F.substring(c, 1, 4)).otherwise(first)
    return df.withColumn(parent, second)
