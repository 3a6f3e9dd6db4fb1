"""Column resolution over row objects and header sets.

Row objects are ``map<string,string>`` columns whose key order is the file's header order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricelake.functions.text import _col, fold_accents, has_letter, header_key, py_strip, strict_int


def _norm_key(k: Column, fold: bool) -> Column:
    k = F.lower(k)
    return fold_accents(k) if fold else k


def _norm_alias(a: str, fold: bool) -> str:
    import unicodedata

    a = (a or "").lower().strip()
    if fold:
        a = "".join(c for c in unicodedata.normalize("NFKD", a) if not unicodedata.combining(c))
    return a


def resolve_key(m: Column | str, aliases: Sequence[str], fold: bool = False, exclude: Column | None = None) -> Column:
    """Key of ``m`` chosen by the tolerant rule, or NULL.

    For each alias in order: the first key equal to it after lower + strip; else the first key that contains it
    after lower. ``fold=True`` also ignores accents. ``exclude`` is an array of keys that may not be chosen.
    """
    keys = F.map_keys(_col(m))
    if exclude is not None:
        keys = F.filter(keys, lambda k: ~F.coalesce(F.array_contains(exclude, k), F.lit(False)))
    choices = []
    for a in aliases:
        needle = _norm_alias(a, fold)
        choices.append(F.get(F.filter(keys, lambda k: py_strip(_norm_key(k, fold)) == F.lit(needle)), 0))
        if needle:
            choices.append(F.get(F.filter(keys, lambda k: F.instr(_norm_key(k, fold), F.lit(needle)) > 0), 0))
    return F.coalesce(*choices) if choices else F.lit(None).cast("string")


def resolve_field(m: Column | str, aliases: Sequence[str], fold: bool = False, exclude: Column | None = None) -> Column:
    """Value of the first matching key, stripped; a hit returns its value even if empty; no hit gives ''."""
    key = resolve_key(m, aliases, fold, exclude)
    # no hit -> NULL key -> NULL value -> ''; a hit with a NULL value also gives ''
    return F.coalesce(py_strip(F.try_element_at(_col(m), key)), F.lit(""))


def resolve_fields(
    m: Column | str, alias_map: Mapping[str, Sequence[str]], fold: bool = False, exclusive: bool = False
) -> list[Column]:
    """P1 for many fields at once, aliased by field name.

    ``exclusive=True`` lets each header be claimed by one field only (fields resolved in mapping order), so an
    index header is not also read as a price header.
    """
    out, claimed = [], None
    for field, aliases in alias_map.items():
        key = resolve_key(m, aliases, fold, claimed if exclusive else None)
        value = F.coalesce(py_strip(F.try_element_at(_col(m), key)), F.lit(""))
        out.append(value.alias(field))
        if exclusive:
            k = F.when(key.isNotNull(), F.array(key)).otherwise(F.array().cast("array<string>"))
            claimed = k if claimed is None else F.concat(claimed, k)
    return out


def require_int(df: DataFrame, src: str, out: str, name: str = "rejected_rows") -> tuple[DataFrame, DataFrame, Observation]:
    """Parse ``src`` as an integer into ``out``.

    Returns (accepted rows, rejected rows, observation). The observation carries ``processed`` and ``skipped``
    counts once an action has run on the accepted frame (Q-9 load summary), without a second pass.
    """
    parsed = df.withColumn(out, strict_int(src))
    obs = Observation(name)
    observed = parsed.observe(
        obs, F.count(F.lit(1)).alias("processed"), F.count_if(F.col(out).isNull()).alias("skipped")
    )
    return observed.where(F.col(out).isNotNull()), parsed.where(F.col(out).isNull()), obs


def ranked_columns(columns: Sequence[str], candidates: Sequence[str]) -> list[str]:
    """The columns that hold a candidate's key in their name, best first: by the rank of the earliest such
    candidate, then by position (metadata only)."""
    keys = [header_key(c) for c in candidates]
    scored = [(min((r for r, k in enumerate(keys) if k and k in c), default=None), i, c) for i, c in enumerate(columns)]
    return [c for r, i, c in sorted((r, i, c) for r, i, c in scored if r is not None)]


def first_col(columns: Sequence[str], *candidates: str) -> str | None:
    """The best column of :func:`ranked_columns`, if any."""
    return next(iter(ranked_columns(columns, candidates)), None)


def column_profile(df: DataFrame, columns: Sequence[str], code: Column | str | None = None) -> DataFrame:
    """One aggregate pass giving, per column, the share of values with a letter and equal to ``code``."""
    aggs = []
    for c in columns:
        v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        aggs.append(F.avg(has_letter(v).cast("double")).alias(f"{c}__letters"))
        if code is not None:
            eq = py_strip(v) == py_strip(F.coalesce(_col(code).cast("string"), F.lit("")))
            aggs.append(F.avg(eq.cast("double")).alias(f"{c}__equal_code"))
    return df.agg(*aggs)


def pick_name_column(
    df: DataFrame, candidates: Sequence[str], code: Column | str, threshold: float = 0.5
) -> str | None:
    """P10: of the columns with >= 50 % letters, the best-ranked one that equals the code in < 50 % of the rows; without
    such a candidate, the first by position; else None. The shares come from one aggregate job over the columns."""
    cols = list(df.columns)
    if not cols:
        return None
    shares = column_profile(df, cols, code).first().asDict()
    lettered = [c for c in cols if (shares[f"{c}__letters"] or 0.0) >= threshold]
    # a candidate stands for its first column only, as P9 picks it
    picks = [first_col(cols, cand) for cand in candidates]
    named = [c for c in picks if c in lettered and (shares[f"{c}__equal_code"] or 0.0) < threshold]
    return next(iter(named + lettered), None)
