"""Path-derived attributes of landed files (P4-P8), as Column expressions over ``rel_path``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions.text import _col, collapse_ws, fold_accents, path_parts, py_strip


def city_from_path(p: Column | str, codes: Sequence[str] = K.REGION_CODES, national: str = K.NATIONAL) -> Column:
    """P5: parent folder, upper-cased, when the path has >= 2 parts, the folder is not a region code nor the
    national folder, and it contains a letter."""
    parts = path_parts(p)
    folder = F.upper(py_strip(F.get(parts, F.size(parts) - 2)))
    ok = (F.size(parts) >= 2) & ~folder.isin(list(codes) + [national]) & folder.rlike(r"\p{L}")
    return F.when(ok, folder)


def region_code_from_path(p: Column | str, codes: Sequence[str] = K.REGION_CODES) -> Column:
    """First path part equal (upper-cased) to a region code."""
    parts = F.transform(path_parts(p), lambda x: F.upper(x))
    return F.get(F.filter(parts, lambda x: x.isin(list(codes))), 0)


def dataset_class(p: Column | str, fold: bool = False) -> Column:
    """Reference file iff under the reference folder and the name carries a reference token.

    ``fold=True`` (Q10 fix) folds accents and drops a ``" (n)"`` copy suffix before testing.
    """
    low = F.lower(F.coalesce(_col(p), F.lit("")))
    if fold:
        low = F.regexp_replace(fold_accents(low), r"\s*\(\d+\)(\.csv)$", "$1")
    in_folder = low.contains(K.REFERENCE_FOLDER + "/") | low.contains(K.REFERENCE_FOLDER + "\\")
    has_token = F.lit(False)
    for tok in K.REFERENCE_FILE_TOKENS:
        has_token = has_token | low.contains(tok)
    return F.when(in_folder & has_token, F.lit(K.DATASET_REFERENCE)).otherwise(F.lit(K.DATASET_PRICES))


def file_type(p: Column | str) -> Column:
    """T1 if ``_t1`` or ``t1.`` occurs anywhere in the lower-cased path, else T3 likewise, else UNKNOWN."""
    low = F.lower(F.coalesce(_col(p), F.lit("")))
    return (
        F.when(low.contains("_t1") | low.contains("t1."), F.lit(K.FILE_TYPE_T1))
        .when(low.contains("_t3") | low.contains("t3."), F.lit(K.FILE_TYPE_T3))
        .otherwise(F.lit(K.FILE_TYPE_UNKNOWN))
    )


def national_hint(p: Column | str, national: str = K.NATIONAL) -> Column:
    """Parent folder is the national folder, or the file name starts with ``maroc_t`` / ``national_t``."""
    low = F.lower(F.coalesce(_col(p), F.lit("")))
    parts = F.filter(F.transform(F.split(low, "/"), lambda x: py_strip(x)), lambda x: x != "")
    last_folder = F.when(F.size(parts) >= 2, F.upper(F.get(parts, F.size(parts) - 2))).otherwise(F.lit(""))
    filename = F.coalesce(F.get(parts, F.size(parts) - 1), F.lit(""))
    return (last_folder == national) | filename.startswith("maroc_t") | filename.startswith("national_t")


def classify_level(
    p: Column | str,
    region_col: Column | str | None = None,
    codes: Sequence[str] = K.REGION_CODES,
    levels: tuple[str, str, str] = (K.LEVEL_CITY, K.LEVEL_NATIONAL, K.LEVEL_REGION),
) -> Column:
    """struct(niveau, region, agglomeration) with precedence city folder -> national -> region code in path ->
    normalised region column. Level names are parameters (Q11)."""
    city_level, national_level, region_level = levels
    city = city_from_path(p, codes)
    code = region_code_from_path(p, codes)
    reg_norm = collapse_ws(region_col) if region_col is not None else F.lit("")
    reg_val = F.when(reg_norm != "", reg_norm)
    null = F.lit(None).cast("string")
    niveau = (
        F.when(city.isNotNull(), F.lit(city_level))
        .when(national_hint(p), F.lit(national_level))
        .otherwise(F.lit(region_level))
    )
    region = (
        F.when(city.isNotNull(), null)
        .when(national_hint(p), null)
        .when(code.isNotNull(), code)
        .otherwise(reg_val)
    )
    return F.struct(niveau.alias("niveau"), region.alias("region"), city.alias("agglomeration"))
