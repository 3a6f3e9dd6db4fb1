"""Matching free-text places to a dimension.

The substring join (J4) is an exact equi-join rewrite: ``contains(name, v)`` holds iff ``v`` equals one of the
substrings of ``name``. Substrings are generated from the distinct dimension names, as far as the distinct fact values
ask for them; no theta join touches the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions.text import _col, fold_accents, upper_trim
from pricelake.session import cut_lineage, stored


def exclude_values(
    df: DataFrame,
    col: str,
    literals: Sequence[str] = K.EXCLUDED_CITY_LITERALS,
    exclusions: DataFrame | None = None,
    map_key: str = "agglomeration_raw",
    map_target: str = "id_province_prefecture",
) -> DataFrame:
    """Keep rows whose value is not NULL, not in ``literals`` and not an exclusion row without a target.

    ``NOT IN (subquery)`` is null-aware; the exclusion keys are a primary key (never NULL), so a left anti join is
    the same relation. The exclusion table is small by construction; the planner broadcasts it on its measured
    size (AQE), so no hint is forced.
    """
    out = df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(literals)))
    if exclusions is not None:
        drop = exclusions.where(F.col(map_target).isNull() & F.col(map_key).isNotNull()).select(F.col(map_key).alias(col))
        out = out.join(drop, col, "left_anti")
    return out


def match_key(c: Column, fold: bool) -> Column:
    c = F.upper(c)
    if fold:
        # Accents and punctuation folded away: 'PRÉFECTURE DE FÈS' -> 'PREFECTUREDEFES'
        c = F.regexp_replace(F.upper(fold_accents(c)), r"[^0-9A-Z]+", "")
    return c


def substring_table(dim: DataFrame, name_col: str, fold: bool = False, values: DataFrame | None = None) -> DataFrame:
    """Substrings ``__v`` of every distinct dimension key ``__name``. With ``values`` (a column ``__v`` of the texts to be
    matched) only substrings of their lengths are made and only those among them stay; else all (a key of length L gives
    at most L(L+1)/2 rows)."""
    keys = (
        dim.select(match_key(F.col(name_col), fold).alias("__name"))
        .where(F.col("__name").isNotNull() & (F.length("__name") > 0)).distinct()
        .withColumn("__nlen", F.length("__name"))
    )
    lengths = F.sequence(F.lit(1), F.col("__nlen"))
    if values is not None:
        wanted = values.select(F.collect_set(F.length("__v")).alias("lens")).scalar()  # as many as there are lengths
        lengths = F.array_intersect(lengths, wanted)
    pieces = (
        keys.withColumn("__len", F.explode(lengths))
        .withColumn("__start", F.explode(F.sequence(F.lit(1), F.col("__nlen") - F.col("__len") + 1)))
        .select(F.col("__name").substr(F.col("__start"), F.col("__len")).alias("__v"), "__name")
    )
    if values is not None:
        pieces = pieces.join(values, "__v", "left_semi")
    return pieces.distinct()


def _counts(pieces: DataFrame, dim: DataFrame, name_col: str, fold: bool, count_col: str) -> DataFrame:
    """(``__v``, hits): the dimension rows are first counted per distinct name."""
    names = dim.select(match_key(F.col(name_col), fold).alias("__name")).groupBy("__name").agg(F.count(F.lit(1)).alias("__n"))
    return pieces.join(names, "__name").groupBy("__v").agg(F.sum("__n").alias(count_col))


def candidate_table(
    dim: DataFrame, name_col: str, take: Sequence[str], fold: bool = False, count_col: str = "n_candidates", values: DataFrame | None = None
) -> DataFrame:
    """(``__v``, ``take``..., ``n_candidates``): for every text that is contained in at least one dimension name,
    the dimension rows containing it and how many there are. The counts are joined back, so a short text that nearly
    every name contains needs no window over all its rows."""
    pieces = substring_table(dim, name_col, fold, values)
    d = dim.select(match_key(F.col(name_col), fold).alias("__name"), *take)
    return pieces.join(d, "__name").drop("__name").join(_counts(pieces, dim, name_col, fold, count_col), "__v")


def substring_matches(
    values: DataFrame, value_col: str, dim: DataFrame, name_col: str, take: Sequence[str], fold: bool = False
) -> DataFrame:
    """Pairs (value, dimension row) where the dimension name contains the value (case-insensitive; accent-folded
    when ``fold``); the result has ``value_col`` + ``take`` columns."""
    v = values.select(F.col(value_col), match_key(F.col(value_col), fold).alias("__v")).where(F.length("__v") > 0)
    cand = candidate_table(dim, name_col, take, fold, values=v.select("__v").distinct())
    return v.join(cand, "__v", "inner").select(value_col, *take)


def contains_join(
    facts: DataFrame,
    city_col: str,
    dim: DataFrame,
    name_col: str,
    take: Sequence[str],
    fold: bool = False,
    count_col: str = "n_candidates",
    fan_out: bool = True,
    values: DataFrame | None = None,
) -> DataFrame:
    """LEFT substring join of facts to a dimension; fan-out kept (one row per hit, Q24); literal matching
    (Q23). ``n_candidates`` counts the hits of the row's value (0 when unmatched). ``fan_out=False`` keeps one
    row per fact with its ``n_candidates`` only (no dimension columns).

    Plan: only the substrings of dimension names that occur among the distinct city values are made; the facts are
    equi-joined to them on the normalised key (with ``fold`` on the text itself, whose key is made once per distinct text).
    ``values`` (a column ``city_col`` holding at least the facts' values) stands for the distinct values where it is cheaper
    to have than a second pass over ``facts``. No size guess is made here:
    adaptive execution measures the candidates and broadcasts them when small (then a city holding a third of all rows
    causes no skewed shuffle); otherwise it stays a shuffle join whose skewed partitions AQE splits.
    """
    if fold:
        # the fold is dear: every distinct text is folded once, and the facts meet the texts as they are
        texts = (facts if values is None else values).select(F.col(city_col).alias("__text")).where("__text IS NOT NULL").distinct()
        keyed = cut_lineage(texts.select("__text", match_key(F.col("__text"), True).alias("__v")))
        wanted = keyed.select("__v").where(F.length("__v") > 0).distinct()
    else:
        wanted = (facts if values is None else values).select(match_key(F.col(city_col), False).alias("__v"))
        wanted = wanted.where(F.length("__v") > 0).distinct()
    if fan_out:
        cand = candidate_table(dim, name_col, take, fold, count_col, wanted)
    else:
        cand = _counts(substring_table(dim, name_col, fold, wanted), dim, name_col, fold, count_col)
    if fold:
        hits = keyed.join(cand, "__v").drop("__v")
        if not fan_out:
            hits = stored(hits, "hits")  # at most a row per distinct text, so that no fact is shuffled where they are few
        out = facts.withColumn("__text", F.col(city_col)).join(hits, "__text", "left").drop("__text")
    else:
        out = facts.withColumn("__v", match_key(F.col(city_col), False)).join(cand, "__v", "left").drop("__v")
    return out.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)))


def match_label(id_col: Column | str, manual: Column | None = None) -> Column:
    """MATCHED / UNMATCHABLE, or MATCHED_MANUAL when ``manual`` is true."""
    lab = F.when(_col(id_col).isNull(), F.lit(K.UNMATCHABLE)).otherwise(F.lit(K.MATCHED))
    if manual is not None:
        lab = F.when(manual, F.lit(K.MATCHED_MANUAL)).otherwise(lab)
    return lab


def city_key(c: Column | str) -> Column:
    """Fact-side city key: ``UPPER(TRIM(x))``."""
    return upper_trim(c)
