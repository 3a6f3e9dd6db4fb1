"""Joining texts that are LIKE patterns to names (J4 as the source system has it).

No pattern is compared with every name. Every pattern with a literal run is looked up by one gram (up to three characters)
of its runs, the one that the fewest names hold; the names' grams are an index, an equi-join gives the candidates, and
``LIKE`` decides. A pattern of wildcards only asks for a length: exactly as many characters as it has ``_``, or, with a
``%``, at least as many; it is joined with the names by length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import _col
from pricelake.operators.dims import assign_ids
from pricelake.operators.match import match_key
from pricelake.operators.suffixes import text_windows
from pricelake.session import cut_lineage

GRAM = 3
_LITERAL = r"(?s)((?:\\.|[^%_\\])+)"


def like_pattern(c: Column | str, escapes: bool = True, around: bool = False) -> Column:
    """The text as a pattern of Spark's LIKE. With ``escapes`` a backslash makes the next character plain (at the end it is
    invalid: null, which matches nothing); without, it is a plain character. ``around`` adds ``%`` on both sides."""
    c = _col(c)
    if escapes:
        whole = F.regexp_replace(c, r"(?s)(\\[%_\\])|\\(.)", "$1$2")  # Spark takes an escape before %, _ and itself only
        c = F.when(~c.rlike(r"(?s)^(?:[^\\]|\\.)*\\$"), whole)
    else:
        c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit("%"), c, F.lit("%")) if around else c


def like_hits(patterns: DataFrame, names: DataFrame) -> DataFrame:
    """(p, id), each once: ``patterns`` has distinct patterns p of Spark's LIKE, ``names`` (id, name) distinct names."""
    runs = F.transform(F.regexp_extract_all("p", F.lit(_LITERAL), F.lit(1)), lambda r: F.regexp_replace(r, r"(?s)\\(.)", "$1"))
    longest = F.array_max(F.transform(runs, lambda r: F.length(r)))
    p = patterns.select("p", runs.alias("runs"), F.when(longest.isNotNull(), F.least(longest, F.lit(GRAM))).alias("g"))

    # the grams that patterns ask for, each with the names that hold it
    literal = p.where("g IS NOT NULL").select("p", "g", F.explode("runs").alias("run")).where("length(run) >= g")
    asked = literal.select("p", F.explode(F.expr("transform(sequence(1, length(run) - g + 1), i -> substring(run, i, g))")).alias("gram")).distinct()
    wanted = asked.select("gram").distinct()
    index = None
    for g in range(1, GRAM + 1):
        own = text_windows(names, "name", ["id"], g, "gram", full=True).select("gram", "id")
        index = own if index is None else index.unionByName(own)
    index = cut_lineage(index.join(wanted, "gram", "left_semi").distinct())
    held = index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = asked.join(held, "gram", "left").groupBy("p").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best"))
    found = rarest.select("p", F.col("best.gram").alias("gram")).join(index, "gram").select("p", "id")

    # wildcards only: by length
    bare = p.where("g IS NULL").select("p", F.length(F.replace("p", F.lit("%"), F.lit(""))).alias("n"), F.contains("p", F.lit("%")).alias("open"))
    lengths = names.select(F.collect_set(F.length("name"))).scalar()  # as many as there are lengths
    bare = bare.withColumn("lengths", F.coalesce(lengths, F.array().cast("array<int>")))
    bare = bare.select("p", F.explode(F.when(F.col("open"), F.filter("lengths", lambda x: x >= F.col("n"))).otherwise(F.array("n"))).alias("n"))
    by_length = bare.join(names.select("id", F.length("name").alias("n")), "n").select("p", "id")

    return found.join(names, "id").where("name LIKE p").select("p", "id").unionByName(by_length)


def _names(dim: DataFrame, name_col: str, take: Sequence[str], fold: bool) -> tuple[DataFrame, DataFrame]:
    rows = dim.select(match_key(F.col(name_col), fold).alias("__name"), *take).where("__name IS NOT NULL")
    return rows, cut_lineage(assign_ids(rows.select(F.col("__name").alias("name")).distinct(), "name", "id"))


def like_matches(
    values: DataFrame, value_col: str, dim: DataFrame, name_col: str, take: Sequence[str], escapes: bool = True, around: bool = False
) -> DataFrame:
    """Pairs (value, dimension row) where the dimension name is LIKE the value, case-insensitively. Null values and names
    match nothing; the pattern '' matches the name ''; equal rows stay."""
    rows, names = _names(dim, name_col, take, False)
    v = values.select(F.col(value_col), like_pattern(match_key(F.col(value_col), False), escapes, around).alias("__p")).where("__p IS NOT NULL")
    hits = like_hits(v.select(F.col("__p").alias("p")).distinct(), names).join(names, "id").select(F.col("p").alias("__p"), F.col("name").alias("__name"))
    return v.join(hits.join(rows, "__name").select("__p", *take), "__p").select(value_col, *take)


def like_join(
    facts: DataFrame, city_col: str, dim: DataFrame, name_col: str, take: Sequence[str], count_col: str = "n_candidates", values: DataFrame | None = None, escapes: bool = False, around: bool = True
) -> DataFrame:
    """J4 to the letter: a LEFT join of facts to the dimension rows whose name is LIKE ``%city%``, the city text being a
    pattern itself (``_`` and ``%`` in it are wildcards). A row per hit; ``n_candidates`` counts the hits of the row's value.
    ``values`` as in :func:`pricelake.operators.match.contains_join`. Facts meet the matches of their distinct value by an
    equi-join; an empty city text matches nothing."""
    distinct = (facts if values is None else values).select(match_key(F.col(city_col), False).alias("__v")).where(F.length("__v") > 0).distinct()
    matched = like_matches(distinct, "__v", dim, name_col, take, escapes, around)
    counts = matched.groupBy("__v").agg(F.count(F.lit(1)).alias(count_col))
    out = facts.withColumn("__v", match_key(F.col(city_col), False)).join(matched.join(counts, "__v"), "__v", "left").drop("__v")
    return out.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)))
