"""Weights: wide year columns to long rows, weight staging at two levels, the weight fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions.text import header_key, is_blank, parse_decimal, strict_int, upper_trim, year_columns
from pricelake.operators.resolve import first_col


def unpivot_years(
    df: DataFrame, id_cols: Sequence[str], pattern: str | None = None, year_col: str = "annee", value_col: str = "value"
) -> DataFrame:
    """Columns whose name matches the year pattern become (annee, value) rows; NULL cells are dropped.

    The year columns are found on the schema (metadata), the reshaping is Spark's ``unpivot`` (an Expand node,
    no shuffle)."""
    ycols = year_columns(df.columns, pattern)
    if not ycols:
        raise ValueError("no year column")
    casted = df.select(*id_cols, *[F.col(f"`{c}`").cast("double").alias(c) for c in ycols])
    long = casted.unpivot(list(id_cols), ycols, year_col, value_col)
    return long.where(F.col(value_col).isNotNull()).withColumn(year_col, F.col(year_col).cast("int"))


def stage_weights(df: DataFrame, place: str, aliases: Mapping[str, Sequence[str]], level: str) -> DataFrame:
    """R2: staging rows (niveau, lieu, variete, annee, poids) from a header-named weight table (all strings).

    Columns are found with the tolerant column finder over the normalised header names (metadata only); values
    are parsed with the decimal-comma and strict-integer rules."""
    by_norm = {header_key(c): c for c in reversed(df.columns)}
    norm_cols = [header_key(c) for c in df.columns]

    def pick(field):
        c = first_col(norm_cols, *aliases[field])
        return F.col(f"`{by_norm[c]}`") if c else F.lit(None).cast("string")

    return df.select(
        F.lit(level).alias("niveau"),
        pick(place).alias("lieu"),
        pick("variete").alias("variete"),
        strict_int(pick("annee")).alias("annee"),
        parse_decimal(pick("poids")).alias("poids"),
    )


def stage_weight_table(df: DataFrame) -> DataFrame:
    """R1 + R2 for one verbatim weight table: a wide table (year-named columns) is unpivoted first. A row with a city is of
    the city level, any other of the region level; a table with one of the two columns is of that level."""
    ycols = year_columns(df.columns)
    if ycols:
        ids = [c for c in df.columns if c not in ycols]
        df = _unpivot_text(df, ids, ycols)
    norm = [header_key(c) for c in df.columns]
    city, region = first_col(norm, *K.CITY_WEIGHT_ALIASES["ville"]), first_col(norm, *K.REGION_WEIGHT_ALIASES["region"])
    if not (city and region):
        return stage_weights(df, "ville", K.CITY_WEIGHT_ALIASES, K.LEVEL_CITY) if city else stage_weights(df, "region", K.REGION_WEIGHT_ALIASES, K.LEVEL_REGION)
    no_city = is_blank(F.col(f"`{df.columns[norm.index(city)]}`"))
    own = stage_weights(df.where(~no_city), "ville", K.CITY_WEIGHT_ALIASES, K.LEVEL_CITY)
    return own.unionByName(stage_weights(df.where(no_city), "region", K.REGION_WEIGHT_ALIASES, K.LEVEL_REGION))


def _unpivot_text(df: DataFrame, ids: Sequence[str], ycols: Sequence[str]) -> DataFrame:
    """Year columns (text cells) -> (annee, poids) rows, keeping the cell text for the decimal parser."""
    t = df.select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{c}`").cast("string").alias(c.strip()) for c in ycols])
    long = t.unpivot(list(ids), [c.strip() for c in ycols], "annee", "poids")
    return long.where(F.col("poids").isNotNull() & (F.trim("poids") != ""))


def shares(df: DataFrame, group: Sequence[str], value: str, out: str = "poids") -> DataFrame:
    """Weight of each row as its share of the group total. The totals are an aggregate (partial sums before the
    shuffle) joined back on the group, so a hot group is never gathered into one task."""
    totals = df.groupBy(*group).agg(F.sum(value).alias("__total"))
    return df.join(totals, list(group), "left").withColumn(out, F.col(value) / F.col("__total")).drop("__total")


WEIGHT_KEY = ["annee", "niveau", "id_reference", "id_province_prefecture", "id_commune", "id_region"]


def weight_fact(
    staged: DataFrame,
    varieties: DataFrame,
    provinces: DataFrame,
    regions: DataFrame,
    target: DataFrame | None = None,
    fold: bool = False,
    communes: DataFrame | None = None,
) -> DataFrame:
    """The weight fact (annee, poids, niveau, id_reference, id_province_prefecture, id_commune, id_region).

    ``staged`` comes from :func:`stage_weight_table`. The variety is looked up by exact normalised name (J6); a
    city is matched to provinces by substring (J4, or J5 with ``fold``) and takes the province's region; a region
    row is looked up by region name. One row per natural key (W1: greatest weight, then place name), upserted
    null-safely into ``target`` (U1). ``provinces``: nom, id, id_parent; ``regions``: nom, id; ``varieties``:
    name, id. With ``communes`` (nom, id, id_parent), a city that is in no province's name is looked up among their names
    and takes the commune (of several of one name the smallest id), its province and that province's region."""
    from pricelake.operators.dims import lookup
    from pricelake.operators.facts import desc_nulls_as, top1, upsert
    from pricelake.operators.match import contains_join

    f = lookup(staged, "variete", varieties.select("name", "id"), "name", ["id"]).withColumnRenamed("id", "id_reference")
    f = f.withColumn("lieu_key", upper_trim("lieu"))
    city = contains_join(
        f.where(F.col("niveau") == K.LEVEL_CITY),
        "lieu_key",
        provinces.select("nom", F.col("id").alias("id_province_prefecture"), F.col("id_parent").alias("id_region")),
        "nom",
        ["id_province_prefecture", "id_region"],
        fold=fold,
    ).drop("n_candidates").withColumn("id_commune", F.lit(None).cast("long"))
    if communes is not None:
        own = communes.select(upper_trim("nom").alias("k"), F.struct(F.col("id").cast("long").alias("id"), F.col("id_parent").cast("long").alias("id_parent")).alias("c"))
        own = own.groupBy("k").agg(F.min("c").alias("c")).select("k", F.col("c.id").alias("__c"), F.col("c.id_parent").alias("__p"))
        above = provinces.select(F.col("id").alias("__p"), F.col("id_parent").alias("__r"))
        city = city.join(own.join(above, "__p", "left"), F.col("lieu_key") == F.col("k"), "left")
        found = F.col("id_province_prefecture").isNull() & F.col("__c").isNotNull()
        new = {"id_commune": "__c", "id_province_prefecture": "__p", "id_region": "__r"}
        city = city.withColumns({k: F.when(found, F.col(c)).otherwise(F.col(k)) for k, c in new.items()}).drop("k", "__c", "__p", "__r")
    reg = lookup(
        f.where(F.col("niveau") != K.LEVEL_CITY), "lieu_key", regions.select(upper_trim("nom").alias("k"), F.col("id").alias("id_region")), "k", ["id_region"], normalise=False
    ).withColumns({k: F.lit(None).cast("long") for k in ("id_province_prefecture", "id_commune")})
    both = city.unionByName(reg)
    cols = ["annee", "poids", "niveau", "id_reference", "id_province_prefecture", "id_commune", "id_region"]
    typed = both.select(
        F.col("annee").cast("int"), F.col("poids").cast("decimal(18,6)"), F.col("niveau").cast("string"),
        *[F.col(c).cast("long").alias(c) for c in ("id_reference", "id_province_prefecture", "id_commune", "id_region")],
        "lieu_key",
    )
    best = top1(typed, WEIGHT_KEY, [desc_nulls_as("poids", -1), F.col("lieu_key")]).select(*cols)
    tgt = target if target is not None else best.limit(0)
    return upsert(tgt.select(*cols), best, WEIGHT_KEY, ["poids"])
