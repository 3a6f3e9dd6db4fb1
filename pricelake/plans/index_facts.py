"""The index/price fact: normalise -> exclude -> match distinct cities -> override by name -> look up ->
top-1 dedupe -> upsert -> (audit elsewhere).

``build_index_fact`` is the domain composition; ``index_facts`` runs it on the driver tables (the flagship
query): lineitem lines are the price rows, the customer's nation name is the city text, nations are the
provinces, regions their parents, part names the varieties and brands the products.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake import constants as K
from pricelake.functions.text import upper_trim
from pricelake.operators import dims as D
from pricelake.operators import facts as FA
from pricelake.operators import likes as LK
from pricelake.operators import match as M
from pricelake.plans.tables import Tables
from pricelake.session import cut_lineage
from pricelake.sources import partitioned as PT

FACT_SCHEMA = T.StructType(
    [
        T.StructField("annee", T.IntegerType()),
        T.StructField("valeur_indice", T.DecimalType(18, 6)),
        T.StructField("prix_moyen", T.DecimalType(18, 6)),
        T.StructField("type_indice", T.StringType()),
        T.StructField("id_reference", T.LongType()),
        T.StructField("id_province_prefecture", T.LongType()),
        T.StructField("id_region", T.LongType()),
        T.StructField("agglomeration_raw", T.StringType()),
        T.StructField("match_quality", T.StringType()),
    ]
)
NATURAL_KEY = ["annee", "type_indice", "id_reference", "id_province_prefecture", "id_region"]
UPDATE_COLS = ["valeur_indice", "prix_moyen", "match_quality"]


def build_index_fact(
    staging: DataFrame,
    provinces: DataFrame,
    products: DataFrame,
    varieties: DataFrame,
    exclusions: DataFrame | None,
    overrides: DataFrame | None,
    target: DataFrame | None = None,
    tie_break: Sequence[str] = (),
    compat: bool = False,
    fold: bool = False,
    cities: DataFrame | None = None,
) -> DataFrame:
    """Compose the fact.

    ``staging``: annee, indice, prix_ttc, file_type, agglomeration, produit, variete (+ ``tie_break`` columns).
    ``provinces``: nom_province_prefecture, id_province_prefecture, id_region. ``products``/``varieties``: name, id.
    ``exclusions``: agglomeration_raw, id_province_prefecture. ``overrides``: agglomeration_raw,
    correct_province_name. ``target``: the current fact (``None`` = empty, as after the rebuild).

    ``compat=True`` applies the overrides after the dedupe and upsert, as the source system does (Q25): the
    unmatched cities then collapse before they are fixed; and the city text is a LIKE pattern (``_`` and ``%`` in it are
    wildcards), not plain text. ``fold=True`` matches accent-folded names (J5). ``cities``: a
    column ``agglomeration`` that holds every city of the staging rows, if that is cheaper to read than they are.
    """
    # 1. normalise
    base = staging.select(
        F.col("annee").cast("int").alias("annee"),
        F.col("indice").cast("decimal(18,6)").alias("valeur_indice"),
        F.col("prix_ttc").cast("decimal(18,6)").alias("prix_moyen"),
        upper_trim("file_type").alias("type_indice"),
        upper_trim("agglomeration").alias("agglomeration_raw"),
        upper_trim("produit").alias("produit_name"),
        upper_trim("variete").alias("variete_name"),
        *tie_break,
    )
    # 2. exclude
    kept = M.exclude_values(base, "agglomeration_raw", K.EXCLUDED_CITY_LITERALS, exclusions)
    # 3. match distinct cities (fan-out kept)
    prov = provinces.select("nom_province_prefecture", "id_province_prefecture", "id_region")
    values = cities.select(upper_trim("agglomeration").alias("agglomeration_raw")) if cities is not None else None
    ids = ["id_province_prefecture", "id_region"]
    if compat:
        matched = LK.like_join(kept, "agglomeration_raw", prov, "nom_province_prefecture", ids, values=values)
    else:
        matched = M.contains_join(kept, "agglomeration_raw", prov, "nom_province_prefecture", ids, fold=fold, values=values)
    matched = matched.drop("n_candidates").withColumn("match_quality", M.match_label("id_province_prefecture"))
    resolved = FA.resolve_overrides(overrides, prov) if overrides is not None else None
    # 4. overrides by name, before the dedupe
    if resolved is not None and not compat:
        matched = FA.apply_overrides(matched, resolved).drop("__overridden")
    # 5. look up the polymorphic reference
    looked = D.lookup(matched, "variete_name", varieties.withColumnRenamed("id", "id_variete"), "name", ["id_variete"], normalise=False)
    looked = D.lookup(looked, "produit_name", products.withColumnRenamed("id", "id_produit"), "name", ["id_produit"], normalise=False)
    looked = looked.withColumn(
        "id_reference", FA.poly_ref("type_indice", {K.FILE_TYPE_T1: "id_variete", K.FILE_TYPE_T3: "id_produit"}).cast("long")
    )
    # 6. top-1 per natural key, total order
    order = [FA.desc_nulls_as("prix_moyen", -1), FA.desc_nulls_as("valeur_indice", -1), *[F.col(c) for c in tie_break]]
    best = FA.top1(looked, NATURAL_KEY, order)
    src = best.select(*[F.col(f.name).cast(f.dataType) for f in FACT_SCHEMA.fields], *tie_break)
    # 7. upsert into the current version; without one the deduplicated rows are the new version
    fact = src
    if target is not None:
        types_of = {c: src.schema[c].dataType for c in tie_break}
        tgt = target.select(
            *[F.col(f.name).cast(f.dataType) for f in FACT_SCHEMA.fields],
            *[(F.col(c) if c in target.columns else F.lit(None)).cast(types_of[c]).alias(c) for c in tie_break],
        )
        fact = FA.upsert(tgt, src, NATURAL_KEY, UPDATE_COLS)
    if resolved is not None and compat:
        fact = FA.apply_overrides(fact, resolved).drop("__overridden")
    return fact


def with_fact_ids(fact: DataFrame, tie_break: Sequence[str] = (), known: DataFrame | None = None) -> DataFrame:
    """D1 on the fact: ``id_indice`` 1..n in natural-key order (NULLs first), ties by ``tie_break``. Natural keys of
    ``known`` (the version before) keep their ids; only new ones are numbered, from its greatest id on."""
    order = [*NATURAL_KEY, *tie_break]
    if known is None:
        return D.assign_ids(fact, order, "id_indice")
    old = known.groupBy(*[F.col(k).alias(f"__{k}") for k in NATURAL_KEY]).agg(F.min("id_indice").alias("id_indice"))
    same = None
    for k in NATURAL_KEY:
        one = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = one if same is None else same & one
    joined = cut_lineage(fact.join(old, same, "left").select(*fact.columns, "id_indice"))
    fresh = D.assign_ids(joined.where("id_indice IS NULL").drop("id_indice"), order, "id_indice", start=D.max_id(known, "id_indice"))
    return joined.where("id_indice IS NOT NULL").unionByName(fresh)


def upsert_fact(source: DataFrame, root: str, tie_break: Sequence[str] = (), best: bool = False) -> list[str | None]:
    """U1 and D1 on the stored fact at ``root`` (see :mod:`pricelake.sources.partitioned`), partitioned by ``annee``: only
    the years that ``source`` falls in are rewritten. ``source``: the fact's columns without ids, natural keys once each.

    Matched keys keep their ids; they take the source's update columns, or, with ``best``, the row that comes first in the
    order of the dedupe (W1), so that the result doesn't depend on the order in which sources come or come again. New keys
    are numbered from the greatest id of the whole table on, which its manifest holds."""
    spark = source.sparkSession
    start = PT.max_id(spark, root)
    columns = ["id_indice", *[f.name for f in FACT_SCHEMA.fields], *tie_break]

    def merge(target: DataFrame, rows: DataFrame) -> DataFrame:
        if best:
            both = target.withColumn("__old", F.lit(0)).unionByName(rows.withColumn("__old", F.lit(1)))
            same = Window.partitionBy(*NATURAL_KEY)
            order = [FA.desc_nulls_as("prix_moyen", -1), FA.desc_nulls_as("valeur_indice", -1), *[F.col(c) for c in tie_break], F.col("__old")]
            merged = both.withColumn("__id", F.max("id_indice").over(same)).withColumn("__rn", F.row_number().over(same.orderBy(*order)))
            merged = merged.where("__rn = 1").withColumn("id_indice", F.col("__id")).select(*columns)
        else:
            merged = FA.upsert(target.select(*columns), rows, NATURAL_KEY, UPDATE_COLS)
        merged = cut_lineage(merged)
        fresh = D.assign_ids(merged.where("id_indice IS NULL").drop("id_indice"), [*NATURAL_KEY, *tie_break], "id_indice", start=start)
        return merged.where("id_indice IS NOT NULL").unionByName(fresh.select(*columns))

    return PT.upsert_partitions(source.select(F.lit(None).cast("long").alias("id_indice"), *columns[1:]), root, "annee", merge, "id_indice")


# ------------------------------------------------------------------------------------------------ on the driver tables
def _staging(spark: SparkSession, sf: str) -> DataFrame:
    """Price rows of the flagship: lineitem lines with the order year, the customer's nation name as city text
    (cities of region 0 are written without the underscore, so they need the override map), part brand/name."""
    t = Tables(spark, sf, spread=True)
    nat = t.nation
    city = F.when(F.col("n_regionkey") == 0, F.replace(F.col("n_name"), F.lit("_"), F.lit(""))).otherwise(F.col("n_name"))
    flag = F.col("l_returnflag")
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "l_extendedprice")
        .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey")
        .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(nat.select(F.col("n_nationkey").alias("c_nationkey"), city.alias("agglomeration")), "c_nationkey")
        .join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("produit"), F.col("p_name").alias("variete")), "l_partkey", "left")
        .select(
            F.year("o_orderdate").alias("annee"),
            F.col("l_quantity").alias("indice"),
            F.col("l_extendedprice").alias("prix_ttc"),
            F.when(flag == "R", F.lit("T1")).when(flag == "A", F.lit("T3")).otherwise(F.lit("UNKNOWN")).alias("file_type"),
            "agglomeration",
            "produit",
            "variete",
            "l_orderkey",
            "l_linenumber",
        )
    )


def _cities(spark: SparkSession, sf: str) -> DataFrame:
    """The city texts of the flagship, from the small table that they come from."""
    nat = Tables(spark, sf).nation
    return nat.select(F.when(F.col("n_regionkey") == 0, F.replace(F.col("n_name"), F.lit("_"), F.lit(""))).otherwise(F.col("n_name")).alias("agglomeration"))


def _exclusions(spark: SparkSession, sf: str) -> DataFrame:
    """Exclusion table of the flagship: the nations of region 4, with no target."""
    nat = Tables(spark, sf, spread=True).nation
    return nat.where(F.col("n_regionkey") == 4).select(
        upper_trim("n_name").alias("agglomeration_raw"), F.lit(None).cast("long").alias("id_province_prefecture")
    )


def _inputs(spark: SparkSession, sf: str):
    t = Tables(spark, sf, spread=True)
    nat = t.nation
    staging = _staging(spark, sf)
    provinces = nat.select(
        F.col("n_name").alias("nom_province_prefecture"),
        F.col("n_nationkey").cast("long").alias("id_province_prefecture"),
        F.col("n_regionkey").cast("long").alias("id_region"),
    )
    products = D.assign_ids(D.distinct_keys(t.part, "p_brand", "name"), "name", "id")
    varieties = D.assign_ids(D.distinct_keys(t.part, "p_name", "name"), "name", "id")
    exclusions = _exclusions(spark, sf)
    overrides = nat.where(F.col("n_regionkey") == 0).select(
        F.replace(upper_trim("n_name"), F.lit("_"), F.lit("")).alias("agglomeration_raw"),
        upper_trim("n_name").alias("correct_province_name"),
    )
    return staging, provinces, products, varieties, exclusions, overrides


_OUT = ["id_indice", "annee", "type_indice", "id_reference", "id_province_prefecture", "id_region", "agglomeration_raw", "valeur_indice", "prix_moyen", "match_quality"]


def _run(spark: SparkSession, sf: str, compat: bool) -> DataFrame:
    tb = ["l_orderkey", "l_linenumber"]
    fact = build_index_fact(*_inputs(spark, sf), tie_break=tb, compat=compat, cities=_cities(spark, sf))
    fact = with_fact_ids(fact, tb)
    return fact.select(
        *[F.col(c).cast("double").alias(c) if c in ("valeur_indice", "prix_moyen") else F.col(c) for c in _OUT]
    )


def index_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the index fact on the driver tables, overrides applied before the dedupe."""
    return _run(spark, sf, compat=False)


def index_facts_compat(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the source system's order: dedupe, upsert, then overrides (Q25 reproduced)."""
    return _run(spark, sf, compat=True)


_SQL_COMMON = """
WITH nat AS (
  SELECT n_nationkey, n_regionkey, n_name, CASE WHEN n_regionkey = 0 THEN replace(n_name, '_', '') ELSE n_name END AS city
  FROM nation
), variety AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(p_name)) AS name FROM part WHERE trim(p_name) <> '')
), product AS (
  SELECT name, CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT upper(trim(p_brand)) AS name FROM part WHERE trim(p_brand) <> '')
), base AS (
  SELECT l.l_orderkey, l.l_linenumber, CAST(year(o.o_orderdate) AS INTEGER) AS annee,
    CAST(l.l_quantity AS DECIMAL(18,6)) AS valeur_indice, CAST(l.l_extendedprice AS DECIMAL(18,6)) AS prix_moyen,
    CASE l.l_returnflag WHEN 'R' THEN 'T1' WHEN 'A' THEN 'T3' ELSE 'UNKNOWN' END AS type_indice,
    upper(trim(nt.city)) AS agglomeration_raw, upper(trim(p.p_brand)) AS produit_name, upper(trim(p.p_name)) AS variete_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nat nt ON c.c_nationkey = nt.n_nationkey LEFT JOIN part p ON l.l_partkey = p.p_partkey
), excl AS (
  SELECT upper(trim(n_name)) AS agglomeration_raw, CAST(NULL AS BIGINT) AS target FROM nation WHERE n_regionkey = 4
), filtered AS (
  SELECT * FROM base WHERE agglomeration_raw NOT IN ('AL', '') AND agglomeration_raw IS NOT NULL
    AND agglomeration_raw NOT IN (SELECT agglomeration_raw FROM excl WHERE target IS NULL)
), matched AS (
  SELECT f.*, CAST(d.n_nationkey AS BIGINT) AS id_province_prefecture, CAST(d.n_regionkey AS BIGINT) AS id_region,
    CASE WHEN d.n_nationkey IS NULL THEN 'UNMATCHABLE' ELSE 'MATCHED' END AS match_quality
  FROM filtered f LEFT JOIN nation d ON instr(upper(d.n_name), f.agglomeration_raw) > 0
), ovr AS (
  SELECT replace(upper(trim(n_name)), '_', '') AS agglomeration_raw, CAST(n_nationkey AS BIGINT) AS op, CAST(n_regionkey AS BIGINT) AS oreg
  FROM nation WHERE n_regionkey = 0
)
"""

ORACLE_SQL = (
    _SQL_COMMON
    + """
, fixed AS (
  SELECT m.* EXCLUDE (id_province_prefecture, id_region, match_quality),
    CASE WHEN m.id_region IS NULL AND o.op IS NOT NULL THEN o.op ELSE m.id_province_prefecture END AS id_province_prefecture,
    CASE WHEN m.id_region IS NULL AND o.op IS NOT NULL THEN o.oreg ELSE m.id_region END AS id_region,
    CASE WHEN m.id_region IS NULL AND o.op IS NOT NULL THEN 'MATCHED_MANUAL' ELSE m.match_quality END AS match_quality
  FROM matched m LEFT JOIN ovr o ON m.agglomeration_raw = o.agglomeration_raw
), lk AS (
  SELECT f.*, CASE WHEN f.type_indice = 'T1' THEN v.id WHEN f.type_indice = 'T3' THEN pr.id END AS id_reference
  FROM fixed f LEFT JOIN variety v ON f.variete_name = v.name LEFT JOIN product pr ON f.produit_name = pr.name
), src AS (
  SELECT *, row_number() OVER (PARTITION BY annee, type_indice, id_reference, id_province_prefecture, id_region
    ORDER BY coalesce(prix_moyen, -1) DESC, coalesce(valeur_indice, -1) DESC, l_orderkey, l_linenumber) AS rn
  FROM lk
)
SELECT CAST(row_number() OVER (ORDER BY annee NULLS FIRST, type_indice NULLS FIRST, id_reference NULLS FIRST,
         id_province_prefecture NULLS FIRST, id_region NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS BIGINT) AS id_indice,
  annee, type_indice, id_reference, id_province_prefecture, id_region, agglomeration_raw,
  CAST(valeur_indice AS DOUBLE) AS valeur_indice, CAST(prix_moyen AS DOUBLE) AS prix_moyen, match_quality
FROM src WHERE rn = 1
"""
)

ORACLE_SQL_COMPAT = (
    _SQL_COMMON.replace("instr(upper(d.n_name), f.agglomeration_raw) > 0", "upper(d.n_name) LIKE '%' || f.agglomeration_raw || '%'")
    + """
, lk AS (
  SELECT m.*, CASE WHEN m.type_indice = 'T1' THEN v.id WHEN m.type_indice = 'T3' THEN pr.id END AS id_reference
  FROM matched m LEFT JOIN variety v ON m.variete_name = v.name LEFT JOIN product pr ON m.produit_name = pr.name
), src AS (
  SELECT *, row_number() OVER (PARTITION BY annee, type_indice, id_reference, id_province_prefecture, id_region
    ORDER BY coalesce(prix_moyen, -1) DESC, coalesce(valeur_indice, -1) DESC, l_orderkey, l_linenumber) AS rn
  FROM lk
), top AS (SELECT * FROM src WHERE rn = 1),
fixed AS (
  SELECT t.* EXCLUDE (id_province_prefecture, id_region, match_quality),
    CASE WHEN t.id_region IS NULL AND o.op IS NOT NULL THEN o.op ELSE t.id_province_prefecture END AS id_province_prefecture,
    CASE WHEN t.id_region IS NULL AND o.op IS NOT NULL THEN o.oreg ELSE t.id_region END AS id_region,
    CASE WHEN t.id_region IS NULL AND o.op IS NOT NULL THEN 'MATCHED_MANUAL' ELSE t.match_quality END AS match_quality
  FROM top t LEFT JOIN ovr o ON t.agglomeration_raw = o.agglomeration_raw
)
SELECT CAST(row_number() OVER (ORDER BY annee NULLS FIRST, type_indice NULLS FIRST, id_reference NULLS FIRST,
         id_province_prefecture NULLS FIRST, id_region NULLS FIRST, l_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS BIGINT) AS id_indice,
  annee, type_indice, id_reference, id_province_prefecture, id_region, agglomeration_raw,
  CAST(valeur_indice AS DOUBLE) AS valeur_indice, CAST(prix_moyen AS DOUBLE) AS prix_moyen, match_quality
FROM fixed
"""
)
