"""The price-index plan: landing tree -> raw rows -> staging -> references -> dimensions -> facts -> audit.

Every stage is a function ``DataFrame(s) -> DataFrame``; ``run`` wires them and writes the tables. Constants that
are data (region codes, aliases, exclusions, overrides, thresholds) come from :mod:`pricelake.constants` and can
be replaced by arguments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions.text import blank_to_null, normalize_code, parse_decimal, strict_int, upper_trim
from pricelake.operators import dims as D
from pricelake.operators import facts as FA
from pricelake.operators import paths as P
from pricelake.operators import quality as Q
from pricelake.operators import refs as R
from pricelake.operators.resolve import first_col, pick_name_column, resolve_fields
from pricelake.plans.index_facts import build_index_fact, with_fact_ids
from pricelake.session import cut_lineage
from pricelake.sources import files as S
from pricelake.sources import ranges as RG
from pricelake.sources import sinks as SK


#: CSV files beyond this size are read in byte ranges instead of as one record.
LARGE_BYTES = 256 << 20


# --------------------------------------------------------------------------------------------------------- bronze
def land_rows(spark: SparkSession, landing_root: str, ref_root: str | None = None, compat: bool = False,
              drops: str = "newest", large_bytes: int = LARGE_BYTES) -> DataFrame:
    """Bronze: the rows (all statuses, see :func:`S.to_rows`) of the CSV files, of the newest ZIP drop (S3; ``drops="all"``:
    of every drop) and of the reference CSVs, which join the run under their own folder (S12). CSV files of more than
    ``large_bytes`` are read in byte ranges (not with ``compat``)."""
    files = S.scan_tree(spark, landing_root, "*.csv")
    large = [] if compat else files.where(F.col("length") > large_bytes).select("path", "rel_path").collect()  # a row per large file
    if large:
        files = files.where(F.col("length") <= large_bytes)
    zips = S.scan_tree(spark, landing_root, "*.zip")
    if drops == "newest":
        zips = zips.where(F.col("path") == zips.select(F.max("path")).scalar())
    columns = ["archive", "rel_path", "content"]
    members = S.explode_archives(zips).where(F.lower(F.col("rel_path")).endswith(".csv"))
    files = files.select(*columns).unionByName(members.select(*columns))
    if ref_root:
        refs = S.scan_tree(spark, ref_root, "*.csv")
        files = files.unionByName(refs.select("archive", F.concat(F.lit(K.REFERENCE_FOLDER + "/"), "rel_path").alias("rel_path"), "content"))
    rows = S.to_rows(S.sniff(files), compat=compat)
    if large:
        rows = rows.unionByName(RG.read_csv_ranges(spark, [r["path"] for r in large], {r["path"]: r["rel_path"] for r in large}))
    return rows


def raw_rows(parsed: DataFrame, run_id: str) -> DataFrame:
    """The data rows of a run with their dataset and load stamp."""
    return parsed.where(F.col("status") == "ok").select(
        F.lit(run_id).alias("run_id"), *S.FILE_KEY, P.dataset_class(F.col("rel_path"), fold=True).alias("dataset"),
        "row_index", "row_json", F.current_timestamp().alias("load_ts"),
    )


def land(spark: SparkSession, landing_root: str, run_id: str, ref_root: str | None = None, compat: bool = False,
         drops: str = "newest") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(manifest, raw rows, all parsed rows) of a run. Every file is parsed once; the parsed rows are checkpointed."""
    parsed = cut_lineage(land_rows(spark, landing_root, ref_root, compat, drops))
    return S.manifest(parsed, run_id), raw_rows(parsed, run_id), parsed


def stage_prices(
    raw: DataFrame, exclusive: bool = False, fold: bool = False, aliases: dict[str, list[str]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """price/index staging rows from raw row objects. Returns (staged rows, rejected rows).

    Fields by tolerant lookup (P1) over the price aliases; the year is mandatory (P3); the level, region and city
    come from the path (P4-P6); price and index parse decimal commas (F5); text fields turn blank into NULL."""
    # parse each row object once (own projection), then resolve every field against the parsed map
    parsed = raw.where(F.col("dataset") == K.DATASET_PRICES).select("run_id", *S.FILE_KEY, "row_index", S.row_map("row_json").alias("__m"))
    # The alias map is configuration (a plain dict); the default is the source system's list
    alias_map = aliases or K.PRICE_ALIASES
    rows = parsed.select("run_id", *S.FILE_KEY, "row_index", *resolve_fields("__m", alias_map, fold=fold, exclusive=exclusive))
    rows = rows.withColumn("annee_int", strict_int("annee"))
    lv = P.classify_level("rel_path", "region")
    staged = rows.where(F.col("annee_int").isNotNull()).select(
        lv.niveau.alias("niveau"),
        lv.region.alias("region"),
        lv.agglomeration.alias("agglomeration"),
        blank_to_null("corps").alias("corps"),
        blank_to_null("activite").alias("activite"),
        blank_to_null("produit").alias("produit"),
        blank_to_null("variete").alias("variete"),
        F.col("annee_int").alias("annee"),
        parse_decimal("prix_ttc").alias("prix_ttc"),
        parse_decimal("indice").alias("indice"),
        P.file_type("rel_path").alias("file_type"),
        F.when(F.col("archive") == "", F.col("rel_path")).otherwise(F.concat_ws("!/", *S.FILE_KEY)).alias("source_file"),
        "row_index",
        F.current_timestamp().alias("load_ts"),
    )
    rejected = rows.where(F.col("annee_int").isNull()).select(*S.FILE_KEY, "row_index", "annee")
    return staged, rejected


# --------------------------------------------------------------------------------------------------------- silver
@dataclass
class RefSpec:
    candidates: list[str]
    code_cols: list[str]
    name_cols: list[str]
    parent_cols: list[str] = field(default_factory=list)


REF_SPECS = {
    "region": RefSpec(K.REGION_FILE_CANDIDATES, K.REGION_CODE_CANDIDATES, K.REGION_NAME_CANDIDATES),
    "province": RefSpec(K.PROVINCE_FILE_CANDIDATES, K.PROVINCE_CODE_CANDIDATES, K.PROVINCE_NAME_CANDIDATES, K.PROVINCE_REGION_CANDIDATES),
    "commune": RefSpec(K.COMMUNE_FILE_CANDIDATES, K.COMMUNE_CODE_CANDIDATES, K.COMMUNE_NAME_CANDIDATES, K.COMMUNE_PROVINCE_CANDIDATES),
}


def load_reference(raw: DataFrame, run_id: str, spec: RefSpec) -> DataFrame | None:
    """S7 -> P9/P10 -> P11: one reference table (code, name, parent_code), or None when the file is absent."""
    rows = S.read_rows(raw, run_id, K.DATASET_REFERENCE, spec.candidates)
    wide = S.widen(rows)
    cols = [c for c in wide.columns if c not in ("rel_path", "row_index")]
    if not cols:
        return None
    code = first_col(cols, *spec.code_cols)
    if code is None:
        raise ValueError(f"code column not found among {cols}")
    name = pick_name_column(wide.select(*cols), spec.name_cols, normalize_code(F.col(f"`{code}`")))
    if name is None:
        raise ValueError(f"name column not found among {cols}")
    parent = first_col(cols, *spec.parent_cols) if spec.parent_cols else None
    # Q15: one name per code, the first by file and row
    return R.clean_ref(wide, F.col(f"`{code}`"), F.col(f"`{name}`"), F.col(f"`{parent}`") if parent else None, order_by=F.struct("rel_path", "row_index"))


def silver_references(raw: DataFrame, run_id: str, compat: bool = False) -> dict[str, DataFrame | None]:
    """Region, province and commune references, with the hierarchy-code repair."""
    out = {k: load_reference(raw, run_id, s) for k, s in REF_SPECS.items()}
    if out["province"] is not None:
        out["province"] = (
            R.fill_parent_code(out["province"], "code", "parent_code", prefix_len=2)
            if compat
            else R.fill_parent_code(out["province"], "code", "parent_code", drop_last=3)
        )
    if out["commune"] is not None:
        c = R.fill_commune_province(out["commune"], "code", "parent_code")
        out["commune"] = R.fill_parent_code(c, "code", "parent_code", prefix_len=5, min_len=5)
    return out


# ----------------------------------------------------------------------------------------------------------- gold
def _empty_dim(spark: SparkSession, extra: str = "") -> DataFrame:
    return spark.createDataFrame([], "id long, name string" + (f", {extra}" if extra else ""))


def geography(refs: dict[str, DataFrame | None], current: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Three-level geography grown insert-only; a missing parent takes the first parent id (J9, flagged)."""
    if not any(d is not None for d in refs.values()):
        raise ValueError("no reference table was loaded")
    spark = next(d for d in refs.values() if d is not None).sparkSession
    current = current or {}
    out = {}
    reg = refs.get("region")
    reg_c = (reg.select(upper_trim("code").alias("name"), upper_trim("name").alias("nom")) if reg is not None else spark.createDataFrame([], "name string, nom string"))
    out["region"] = D.grow_dim(current.get("region", _empty_dim(spark, "nom string")), reg_c, "name", "id", ["nom"])
    prov = refs.get("province")
    if prov is not None:
        p = prov.select(upper_trim("code").alias("name"), upper_trim("name").alias("nom"), upper_trim("parent_code").alias("pc"))
        p = D.lookup(p, "pc", out["region"].select(F.col("id").alias("id_parent"), "name"), "name", ["id_parent"], normalise=False)
        p = D.with_parent_fallback(p, "id_parent", out["region"], "id")
        out["province"] = D.grow_dim(current.get("province", _empty_dim(spark, "nom string, id_parent long")), p, "name", "id", ["nom", "id_parent"])
    com = refs.get("commune")
    if com is not None and "province" in out:
        c = com.select(upper_trim("code").alias("name"), upper_trim("name").alias("nom"), upper_trim("parent_code").alias("pc"))
        c = D.lookup(c, "pc", out["province"].select(F.col("id").alias("id_parent"), "name"), "name", ["id_parent"], normalise=False)
        c = D.with_parent_fallback(c, "id_parent", out["province"], "id")
        out["commune"] = D.grow_dim(current.get("commune", _empty_dim(spark, "nom string, id_parent long")), c, "name", "id", ["nom", "id_parent"])
    return out


def trade_chain(staging: DataFrame, current: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Five-level trade chain: metier = corps (Q19), corps, activity, product, variety; each child takes the
    smallest parent id among its pairs (A2) and grows insert-only (U2, Q17/Q18 fixed)."""
    spark = staging.sparkSession
    current = current or {}
    out = {}
    # all levels are built from the distinct chains, written once
    staging = cut_lineage(staging.select("corps", "activite", "produit", "variete").distinct())
    out["metier"] = D.grow_dim(current.get("metier", _empty_dim(spark)), D.distinct_keys(staging, "corps", "name"), "name", "id")
    chain = [("corps", "corps", None, "metier"), ("activite", "activite", "corps", "corps"),
             ("produit", "produit", "activite", "activite"), ("variete", "variete", "produit", "produit")]
    for level, col, parent_col, parent_dim in chain:
        parent_src = "corps" if level == "corps" else parent_col
        pairs = staging.where(F.col(col).isNotNull()).select(upper_trim(col).alias("name"), upper_trim(parent_src).alias("pk"))
        pairs = D.lookup(pairs, "pk", out[parent_dim].select(F.col("id").alias("id_parent"), "name"), "name", ["id_parent"], how="inner", normalise=False)
        cand = D.min_parent(pairs, "name", "id_parent")
        out[level] = D.grow_dim(current.get(level, _empty_dim(spark, "id_parent long")), cand, "name", "id", ["id_parent"])
    return out


def _overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(K.CITY_OVERRIDES), "agglomeration_raw string, correct_province_name string, row_count int")


def fact_references(spark: SparkSession, geo: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Provinces, exclusions and overrides as the index fact takes them."""
    provinces = geo["province"].select(
        F.col("nom").alias("nom_province_prefecture"), F.col("id").alias("id_province_prefecture"), F.col("id_parent").alias("id_region")
    )
    exclusions = spark.createDataFrame(list(K.CITY_EXCLUSIONS), "agglomeration_raw string, id_province_prefecture long")
    return provinces, exclusions, _overrides(spark)


def gold_facts(staging: DataFrame, geo: dict[str, DataFrame], trade: dict[str, DataFrame], compat: bool = False,
               target: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """The index fact (see :func:`pricelake.plans.index_facts.build_index_fact`) with ids; natural keys of ``known`` (the
    last version of the fact) keep theirs."""
    provinces, exclusions, overrides = fact_references(staging.sparkSession, geo)
    tb = ["source_file", "row_index"]
    fact = build_index_fact(
        staging.select("annee", "indice", "prix_ttc", "file_type", "agglomeration", "produit", "variete", *tb),
        provinces, trade["produit"].select("name", "id"), trade["variete"].select("name", "id"),
        exclusions, overrides, target=target, tie_break=tb, compat=compat,
    )
    return with_fact_ids(fact, tb, known).drop(*tb)


def load_weight_file(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """One weight file, schema from its header, names verbatim, every cell text (same dialect sniffing and
    parser as the landing). A missing or empty file gives ``None`` (a warning, not an error)."""
    files = S.scan_tree(spark, root, name)
    rows = S.to_rows(S.sniff(files)).where(F.col("status") == "ok")
    wide = S.widen(rows.select("rel_path", "row_index", S.row_map("row_json").alias("row")))
    cols = [c for c in wide.columns if c not in ("rel_path", "row_index")]
    return wide.select(*[F.col(f"`{c}`") for c in cols]) if cols else None


def silver_weights(spark: SparkSession, weights_root: str) -> dict[str, DataFrame | None]:
    """Both weight files, verbatim (Q-4: both empty is a warning only)."""
    return {
        "cities": load_weight_file(spark, weights_root, K.WEIGHT_FILE_CITIES),
        "trades": load_weight_file(spark, weights_root, K.WEIGHT_FILE_TRADES),
    }


def gold_weights(verbatim: dict[str, DataFrame | None], geo: dict[str, DataFrame], trade: dict[str, DataFrame],
                 target: DataFrame | None = None) -> DataFrame | None:
    """R2 + R3: staged weights of the place-level file, then the weight fact (places matched accent-folded)."""
    from pricelake.operators import weights as W

    src = verbatim.get("cities")
    if src is None:
        return None
    staged = W.stage_weight_table(src)
    # no loader exists in the source system for this fact; places are matched accent-folded (J5), as its notes ask
    return W.weight_fact(staged, trade["variete"], geo["province"], geo["region"], target=target, fold=True, communes=geo.get("commune"))


def dropped_by_level(staging: DataFrame) -> DataFrame:
    """Q20 report: staging rows that never reach the fact (no usable city: national and regional rows, excluded
    literals and exclusion-table cities), counted per level and reason, in one aggregate."""
    city = upper_trim("agglomeration")
    excluded = F.lit(False)
    for a, target in K.CITY_EXCLUSIONS:
        if target is None:
            excluded = excluded | (city == F.lit(a))
    reason = (
        F.when(city.isNull(), F.lit("no city"))
        .when(city.isin(list(K.EXCLUDED_CITY_LITERALS)), F.lit("excluded literal"))
        .when(excluded, F.lit("exclusion table"))
    )
    return (
        staging.select("niveau", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("niveau", "reason")
        .agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
    )


def unresolved_references(staging: DataFrame, trade: dict[str, DataFrame]) -> DataFrame:
    """Q33 report, before the dedupe: staging rows whose variety (T1) or product (T3) name is not in its
    dimension (their reference would be NULL and collapse in the dedupe), per type and name."""
    t = upper_trim("file_type")
    name = F.when(t == K.FILE_TYPE_T1, upper_trim("variete")).when(t == K.FILE_TYPE_T3, upper_trim("produit"))
    rows = staging.select(t.alias("type_indice"), name.alias("name")).where(F.col("type_indice").isin(K.FILE_TYPE_T1, K.FILE_TYPE_T3))
    known = trade["variete"].select(F.lit(K.FILE_TYPE_T1).alias("type_indice"), "name").unionByName(
        trade["produit"].select(F.lit(K.FILE_TYPE_T3).alias("type_indice"), "name")
    )
    missing = rows.join(known, ["type_indice", "name"], "left_anti")
    return missing.groupBy("type_indice", "name").agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def audit(tables: dict[str, DataFrame], fact: DataFrame, run_id: str, staging: DataFrame | None = None) -> dict[str, DataFrame]:
    """Reports of the run: counts and health (A1, Q-2, Q-3, Q-8), match quality (A4-A6), keys and references (Q-1, Q-5),
    profile and coverage of the fact (A7, A9, A10) and, with ``staging``, its rows that reach no fact (Q20, Q33)."""
    counts = Q.table_counts(tables)
    keys = [(fk, tables[k], "id", f"index.{fk}") for fk, k in (("id_region", "region"), ("id_province_prefecture", "province")) if k in tables]
    levels = {"province": F.col("id_province_prefecture").isNotNull(), "region": F.col("id_province_prefecture").isNull() & F.col("id_region").isNotNull()}
    out = {
        "counts": counts,
        "null_report": Q.null_report(fact, ["id_province_prefecture", "id_region"]),
        "match_quality": Q.share_of_total(fact, "match_quality"),
        "success": Q.match_report(fact, "id_region"),
        "key_duplicates": Q.key_duplicates(fact, ["annee", "type_indice", "id_reference", "id_province_prefecture", "id_region"]),
        "health": Q.health_check(counts, ["region", "province", "index"], ["commune", "weights"]),
        "thresholds": Q.threshold_check(counts, {"region": K.MIN_ROWS["regions"], "province": K.MIN_ROWS["provinces"],
                                                 "commune": K.MIN_ROWS["communes"], "index": K.MIN_ROWS["index"], "weights": K.MIN_ROWS["weights"]}),
        "snapshot": Q.run_snapshot(run_id, counts),
        "profile_by_type": Q.profile_by(fact, "type_indice", "prix_moyen", "annee", "id_reference"),
        "year_coverage": Q.year_coverage({k: tables[k] for k in ("index", "weights") if k in tables}, "annee"),
        "level_coverage": Q.level_coverage(fact, levels, "id_reference"),
        "overrides": FA.override_report(fact.withColumn("__overridden", F.col("match_quality") == K.MATCHED_MANUAL), _overrides(fact.sparkSession)),
        "sample": Q.ordered_sample(fact, [F.col("id_indice")], 10),
    }
    if keys:
        out["fk_orphans"] = Q.fk_orphans(fact, keys)
    if {"region", "province"} <= tables.keys():
        below = [("province", tables["province"], "id", "id_parent")]
        below += [("commune", tables["commune"], "id", "id_parent")] if "commune" in tables else []
        out["hierarchy_counts"] = Q.hierarchy_counts(tables["region"].select("id", "nom"), "id", below)
    if staging is not None:
        trade = {k: tables[k] for k in ("variete", "produit")}
        out |= {"dropped_by_level": dropped_by_level(staging), "unresolved_references": unresolved_references(staging, trade)}
    return out


def run(spark: SparkSession, landing_root: str, out_root: str, run_id: str, ref_root: str | None = None,
        compat: bool = False, weights_root: str | None = None, drops: str = "newest") -> dict[str, DataFrame]:
    """Whole plan; writes raw rows (per run and dataset), staging (per run) and versioned gold tables under ``out_root``.

    A run without a valid price row, or with an empty reference, is an error; rows that the parser or the mandatory year
    left out are written per file and reason."""
    out = out_root.rstrip("/")
    manifest, raw, parsed = land(spark, landing_root, run_id, ref_root, compat, drops)
    SK.append_run(manifest.drop("run_id"), f"{out}/raw_files", run_id)
    SK.append_run(raw.drop("run_id"), f"{out}/raw_rows", run_id, by=["dataset"])
    raw_t = spark.read.parquet(f"{out}/raw_rows")
    staged, rejected = stage_prices(raw_t.where(F.col("run_id") == run_id))
    no_year = rejected.groupBy(*S.FILE_KEY).agg(F.count(F.lit(1)).cast("long").alias("n_rows")).withColumn("reason", F.lit("no valid year"))
    SK.append_run(S.skipped_rows(parsed).unionByName(no_year), f"{out}/skipped_rows", run_id)
    SK.append_run(staged, f"{out}/staging_prices", run_id)
    staging = spark.read.schema(staged.schema.add("run_id", "string")).parquet(f"{out}/staging_prices").where(F.col("run_id") == run_id)
    if staging.isEmpty():
        raise ValueError(f"run {run_id}: no valid price row")
    refs = silver_references(raw_t, run_id, compat)
    for k, v in refs.items():
        if v is not None:
            SK.replace_table(v, f"{out}/ref_{k}")
    refs = {k: (spark.read.parquet(f"{out}/ref_{k}") if v is not None else None) for k, v in refs.items()}
    loaded = {k: v for k, v in refs.items() if v is not None}
    if not loaded:
        raise ValueError("no reference table was loaded")
    Q.require_rows(Q.table_counts(loaded), list(loaded))
    geo = geography(refs, {k: d for k in ("region", "province", "commune") if (d := SK.read_latest(spark, f"{out}/dim_{k}")) is not None})
    if "province" not in geo:
        raise ValueError("the fact needs the province reference")
    trade = trade_chain(staging, {k: d for k in ("metier", "corps", "activite", "produit", "variete") if (d := SK.read_latest(spark, f"{out}/dim_{k}")) is not None})
    for k, v in {**geo, **trade}.items():
        SK.write_version(v, f"{out}/dim_{k}")
    geo = {k: SK.read_latest(spark, f"{out}/dim_{k}") for k in geo}
    trade = {k: SK.read_latest(spark, f"{out}/dim_{k}") for k in trade}
    SK.write_version(gold_facts(staging, geo, trade, compat, known=SK.read_latest(spark, f"{out}/fact_indice")), f"{out}/fact_indice")
    fact = SK.read_latest(spark, f"{out}/fact_indice")
    tables = {"raw_rows": raw_t.where(F.col("run_id") == run_id), "staging": staging, **geo, **trade, "index": fact}
    if weights_root:
        verbatim = silver_weights(spark, weights_root)
        for k, v in verbatim.items():
            if v is not None:
                SK.replace_table(v, f"{out}/weights_{k}")
                tables[f"weights_{k}"] = spark.read.parquet(f"{out}/weights_{k}")
        wf = gold_weights({k: tables.get(f"weights_{k}") for k in verbatim}, geo, trade)
        if wf is not None:
            SK.write_version(wf, f"{out}/fact_ponderation")
            tables["weights"] = SK.read_latest(spark, f"{out}/fact_ponderation")
    reports = audit(tables, fact, run_id, staging)
    reports["load_summary"] = S.load_summary(parsed)
    reports["skipped_rows"] = spark.read.parquet(f"{out}/skipped_rows").where(F.col("run_id") == run_id)
    SK.write_report(reports["snapshot"], f"{out}/reports/dq", run_id)
    extra = {"fact_weights": tables["weights"]} if "weights" in tables else {}
    return {"fact": fact, **extra, **{f"dim_{k}": v for k, v in {**geo, **trade}.items()}, **reports}
