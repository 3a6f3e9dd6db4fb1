from pyspark.sql import functions as F

from pricelake.operators import paths as P
from pricelake.operators import resolve as RS

# Worked contract: (rel_path, region column) -> (dataset, type, niveau, region, agglomeration)
CASES = [
    ("NATIONAL/maroc_T1.csv", "", "prix_indices", "T1", "NATIONAL", None, None),
    ("MS/ms_T3.csv", "", "prix_indices", "T3", "REGION", "MS", None),
    ("MARRAKECH/marrakech_T1.csv", "", "prix_indices", "T1", "VILLE", None, "MARRAKECH"),
    ("x/region-marrakech-safi_CSV/ALHAOUZ/alhaouz_T1.csv", "", "prix_indices", "T1", "VILLE", None, "ALHAOUZ"),
    ("MS/FES/fes_T1.csv", "", "prix_indices", "T1", "VILLE", None, "FES"),
    ("MS/2020/x_T1.csv", "", "prix_indices", "T1", "REGION", "MS", None),
    ("maroc_T1.csv", "", "prix_indices", "T1", "NATIONAL", None, None),
    ("bundle/maroc_T1.csv", "", "prix_indices", "T1", "VILLE", None, "BUNDLE"),
    ("foo.csv", "  Souss  Massa ", "prix_indices", "UNKNOWN", "REGION", "souss massa", None),
    ("lot1.csv", "", "prix_indices", "T1", "REGION", None, None),
    ("referentiels/region.csv", "", "referentiels", "UNKNOWN", None, None, None),
    ("referentiels/Commune (1).csv", "", "prix_indices", "UNKNOWN", "VILLE", None, "REFERENTIELS"),
]


def test_path_contract(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "p string, r string")
    lv = P.classify_level("p", "r")
    rows = df.select(
        "p", P.dataset_class("p").alias("ds"), P.file_type("p").alias("ft"), lv.niveau.alias("n"), lv.region.alias("rg"), lv.agglomeration.alias("ag")
    ).collect()
    got = {r["p"]: r for r in rows}
    for p, _, ds, ft, niveau, region, agg in CASES:
        r = got[p]
        assert r["ds"] == ds, p
        assert r["ft"] == ft, p
        if niveau is not None:
            assert (r["n"], r["rg"], r["ag"]) == (niveau, region, agg), p


def test_dataset_fold_fix(spark):
    df = spark.createDataFrame([("referentiels/Commune (1).csv",), ("referentiels/Région.csv",)], "p string")
    got = [r[0] for r in df.select(P.dataset_class("p", fold=True)).collect()]
    assert got == ["referentiels", "referentiels"]


def _field(spark, obj, aliases, **kw):
    df = spark.createDataFrame([(obj,)], "m map<string,string>")
    return df.select(RS.resolve_field("m", aliases, **kw)).first()[0]


def test_field_lookup_contract(spark):
    assert _field(spark, {" Année ": "2020"}, ["année", "annee"]) == "2020"
    assert _field(spark, {"Annee 1": "", "An": "2021"}, ["annee", "an"]) == ""
    assert _field(spark, {"Indices des prix moyens": "101,2"}, ["prix moyens", "prix"]) == "101,2"
    assert _field(spark, {"ANNÉE": "2020"}, ["annee"]) == ""  # Q3
    assert _field(spark, {"ANNÉE": "2020"}, ["annee"], fold=True) == "2020"
    assert _field(spark, {"x": "1"}, ["annee"]) == ""


def test_exclusive_fields(spark):
    df = spark.createDataFrame([({"Indices des prix moyens": "101,2"},)], "m map<string,string>")
    alias_map = {"indice": ["indice"], "prix_ttc": ["prix"]}
    shared = df.select(*RS.resolve_fields("m", alias_map)).first()
    own = df.select(*RS.resolve_fields("m", alias_map, exclusive=True)).first()
    assert shared["prix_ttc"] == "101,2"  # Q4 reproduced
    assert own["prix_ttc"] == "" and own["indice"] == "101,2"


def test_require_int_observation(spark):
    df = spark.createDataFrame([("2020",), ("2020.0",), ("",), ("2021",)], "y string")
    ok, rejected, obs = RS.require_int(df, "y", "annee")
    assert sorted(r["annee"] for r in ok.collect()) == [2020, 2021]
    assert obs.get == {"processed": 4, "skipped": 2}
    assert rejected.count() == 2


def test_first_col_and_pick_name(spark):
    cols = ["code_province", "noms_prov", "nom_provar"]
    assert RS.first_col(cols, "code_province", "code") == "code_province"
    assert RS.first_col(cols, "cod_prov", "id") is None
    df = spark.createDataFrame(
        [("1511", "PRÉFECTURE DE FÈS", "عمالة فاس"), ("1131", "PROVINCE DE KÉNITRA", "إقليم")], "code_province string, noms_prov string, nom_provar string"
    )
    # 'nom_province' matches no column, 'province' matches code_province (all digits -> no letters), 'nom' -> noms_prov
    assert RS.pick_name_column(df, ["nom_province", "province", "lib_province", "name", "nom"], F.col("code_province")) == "noms_prov"
