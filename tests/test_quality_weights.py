import pytest
from pyspark.sql import functions as F

from pricelake.operators import quality as Q
from pricelake.operators import weights as W


def test_weight_staging_wide_and_long(spark):
    wide = spark.createDataFrame([("FES", "Béton", "0,25", ""), ("RABAT", "Acier", "1", "2")], "`Ville` string, `Variété` string, `2019` string, `2020` string")
    st = {(r["lieu"], r["annee"]): (r["niveau"], r["variete"], r["poids"]) for r in W.stage_weight_table(wide).collect()}
    assert st[("FES", 2019)][0] == "VILLE" and float(st[("FES", 2019)][2]) == 0.25
    assert ("FES", 2020) not in st and float(st[("RABAT", 2020)][2]) == 2.0
    long = spark.createDataFrame([("Souss", "Béton", "2020", "0,5")], "`Région` string, variete string, `Année` string, poids string")
    r = W.stage_weight_table(long).first()
    assert (r["niveau"], r["lieu"], r["annee"], float(r["poids"])) == ("REGION", "Souss", 2020, 0.5)


def test_both_weight_levels_are_staged(spark):
    rows = [("FES", "Fès-Meknès", "Béton", "2020", "0,25"), (" ", "Souss", "Béton", "2020", "0,5"), (None, "Souss", "Acier", "2020", "1")]
    df = spark.createDataFrame(rows, "`Ville` string, `Région` string, `Variété` string, `Année` string, `Poids` string")
    got = sorted((r["niveau"], r["lieu"], r["variete"]) for r in W.stage_weight_table(df).collect())
    assert got == [("REGION", "Souss", "Acier"), ("REGION", "Souss", "Béton"), ("VILLE", "FES", "Béton")]


def test_weight_fact_dedupe_and_upsert(spark):
    staged = spark.createDataFrame(
        [("VILLE", "fes", "BÉTON", 2020, 0.2), ("VILLE", "FES", "BÉTON", 2020, 0.4), ("REGION", "souss", "BÉTON", 2020, 0.9)],
        "niveau string, lieu string, variete string, annee int, poids double",
    )
    var = spark.createDataFrame([("BÉTON", 1)], "name string, id long")
    prov = spark.createDataFrame([("PRÉFECTURE DE FÈS", 4, 1)], "nom string, id long, id_parent long")
    reg = spark.createDataFrame([("SOUSS", 9)], "nom string, id long")
    f = W.weight_fact(staged, var, prov, reg, fold=True)
    got = sorted((r["niveau"], r["id_province_prefecture"], r["id_region"], float(r["poids"])) for r in f.collect())
    assert got == [("REGION", None, 9, 0.9), ("VILLE", 4, 1, 0.4)]
    again = W.weight_fact(staged, var, prov, reg, target=f, fold=True)
    assert again.count() == 2


def test_shares_and_unpivot(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "g string, v double")
    assert sorted((r["g"], r["poids"]) for r in W.shares(df, ["g"], "v").collect()) == [("a", 0.25), ("a", 0.75), ("b", 1.0)]
    wide = spark.createDataFrame([("x", 1.0, None, 2.0)], "k string, `2019` double, `2020` double, other double")
    assert sorted((r["annee"], r["value"]) for r in W.unpivot_years(wide, ["k"]).collect()) == [(2019, 1.0)]


def test_catalog_schema_and_required(spark):
    a = spark.createDataFrame([(1, "x")], "id long, nom string")
    rep = {r["table_name"]: r for r in Q.catalog_report(spark, {"a": a, "missing": None}).collect()}
    assert rep["a"]["row_count"] == 1 and rep["a"]["columns"] == "id, nom" and not rep["missing"]["table_exists"]
    assert Q.schema_check(a, "a", required=["id"], forbidden=["nom"]).first()["status"] == "WARN"
    assert Q.schema_check(a, "a", required=["code"]).first()["status"] == "ERROR"
    counts = Q.table_counts({"a": a, "e": a.limit(0)})
    with pytest.raises(ValueError):
        Q.require_rows(counts, ["a", "e"])
    Q.require_rows(counts, ["a"])


def test_reports(spark):
    df = spark.createDataFrame([(1, None, "M"), (2, 5, "M"), (3, 5, None)], "k int, fk long, q string")
    assert Q.match_report(df, "fk").first()["success_rate"] is not None
    assert {r["q"] for r in Q.share_of_total(df, "q").collect()} == {"M", None}
    prof = {r["q"]: r for r in Q.profile_by(df, "q", "k", "k", "fk").collect()}
    assert prof["(NULL)"]["n_rows"] == 1
    parent = spark.createDataFrame([(5,)], "id long")
    orph = Q.fk_orphans(df, [("fk", parent, "id", "t.fk")]).first()
    assert (orph["null_fk"], orph["orphans"], orph["status"]) == (1, 0, "OK")
    rules = {r["rule_name"]: r["violations"] for r in Q.row_rules(df, {"has_fk": F.col("fk").isNotNull(), "one": Q.exactly_one("fk", "q")}).collect()}
    assert rules == {"has_fk": 1, "one": 1}
    snap = Q.run_snapshot("r1", Q.table_counts({"t": df})).first()
    assert snap["counts"] == {"t": 3}
