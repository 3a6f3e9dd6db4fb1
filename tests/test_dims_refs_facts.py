from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.operators import dims as D
from pricelake.operators import facts as FA
from pricelake.operators import match as M
from pricelake.operators import refs as R


def test_dimension_growth_contract(spark):
    dim = spark.createDataFrame([(1, "BÉTON")], "id long, name string")
    raw = spark.createDataFrame([(" béton ",), ("BÉTON",), ("acier",)], "v string")
    cand = D.distinct_keys(raw, "v", "name")
    grown = D.grow_dim(dim, cand, "name", "id")
    assert sorted(grown.collect()) == sorted([(1, "BÉTON"), (2, "ACIER")])
    again = D.grow_dim(grown, cand, "name", "id")
    assert again.count() == 2


def test_assign_ids_are_dense_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5003).alias("k"))
    got = {r["k"]: r["id"] for r in D.assign_ids(df.repartition(7), "k", "id").collect()}
    assert [got[k] for k in sorted(got)] == list(range(1, 5001))
    assert D.assign_ids(df.limit(0), "k", "id").count() == 0


def test_lookup_and_fallback(spark):
    facts = spark.createDataFrame([(" fes ",), ("rabat",)], "city string")
    dim = spark.createDataFrame([("FES", 7)], "name string, id long")
    out = D.lookup(facts, "city", dim, "name", ["id"])
    got = sorted((r["city"], r["id"]) for r in out.collect())
    assert got == [(" fes ", 7), ("rabat", None)]
    parents = spark.createDataFrame([(3,), (5,)], "pid long")
    fb = D.with_parent_fallback(out, "id", parents, "pid")
    assert sorted((r["id"], r["id_fallback"]) for r in fb.collect()) == [(3, True), (7, False)]


def test_min_parent(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", None), ("b", 2)], "name string, pid long")
    assert sorted(D.min_parent(df, "name", "pid").collect()) == [("a", 1), ("b", 2)]


def test_code_repair_contract(spark):
    df = spark.createDataFrame([("1511", ""), ("10261", None), ("12066", " "), ("1", "")], "code string, parent string")
    fixed = {r["code"]: r["parent"] for r in R.fill_parent_code(df, "code", "parent", drop_last=3).collect()}
    assert fixed == {"1511": "1", "10261": "10", "12066": "12", "1": ""}
    compat = {r["code"]: r["parent"] for r in R.fill_parent_code(df, "code", "parent", prefix_len=2).collect()}
    assert compat["1511"] == "15" and compat["10261"] == "10" and compat["12066"] == "12"


def test_clean_ref_and_first_by_order(spark):
    df = spark.createDataFrame(
        [("12.0", " fès ", "", 1), ("12", "FÈS", "", 2), ("13", "", "", 3), ("", "X", "", 4), ("14", "a", "", 5), ("14", "b", "", 6)],
        "c string, n string, p string, o int",
    )
    plain = R.clean_ref(df, "c", "n", "p")
    assert sorted(plain.select("code", "name").collect()) == [("12", "FÈS"), ("14", "A"), ("14", "B")]
    one = R.clean_ref(df, "c", "n", "p", order_by="o")
    assert sorted(one.select("code", "name").collect()) == [("12", "FÈS"), ("14", "A")]


def test_commune_rule(spark):
    df = spark.createDataFrame([("151101", ""), ("", ""), ("1234", None)], "code string, parent string")
    got = [r["parent"] for r in R.fill_commune_province(df, "code", "parent").collect()]
    assert got == ["15110", "", "1234"]


def test_contains_join_fanout_and_literal(spark):
    facts = spark.createDataFrame([(1, "NATION_1"), (2, "NATION_2"), (3, "N%"), (4, None)], "k int, city string")
    names = [(f"NATION_{i}", i) for i in range(25)]
    dim = spark.createDataFrame(names, "name string, id int")
    out = M.contains_join(facts, "city", dim, "name", ["id"])
    per = {}
    for r in out.collect():
        per.setdefault(r["k"], set()).add(r["id"])
    assert len(per[1]) == 11 and len(per[2]) == 6
    assert per[3] == {None} and per[4] == {None}  # LIKE wildcard taken literally (Q23)
    pairs = {(r["city"], r["id"]) for r in M.substring_matches(facts.select("city").distinct(), "city", dim, "name", ["id"]).collect()}
    assert pairs == {(c, i) for c in ("NATION_1", "NATION_2") for n, i in names if c in n}


def test_folded_match(spark):
    facts = spark.createDataFrame([("FES",), ("KENITRA",), ("MISSOUR",)], "city string")
    dim = spark.createDataFrame([("PRÉFECTURE DE FÈS", 1), ("PROVINCE DE KÉNITRA", 2)], "name string, id int")
    strict = {r["city"]: r["id"] for r in M.contains_join(facts, "city", dim, "name", ["id"]).collect()}
    folded = {r["city"]: r["id"] for r in M.contains_join(facts, "city", dim, "name", ["id"], fold=True).collect()}
    assert strict == {"FES": None, "KENITRA": None, "MISSOUR": None}
    assert folded == {"FES": 1, "KENITRA": 2, "MISSOUR": None}


def test_exclude_values(spark):
    df = spark.createDataFrame([("AL",), ("",), (None,), ("DAKHLA",), ("FES",), ("X",)], "c string")
    ex = spark.createDataFrame([("DAKHLA", None), ("X", 5)], "agglomeration_raw string, id_province_prefecture long")
    assert sorted(r[0] for r in M.exclude_values(df, "c", K.EXCLUDED_CITY_LITERALS, ex).collect()) == ["FES", "X"]


def test_top1_total_order(spark):
    df = spark.createDataFrame(
        [(1, None, 5.0, "b", 1), (1, 3.0, None, "a", 2), (1, 3.0, None, "a", 1), (2, None, None, "z", 9)],
        "k int, price double, idx double, src string, row int",
    )
    best = FA.top1(df, ["k"], [FA.desc_nulls_as("price", -1), FA.desc_nulls_as("idx", -1), F.col("src"), F.col("row")])
    assert sorted((r["k"], r["src"], r["row"]) for r in best.collect()) == [(1, "a", 1), (2, "z", 9)]


def test_upsert_null_safe(spark):
    t = spark.createDataFrame([(1, None, 10.0, "t"), (2, "x", 20.0, "t")], "a int, b string, v double, o string")
    s = spark.createDataFrame([(1, None, 11.0, "s"), (3, "y", 30.0, "s")], "a int, b string, v double, o string")
    got = sorted(FA.upsert(t, s, ["a", "b"], ["v"]).collect(), key=lambda r: r["a"])
    assert [(r["a"], r["b"], r["v"], r["o"]) for r in got] == [(1, None, 11.0, "t"), (2, "x", 20.0, "t"), (3, "y", 30.0, "s")]


def test_overrides_by_name(spark):
    facts = spark.createDataFrame(
        [("TANTAN", None, None, "UNMATCHABLE"), ("FES", 1, 9, "MATCHED"), ("ZZZ", None, None, "UNMATCHABLE")],
        "agglomeration_raw string, id_province_prefecture long, id_region long, match_quality string",
    )
    prov = spark.createDataFrame([("PROVINCE DE TAN-TAN", 19, 2)], "nom_province_prefecture string, id_province_prefecture long, id_region long")
    ovr = spark.createDataFrame([("TANTAN", "province de tan-tan ", 326)], "agglomeration_raw string, correct_province_name string, row_count int")
    resolved = FA.resolve_overrides(ovr, prov)
    applied = FA.apply_overrides(facts, resolved)
    got = {r["agglomeration_raw"]: (r["id_province_prefecture"], r["id_region"], r["match_quality"]) for r in applied.collect()}
    assert got == {"TANTAN": (19, 2, "MATCHED_MANUAL"), "FES": (1, 9, "MATCHED"), "ZZZ": (None, None, "UNMATCHABLE")}
    rep = FA.override_report(applied, resolved).first()
    assert (rep["rows_expected"], rep["rows_fixed"], rep["delta"]) == (326, 1, -325)


def test_poly_ref(spark):
    df = spark.createDataFrame([("T1", 1, 2), ("T3", 1, 2), ("X", 1, 2)], "t string, v long, p long")
    assert [r[0] for r in df.select(FA.poly_ref("t", {"T1": "v", "T3": "p"})).collect()] == [1, 2, None]


def test_number_rows_hot_group(spark):
    from pyspark.sql import Window

    # group 0 holds half of the rows; NULL is a group of its own
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("g"),
        (F.lit(10_000) - F.col("id")).alias("o"),
    )
    got = D.number_rows(df, ["o"], ["g"], "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    def key(r):
        return (r["g"] is None, r["g"] or 0, r["o"], r["rn"])

    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_values_drive_the_substrings(spark):
    facts = spark.createDataFrame([(1, "FES"), (2, "DE FES"), (3, ""), (4, None)], "k int, city string")
    dim = spark.createDataFrame([("PREFECTURE DE FES", 1), ("PREFECTURE DE FES", 2), (None, 3)], "name string, id int")
    got = sorted((r["k"], r["id"], r["n_candidates"]) for r in M.contains_join(facts, "city", dim, "name", ["id"]).collect() if r["id"])
    assert got == [(1, 1, 2), (1, 2, 2), (2, 1, 2), (2, 2, 2)]
    counts = {r["k"]: r["n"] for r in M.contains_join(facts, "city", dim, "name", [], count_col="n", fan_out=False).collect()}
    assert counts == {1: 2, 2: 2, 3: 0, 4: 0}
    wanted = facts.select(F.col("city").alias("__v")).where("length(city) > 0")
    assert M.substring_table(dim, "name", values=wanted).count() == 2


def test_known_fact_keys_keep_their_ids(spark):
    from pricelake.plans.index_facts import NATURAL_KEY, with_fact_ids

    schema = "annee int, type_indice string, id_reference long, id_province_prefecture long, id_region long"
    first = with_fact_ids(spark.createDataFrame([(2020, "T1", 5, None, None), (2021, "T1", 5, 1, 1)], schema))
    rows = [(2019, "T1", 5, None, None), (2020, "T1", 5, None, None), (2021, "T1", 5, 1, 1), (2022, "T3", None, 1, 1)]
    again = {r["annee"]: r["id_indice"] for r in with_fact_ids(spark.createDataFrame(rows, schema), known=first).collect()}
    assert again == {2020: 1, 2021: 2, 2019: 3, 2022: 4} and len(NATURAL_KEY) == 5


def test_folded_words_meet_their_hits_without_a_shuffle(spark, tmpdir_path):
    from pricelake.plans import probes

    texts = [(1, "Été sur la Mer"), (1, "mer MER ete"), (2, None), (2, ""), (None, "la mer"), (None, "la fin"), (3, "ÿ ß la la"), (4, "!?")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    spark.createDataFrame([(1, "Le l'Été"), (2, "la mér"), (3, "La Mer"), (4, None), (5, "ss")], "p_partkey long, p_name string").write.parquet(f"{tmpdir_path}/part.parquet")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    out = probes.folded_contains_join(spark, tmpdir_path)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 7, 6, 10), (3, 3, 2, 3), (None, 3, 2, 4)]
    words = probes._distinct_words(docs)
    assert sorted(map(tuple, words.collect()), key=str) == sorted({(i, w) for i, t in texts for w in probes_words(t)}, key=str)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 3  # rows of ids that come once, of others, and the words' hits


def probes_words(text):
    import re

    return re.findall(r"[^\W\d_]+", text or "")
