"""Closures and roll-ups, bitmaps over runs, ordered lists, communes, VARIANT row objects."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pricelake.operators import hierarchies as H
from pricelake.operators import weights as W
from pricelake.sources import files as S


def test_rollup_counts_every_node_once(spark):
    rng = random.Random(3)
    edges = [(f"n{i}", f"n{rng.randrange(i)}") for i in range(1, 40)] + [("n9", "n3"), ("n9", "n3"), (None, "n1"), ("n0", None)]
    values = [(rng.choice(["a", "b"]), f"n{rng.randrange(40)}", rng.randrange(9)) for _ in range(300)] + [("a", "alone", 5), ("a", None, 7)]
    up = defaultdict(set)
    for c, p in edges:
        if c and p:
            up[c].add(p)

    def ancestors(n):
        return {n}.union(*(ancestors(p) for p in up[n]))

    sums, nodes = Counter(), defaultdict(set)
    for g, n, v in values:
        for a in ancestors(n) if n else ():
            sums[g, a] += v
            nodes[g, a].add(n)
    got = H.rollup(spark.createDataFrame(values, "g string, node string, v long"), "node", "v", spark.createDataFrame(edges, "child string, parent string"), ["g"])
    assert {(r["g"], r["node"]): (r["value"], r["n_nodes"]) for r in got.collect()} == {k: (sums[k], len(nodes[k])) for k in nodes}
    found = H.closure(spark.createDataFrame(edges, "child string, parent string")).collect()
    assert {(r["node"], r["ancestor"]) for r in found} == {(f"n{i}", a) for i in range(40) for a in ancestors(f"n{i}")} and len(found) == len({r[:2] for r in found})


def test_cycles_and_depth_are_errors(spark):
    for edges in ([("a", "b"), ("b", "a")], [("a", "a")], [(f"n{i}", f"n{i + 1}") for i in range(12)]):
        with pytest.raises(ValueError, match="cycle"):
            H.closure(spark.createDataFrame(edges, "child string, parent string"), max_depth=8)
    assert H.closure(spark.createDataFrame([], "child string, parent string")).collect() == []


def test_bitmaps_over_runs(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), rng.randrange(70_000), rng.choice([None, *range(2015, 2025)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, ref long, y long")
    state = None
    for i in range(3):
        part = spark.createDataFrame(rows[i * 1500 : (i + 1) * 1500 + 200], df.schema)  # runs that overlap
        state = H.merge_bitmaps(state, H.distinct_bitmaps(part, ["g"], {"refs": "ref", "years": "y"}), ["g"])
    got = {r["g"]: (r["n_refs"], r["n_years"]) for r in H.bitmap_counts(state, ["g"], ["refs", "years"]).collect()}
    assert got == {g: (len({r[1] for r in rows if r[0] == g}), len({r[2] for r in rows if r[0] == g and r[2]})) for g in ("x", "y", None)}


def test_ordered_lists(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("h", None), (None, "é"), (None, "z")], "g string, v string")
    of = lambda **k: {r["g"]: (r["names"], r["n"]) for r in H.ordered_list(df, ["g"], "v", **k).collect()}
    assert of() == {"g": ("a, b, b", 3), "h": (None, 0), None: ("z, é", 2)}
    assert of(distinct=True, sep="'\\") == {"g": ("a'\\b", 2), "h": (None, 0), None: ("z'\\é", 2)}


def test_communes_of_the_weight_fact(spark):
    staged = spark.createDataFrame([("VILLE", "MENARA", "V", 2020, 0.5), ("VILLE", "Fes", "V", 2020, 0.25), ("VILLE", "nowhere", "V", 2020, 0.1), ("REGION", "SUD", "V", 2020, 0.9)],
                                   "niveau string, lieu string, variete string, annee int, poids double")
    var = spark.createDataFrame([("V", 1)], "name string, id long")
    prov = spark.createDataFrame([("PROVINCE DE FES", 10, 1), ("MARRAKECH", 20, 2)], "nom string, id long, id_parent long")
    reg = spark.createDataFrame([("NORD", 1), ("SUD", 2)], "nom string, id long")
    com = spark.createDataFrame([("Menara", 200, 20), ("Menara", 201, 20), ("FES", 100, 10)], "nom string, id long, id_parent long")
    f = W.weight_fact(staged, var, prov, reg, communes=com)
    got = {(r["id_commune"], r["id_province_prefecture"], r["id_region"], float(r["poids"])) for r in f.collect()}
    assert got == {(200, 20, 2, 0.5), (None, 10, 1, 0.25), (None, None, None, 0.1), (None, None, 2, 0.9)}


def test_variant_fields(spark):
    rows = ['{"a": 1, "b c.d": "x", "it\'s": "q"}', '{"a": "7"}', '{"a": "no"}', "broken", None, '{"a": null}', "[1]"]
    df = spark.createDataFrame([(r,) for r in rows], "row_json string").select(S.row_variant().alias("v"))
    got = [tuple(r) for r in df.select(*S.variant_fields("v", {"a": "bigint", "b c.d": "string", "it's": "string"})).collect()]
    assert got == [(1, "x", "q"), (7, None, None), *[(None, None, None)] * 5]
    assert "a" in spark.range(1).select(S.variant_schema(df.where(F.try_variant_get("v", "$.a", "string").isNotNull()), "v")).first()[0]
