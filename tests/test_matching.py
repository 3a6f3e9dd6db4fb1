"""Substring and LIKE joins against plain Python."""

import random
import re

import pytest

from pricelake.operators import likes as LK
from pricelake.operators import suffixes as SX

SCHEMA = "name string, id long, v string"


def like(name, pattern, escapes):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and escapes:
            if i + 1 == len(pattern):
                return False
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c) or re.escape(c)
        i += 1
    return re.fullmatch(out, name, re.DOTALL) is not None


def test_suffixes(spark, monkeypatch):
    monkeypatch.setattr(SX, "BLOCK", 4)
    monkeypatch.setattr(SX, "PIECE", 16)
    rng = random.Random(1)
    names = [None, "", "x", "É’s 中文", "a" * 90, "same", "same"] + ["".join(rng.choice("abé ") for _ in range(rng.randrange(1, 70))) for _ in range(120)]
    values = [None, "", "same", "中", "a" * 60, "zz", "a", "a"] + ["".join(rng.choice("abé ") for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    values += [n[i : i + 40] for n in names[7:60] for i in (0, 3)]
    dim = spark.createDataFrame([(n, i, "clash") for i, n in enumerate(names)], SCHEMA)
    got = SX.suffix_matches(spark.createDataFrame([(v,) for v in values], "v string"), "v", dim, "name", ["id"])
    want = [(v, i) for v in values if v for i, n in enumerate(names) if n and v.upper() in n.upper()]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    empty = spark.createDataFrame([], SCHEMA)
    assert SX.suffix_matches(dim, "v", empty, "name", ["id"]).collect() == []
    assert SX.suffix_matches(empty, "v", dim, "name", ["id"]).collect() == []


def test_suffix_rows_are_linear(spark):
    long = spark.createDataFrame([(1, "ab" * 5000)], "id long, name string")
    rows = SX.text_windows(long, "name", ["id"], SX.KEY)
    assert rows.count() == 10_000 and rows.selectExpr("max(length(key)) AS n").first()["n"] == SX.KEY
    assert {r["pos"] for r in SX.text_windows(long, "name", ["id"], 3, full=True).select("pos").collect()} == set(range(1, 9_999))


@pytest.mark.parametrize("escapes", [True, False])
def test_likes(spark, escapes):
    rng = random.Random(2)
    names = [None, "", "a", "a_b", "a%b", "a\\b", "line\nbreak", "Émile", "same", "same"] + ["".join(rng.choice("abc_%\\") for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    patterns = [None, "", "%", "_", "__", "_%_", "a\\%b", "a\\_b", "a\\\\b", "a\\", "\\", "\\a%", "é%", "%k", "LINE_BREAK", "%%a%%", "same"]
    patterns += ["".join(rng.choice("abc_%\\") for _ in range(rng.randrange(1, 7))) for _ in range(250)]
    dim = spark.createDataFrame([(n, i, "clash") for i, n in enumerate(names)], SCHEMA)
    got = LK.like_matches(spark.createDataFrame([(p,) for p in patterns], "p string"), "p", dim, "name", ["id"], escapes)
    want = [(p, i) for p in patterns if p is not None for i, n in enumerate(names) if n is not None and like(n.upper(), p.upper(), escapes)]
    by = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=by) == sorted(want, key=by)


def test_like_join_keeps_unmatched_facts(spark):
    dim = spark.createDataFrame([("AB_1", 1), ("ABX1", 2), ("100% PURE", 3), (None, 4)], "name string, id long")
    facts = spark.createDataFrame([(1, "b_1"), (2, "zz"), (3, None), (4, ""), (5, "0%p"), (6, "b_1")], "f long, city string")
    got = LK.like_join(facts, "city", dim, "name", ["id"]).select("f", "id", "n_candidates").collect()
    want = [(1, 1, 2), (1, 2, 2), (2, None, 0), (3, None, 0), (4, None, 0), (5, 3, 1), (6, 1, 2), (6, 2, 2)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_compat_fact_takes_cities_as_patterns(spark):
    from pricelake.plans.index_facts import build_index_fact

    staging = spark.createDataFrame([(2020, 1.0, 2.0, "T1", "f_s", "p", "v")], "annee int, indice double, prix_ttc double, file_type string, agglomeration string, produit string, variete string")
    prov = spark.createDataFrame([("PROVINCE DE FES", 7, 1)], "nom_province_prefecture string, id_province_prefecture long, id_region long")
    names = spark.createDataFrame([("V", 1), ("P", 2)], "name string, id long")
    of = lambda compat: build_index_fact(staging, prov, names, names, None, None, compat=compat).first()["id_province_prefecture"]
    assert (of(True), of(False)) == (7, None)
