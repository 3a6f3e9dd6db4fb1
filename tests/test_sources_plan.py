import json
import os
import zipfile

import pytest

from fixtures import build_landing
from pricelake.plans import price_index as PI
from pricelake.sources import files as S
from pricelake.sources import sinks as SK
from pricelake.streaming import drops as ST


def test_parse_helpers():
    header, *rows = S.parse_csv("a;a;;b\n1;2;3;4\n5\n6;7;8;9;10\n\n".encode(), ";", "utf-8")
    assert header == ["a", "a.1", "Unnamed: 2", "b"]
    assert rows == [["1", "2", "3", "4"], ["5", "", "", ""], None]
    assert S._compat_parse("x,y\n1,2\n".encode()) == (";", "utf-8")  # Q1 reproduced: ';' parses as one column
    assert S._compat_parse("é;x\n".encode("cp1252"))[1] == "cp1252"


def test_scan_sniff_rows_manifest(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    files = S.scan_tree(spark, p["landing"], "*.csv")
    sn = {r["rel_path"]: r for r in S.sniff(files).select("rel_path", "charset", "sep", "has_bom").collect()}
    assert sn["KENITRA/kenitra_T1.csv"]["sep"] == ","
    assert sn["NATIONAL/maroc_T1.csv"]["sep"] == ";" and sn["NATIONAL/maroc_T1.csv"]["has_bom"]
    assert sn["x/region-marrakech-safi_CSV/ALHAOUZ/alhaouz_T1.csv"]["charset"] == "cp1252"
    rows = S.to_rows(S.sniff(files))
    ok = rows.where("status = 'ok'")
    first = json.loads(ok.where("rel_path = 'x/region-marrakech-safi_CSV/ALHAOUZ/alhaouz_T1.csv' and row_index = 1").first()["row_json"])
    assert first["Année"] == "2019" and first["Variété"] == "Béton B25"
    assert ok.where("rel_path = 'CASA/casa_T1.csv'").count() == 0  # header only
    assert rows.where("status = 'rejected'").count() == 1  # the long TANTAN row
    man = {r["rel_path"]: r for r in S.manifest(rows, "Manual:1").collect()}
    assert man["NATIONAL/maroc_T1.csv"]["row_count"] == 4 and len(man["NATIONAL/maroc_T1.csv"]["md5_hash"]) == 32
    assert "CASA/casa_T1.csv" not in man and "EMPTY/empty_T1.csv" not in man  # no data row, no manifest row
    assert {r["run_id"] for r in man.values()} == {"manual_1"}


def test_archives_and_latest_drop(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    zips = S.scan_tree(spark, p["landing"], "*.zip")
    members = S.explode_archives(zips).collect()
    assert [m["rel_path"] for m in members] == ["SETTAT/settat_T1.csv"]
    latest = S.latest_drop(spark, [os.path.join(p["landing"], "drops"), os.path.join(tmpdir_path, "missing")]).first()["path"]
    assert latest.endswith("drop_2025.zip")


def test_read_rows_ci_ai(spark):
    raw = spark.createDataFrame(
        [("r1", "referentiels/Région.csv", "referentiels", 1, '{"Code Region":"1","Nom Région":"FÈS"}'),
         ("r1", "referentiels/other.csv", "referentiels", 1, '{"a":"1"}')],
        "run_id string, rel_path string, dataset string, row_index int, row_json string",
    )
    got = S.read_rows(raw, "r1", "referentiels", ["referentiels/region.csv"]).collect()
    assert len(got) == 1 and dict(got[0]["row"]) == {"code_region": "1", "nom_region": "FÈS"}
    wide = S.widen(S.read_rows(raw, "r1", "referentiels", ["referentiels/region.csv"]))
    assert wide.columns[-2:] == ["code_region", "nom_region"]


def test_sinks(spark, tmpdir_path):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    out = os.path.join(tmpdir_path, "t")
    SK.append_run(df, out, "r1")
    SK.append_run(df, out, "r1")  # retry: same partition replaced, not appended
    SK.append_run(df.limit(1), out, "r2")
    t = spark.read.parquet(out)
    assert t.where("run_id = 'r1'").count() == 2 and t.count() == 3
    root = os.path.join(tmpdir_path, "v")
    SK.write_version(df, root)
    SK.write_version(df.limit(1), root)
    assert SK.read_latest(spark, root).count() == 1
    assert len(SK.versions(spark, root)) == 2
    SK.append_run(df.limit(0), out, "r1")  # a retry without rows leaves nothing behind
    assert spark.read.parquet(out).count() == 1


def test_end_to_end_and_rerun(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    out = os.path.join(tmpdir_path, "out")
    res = PI.run(spark, p["landing"], out, "run-1", p["refs"], weights_root=p["weights"])
    fact = res["fact"]
    w = {(r["annee"], r["id_reference"], r["id_province_prefecture"]) for r in res["fact_weights"].collect()}
    assert len(w) == 5 and any(k[2] is not None for k in w)
    dropped = {(r["niveau"], r["reason"]): r["n_rows"] for r in res["dropped_by_level"].collect()}
    assert dropped[("NATIONAL", "no city")] == 5 and dropped[("REGION", "no city")] == 2
    unresolved = {(r["type_indice"], r["name"]) for r in res["unresolved_references"].collect()}
    assert ("T1", None) in unresolved  # the MARRAKECH row without a variety
    snap = spark.read.json(os.path.join(out, "reports", "dq", "run_id=run-1")).first()
    assert snap["run_id"] == "run-1" and snap["counts"]["index"] == fact.count()
    n = fact.count()
    assert n > 10
    assert res["key_duplicates"].count() == 0
    q = {r["match_quality"] for r in fact.collect()}
    assert "MATCHED_MANUAL" in q and "MATCHED" in q
    prov = {r["name"]: r["id_parent"] for r in res["dim_province"].collect()}
    reg = {r["name"]: r["id"] for r in res["dim_region"].collect()}
    assert prov["1511"] == reg["1"] and prov["10261"] == reg["10"] and prov["12066"] == reg["12"]
    dims_before = {k: sorted(res[k].collect()) for k in ("dim_region", "dim_province", "dim_variete", "dim_produit")}
    raw_before = res["counts"].where("table_name = 'raw_rows'").first()["row_count"]
    # the same run again (frames of the first run are not used after this point: their files are replaced)
    res2 = PI.run(spark, p["landing"], out, "run-1", p["refs"])
    assert spark.read.parquet(os.path.join(out, "raw_rows")).where("run_id = 'run-1'").count() == raw_before
    for k, v in dims_before.items():
        assert sorted(res2[k].collect()) == v, k
    assert res2["fact"].count() == n


def test_stream_pickup(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    out = os.path.join(tmpdir_path, "stream_rows")
    ck = os.path.join(tmpdir_path, "ck")
    q = ST.start_drops(spark, os.path.join(p["landing"], "NATIONAL"), out, ck)
    q.awaitTermination(120)
    assert spark.read.parquet(out + "/raw_rows").where("dataset = 'prix_indices'").count() == 4
    assert spark.read.parquet(out + "/raw_files").count() == 1
    # a new file arrives: only it is processed by the next run
    with open(os.path.join(p["landing"], "NATIONAL", "national_T3.csv"), "w", encoding="utf-8") as f:
        f.write("Année;Produit;Indice\n2021;Béton;101,2\n")
    q = ST.start_drops(spark, os.path.join(p["landing"], "NATIONAL"), out, ck)
    q.awaitTermination(120)
    t = spark.read.parquet(out + "/raw_rows")
    assert t.count() == 5 and t.select("run_id").distinct().count() == 2
    # a new checkpoint starts over under other run ids: nothing is overwritten
    q = ST.start_drops(spark, os.path.join(p["landing"], "NATIONAL"), out, ck + "2")
    q.awaitTermination(120)
    t = spark.read.parquet(out + "/raw_rows")
    assert t.count() == 10 and t.select("run_id").distinct().count() == 3
    staged, _ = PI.stage_prices(t)  # the batch plan reads the stream's rows
    assert staged.count() == 10


def _parsed(spark, root):
    got = {}
    for r in S.to_rows(S.sniff(S.scan_tree(spark, root))).collect():
        got.setdefault(r["rel_path"], []).append(r)
    return got


def test_one_parser_for_awkward_files(spark, tmpdir_path):
    def put(name, data):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(data)

    put("quotes.csv", b'a;b\n"he said ""hi""";"x;y"\n"two\nlines";1\n1;2;3;4\n2023;z\n')
    put("wide.csv", ";".join(f"c{i}" for i in range(300)).encode() + b"\n" + ";".join(str(i) for i in range(300)).encode() + b"\n")
    put("late.csv", b"a;b\n" + b"1;2\n" * 400_000 + b"\x81;\xe9\n")
    put("cp.csv", "a;b\n1;2\n".encode() + "Béton;3\n".encode("cp1252"))
    put("header.csv", ("x" * 70_000 + ",b\n1,2\n").encode())
    put("cell.csv", ("a,b\n" + "y" * 200_000 + ",2\n").encode())
    got = _parsed(spark, tmpdir_path)
    rows = [json.loads(r["row_json"]) for r in got["quotes.csv"] if r["status"] == "ok"]
    assert rows == [{"a": 'he said "hi"', "b": "x;y"}, {"a": "two\nlines", "b": "1"}, {"a": "2023", "b": "z"}]
    assert [r["row_index"] for r in got["quotes.csv"]] == [1, 2, 0, 3, 3]
    assert [r["status"] for r in got["quotes.csv"]] == ["ok", "ok", "rejected", "ok", "file"]
    assert len(json.loads(got["wide.csv"][0]["row_json"])) == 300
    late = [r for r in got["late.csv"] if r["status"] == "ok"]
    assert len(late) == 400_001 and json.loads(late[-1]["row_json"]) == {"a": "\x81", "b": "é"}
    assert json.loads(got["cp.csv"][1]["row_json"])["a"] == "Béton"
    assert json.loads(got["header.csv"][0]["row_json"])["b"] == "2" and json.loads(got["cell.csv"][0]["row_json"])["b"] == "2"


def test_members_keep_their_archive_and_the_newest_drop_counts(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    for name, n in (("drop_2026_a.zip", 1), ("drop_2026_b.zip", 2)):
        with zipfile.ZipFile(os.path.join(p["landing"], "drops", name), "w") as z:
            z.writestr("NATIONAL/maroc_T1.csv", "Année;Prix\n" + "2020;1\n" * n)
    manifest, raw, _ = PI.land(spark, p["landing"], "r", drops="all")
    same = {(r["archive"], r["row_count"]) for r in manifest.where("rel_path = 'NATIONAL/maroc_T1.csv'").collect()}
    assert same == {("", 4), ("drops/drop_2026_a.zip", 1), ("drops/drop_2026_b.zip", 2)}
    assert raw.groupBy("archive", "rel_path", "row_index").count().where("count > 1").count() == 0
    manifest, _, _ = PI.land(spark, p["landing"], "r")
    assert {r["archive"] for r in manifest.select("archive").distinct().collect()} == {"", "drops/drop_2026_b.zip"}


def test_failure_rules(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    bare = os.path.join(tmpdir_path, "bare")
    os.makedirs(bare)
    with open(os.path.join(bare, "a_T1.csv"), "w", encoding="utf-8") as f:
        f.write("Année;Prix\nx;1\n")
    with pytest.raises(ValueError, match="no valid price row"):
        PI.run(spark, bare, os.path.join(tmpdir_path, "o1"), "r", p["refs"])
    skipped = spark.read.parquet(os.path.join(tmpdir_path, "o1", "skipped_rows")).collect()
    assert [(r["rel_path"], r["reason"], r["n_rows"]) for r in skipped] == [("a_T1.csv", "no valid year", 1)]
    with pytest.raises(ValueError, match="no reference"):
        PI.run(spark, p["landing"], os.path.join(tmpdir_path, "o2"), "r")
