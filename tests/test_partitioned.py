"""Stored tables rewritten by partition, run folders that outlive a failed write, and the stream from drops to the fact."""

import glob
import os
import shutil
import zipfile

import pytest
from fixtures import HEADER_T1, build_landing, price_rows
from pyspark.sql import functions as F

from pricelake.operators import facts as FA
from pricelake.plans import price_index as PI
from pricelake.sources import partitioned as PT
from pricelake.sources import sinks as SK
from pricelake.streaming import facts as SF


def files_of(root, value):
    return {f for f in glob.glob(f"{root}/data/*/__part={value}/*.parquet")}


def test_untouched_partitions_keep_their_files(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    schema = "y int, k string, v long, id long, note string"
    PT.write_partitions(spark.createDataFrame([(2000, "a", 1, 1, "o"), (2001, "a", 1, 2, "o"), (None, "a", 1, 3, "o"), (2002, None, 1, 4, "o")], schema), root, "y", "id")
    before = {v: files_of(root, v) for v in ("2000", "2001", "2002", PT._NULL)}
    source = spark.createDataFrame([(2001, "a", 9, None, "n"), (2002, None, 9, None, "n"), (2003, "b", 9, None, "n")], schema)
    touched = PT.upsert_partitions(source, root, "y", lambda t, s: FA.upsert(t, s, ["y", "k"], ["v"]), "id")
    assert sorted(touched) == ["2001", "2002", "2003"]
    got = sorted(map(tuple, PT.read_partitions(spark, root).collect()), key=str)
    assert got == sorted([(2000, "a", 1, 1, "o"), (2001, "a", 9, 2, "o"), (None, "a", 1, 3, "o"), (2002, None, 9, 4, "o"), (2003, "b", 9, None, "n")], key=str)
    paths = {r["value"]: r["path"] for r in PT.manifest(spark, root).collect()}
    for value, name in (("2000", "2000"), (None, PT._NULL)):
        assert {os.path.join(root, paths[value], os.path.basename(f)) for f in before[name]} == before[name]  # the same files
    for value in ("2001", "2002"):
        assert not {f for f in before[value] if paths[value] in f}
    assert PT.max_id(spark, root) == 4
    assert {r["y"] for r in PT.read_partitions(spark, root, ["2000", None]).collect()} == {2000, None}
    # nothing to do makes no version; a merge that moves rows or loses a column is refused and changes nothing
    n = len(SK.versions(spark, f"{root}/versions"))
    assert PT.upsert_partitions(source.limit(0), root, "y", lambda t, s: t, "id") == []
    with pytest.raises(ValueError, match="other partitions"):
        PT.upsert_partitions(source, root, "y", lambda t, s: s.withColumn("y", F.lit(1)))
    with pytest.raises(ValueError, match="columns"):
        PT.upsert_partitions(source, root, "y", lambda t, s: s.drop("v"))
    assert len(SK.versions(spark, f"{root}/versions")) == n
    assert sorted(map(tuple, PT.read_partitions(spark, root).collect()), key=str) == got
    assert PT.expire(spark, root, keep=1) == 1  # the refused write; the first folder still holds 2000 and null
    assert sorted(map(tuple, PT.read_partitions(spark, root).collect()), key=str) == got


def test_empty_and_odd_partition_values(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    assert PT.read_partitions(spark, root) is None and PT.max_id(spark, root) == 0
    empty = spark.createDataFrame([], "p string, id long")
    PT.write_partitions(empty, root, "p", "id")
    assert PT.read_partitions(spark, root).collect() == []
    rows = [("a/b=c%", 1), ("01", 2), ("", 3)]
    PT.upsert_partitions(spark.createDataFrame(rows[:2], empty.schema), root, "p", lambda t, s: t.unionByName(s), "id")
    PT.upsert_partitions(spark.createDataFrame([("a/b=c%", 5)], empty.schema), root, "p", lambda t, s: t.unionByName(s), "id")
    assert sorted(map(tuple, PT.read_partitions(spark, root).collect())) == [("01", 2), ("a/b=c%", 1), ("a/b=c%", 5)]


def test_a_failed_run_leaves_the_old_one(spark, tmpdir_path):
    out = f"{tmpdir_path}/runs"
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a long, dataset string")
    SK.append_run(df, out, "r1", by=["dataset"])
    fails = df.withColumn("a", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        SK.append_run(fails, out, "r1", by=["dataset"])
    assert sorted(r["a"] for r in spark.read.parquet(out).where("run_id = 'r1'").collect()) == [1, 2]
    os.rename(f"{out}/run_id=r1", f"{out}/_old-run_id=r1")  # as if cut short between the renames
    with pytest.raises(Exception, match="no"):
        SK.append_run(fails, out, "r1", by=["dataset"])
    assert spark.read.parquet(out).count() == 2
    SK.append_run(df.limit(1), out, "r1", by=["dataset"])
    assert spark.read.parquet(out).count() == 1 and not glob.glob(f"{out}/_*-*")


NAMED = ["annee", "type_indice", "name", "id_province_prefecture", "id_region", "agglomeration_raw", "valeur_indice", "prix_moyen", "match_quality"]


def named(fact, trade):
    """The fact with names for the trade ids, which depend on the order of arrival."""
    names = trade["variete"].select("id", "name", F.lit("T1").alias("t")).unionByName(trade["produit"].select("id", "name", F.lit("T3").alias("t")))
    j = fact.join(names, (fact["id_reference"] == names["id"]) & (fact["type_indice"] == names["t"]), "left")
    return sorted(map(tuple, j.select(*NAMED).collect()), key=str)


def test_stream_reaches_the_fact(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    batch = PI.run(spark, p["landing"], f"{tmpdir_path}/batch", "r", p["refs"], drops="all")
    want = named(batch["fact"], {k: batch[f"dim_{k}"] for k in ("variete", "produit")})
    inbox, out, ck = f"{tmpdir_path}/inbox", f"{tmpdir_path}/stream", f"{tmpdir_path}/ck"
    SF.load_geography(spark, p["refs"], out)

    def deliver(*names, to=None):
        for name in names:
            target = f"{inbox}/{to or name}"
            os.makedirs(os.path.dirname(target), exist_ok=True)
            shutil.copy(f"{p['landing']}/{name}", target)

    def run():
        SF.start_facts(spark, inbox, out, ck).awaitTermination(300)
        fact = SF.read_fact(spark, out)
        return named(fact, SF._dims(spark, out, SF.TRADE)), {tuple(r) for r in fact.select("id_indice", "annee", "agglomeration_raw", "prix_moyen").collect()}

    deliver("FES/fes_T1.csv", "NATIONAL/maroc_T1.csv", "MS/ms_T3.csv", "EMPTY/empty_T1.csv", "maroc_T3.csv")
    first, ids = run()
    assert first and set(first) < set(want)
    # the same drop under another name, and again within an archive: nothing changes
    deliver("FES/fes_T1.csv", to="FES/fes_again_T1.csv")
    with zipfile.ZipFile(f"{inbox}/again.zip", "w") as z:
        z.write(f"{p['landing']}/FES/fes_T1.csv", "FES/copy_T1.csv")
    assert run() == (first, ids)
    assert len(SK.versions(spark, f"{out}/fact_indice/versions")) == 1
    # the rest, in a third micro-batch, with a replay of it afterwards
    rest = ["KENITRA/kenitra_T1.csv", "TANTAN/tantan_T1.csv", "MARRAKECH/marrakech_T1.csv", "CASA/casa_T1.csv", "x/region-marrakech-safi_CSV/ALHAOUZ/alhaouz_T1.csv", "drops/drop_2025.zip"]
    deliver(*rest)
    last, more = run()
    assert last == want and ids <= more
    raw = spark.read.parquet(f"{out}/raw_rows").count()
    handle = SF.facts_sink(out, "stream-" + SF.drops.checkpoint_name(spark, ck))
    files = SF.drops.with_members(PI.S.scan_tree(spark, inbox, "*.csv").where(F.col("rel_path").contains("KENITRA") | F.col("rel_path").contains("TANTAN")))
    handle(files, 99)
    handle(files, 99)  # the same batch again
    fact = SF.read_fact(spark, out)
    assert named(fact, SF._dims(spark, out, SF.TRADE)) == want
    assert {tuple(r) for r in fact.select("id_indice", "annee", "agglomeration_raw", "prix_moyen").collect()} == more
    assert spark.read.parquet(f"{out}/raw_rows").count() > raw


def test_better_rows_win_whenever_they_come(spark, tmpdir_path):
    p = build_landing(tmpdir_path)
    out = f"{tmpdir_path}/out"
    SF.load_geography(spark, p["refs"], out)
    handle = SF.facts_sink(out)
    for i, base in enumerate((300.0, 100.0)):  # the better prices come first
        text = "\n".join([HEADER_T1, *price_rows(base=base)]) + "\n"
        handle(spark.createDataFrame([("", f"FES/{i}_T1.csv", text.encode())], "archive string, rel_path string, content binary"), i)
    fact = SF.read_fact(spark, out)
    assert fact.count() == 4 and fact.where("prix_moyen < 300").isEmpty()
    assert {r["id_indice"] for r in fact.collect()} == {1, 2, 3, 4}
