"""Plan guards for every registered query: no cross products or nested-loop joins, and scans read only the
columns they need."""

import contextlib
import io

import pytest

from pricelake.plans import probes

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(probes.PROBES))
@pytest.mark.parametrize("threshold", ["10485760", "-1"])  # with and without automatic broadcasts
def test_no_cross_products(spark, name, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = _plan(probes.PROBES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(probes.PROBES["top1_dedupe"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    plan = _plan(probes.PROBES["upsert_merge"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan
