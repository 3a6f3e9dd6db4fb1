"""Every registered query against its DuckDB oracle on the smallest driver tables (rows, columns, values)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import canon  # noqa: E402
from pricelake.plans import probes  # noqa: E402
from pricelake.plans.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(probes.PROBES)  # queries of optional subpackages have their own tests


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(probes.ORACLE) == set(probes.PROBES)
    assert probes.PROBES.items() <= E.queries().items() and probes.ORACLE.items() <= E.oracle_sql().items()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "id_indice" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_probe_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = canon([tuple(r[c] for c in cols) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = canon([tuple(r[i] for i in idx) for r in res.fetchall()])
    assert got == want
