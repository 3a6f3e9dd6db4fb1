"""Access to the driver tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# primary keys used to spread a table that has fewer splits than task slots (see session.spread)
KEYS = {
    "lineitem": ("l_orderkey",), "orders": ("o_orderkey",), "customer": ("c_custkey",), "part": ("p_partkey",),
    "supplier": ("s_suppkey",), "events": ("event_id",), "documents": ("doc_id",), "pages": ("page_id",),
    "conversations": ("conv_id", "turn"), "benchmark": ("item_id",), "labels": ("doc_id",), "embeddings": ("vec_id",),
}


_LOADED: "weakref.WeakKeyDictionary[SparkSession, dict[tuple[str, bool], DataFrame]]" = weakref.WeakKeyDictionary()


def load(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """The table as a lazy DataFrame (nothing is cached: only the resolved plan is reused per session, so the footer
    read and the split check happen once). ``spread=True`` is for CPU-heavy row work (whole-text processing, long
    join chains): see :func:`pricelake.session.spread`."""
    from pricelake.session import spread as _spread

    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _LOADED.setdefault(spark, {})
    key = (path, spread)
    if key not in per_session:
        df = spark.read.parquet(path)
        per_session[key] = _spread(df, *KEYS.get(name, ())) if spread else df
    return per_session[key]


class Tables:
    """Lazy accessor: ``t.lineitem`` reads ``lineitem.parquet`` (column pruning and filters reach the scan)."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.spread = spread

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name, self.spread)
        raise AttributeError(name)

    def all(self) -> dict[str, DataFrame]:
        return {n: load(self.spark, self.sf_dir, n, self.spread) for n in TABLES}
