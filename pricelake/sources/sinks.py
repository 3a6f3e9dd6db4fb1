"""Sinks (S10, S11, U5): idempotent run appends, table replacement by versions."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_run(
    df: DataFrame, path: str, run_id: str, partition_col: str = "run_id", fmt: str = "parquet", by: Sequence[str] = ()
) -> None:
    """Write one run's rows under ``run_id=<id>`` (and below it by ``by``). A retried run replaces its own folder,
    also where the retry has fewer rows or none (Q9 fix); other runs are untouched. The rows are written aside first (below
    a folder that readers pass over) and take the place of the old ones by renames: a write that fails leaves these as
    they were, and a swap that was cut short between its renames is made good by the next call for the run."""
    fs, root, jvm = file_system(df.sparkSession, path)
    at = jvm.org.apache.hadoop.fs.Path
    own = at(root, f"{partition_col}={run_id}")
    aside, old = at(root, f"_new-{partition_col}={run_id}"), at(root, f"_old-{partition_col}={run_id}")
    if fs.exists(old) and not fs.exists(own):
        fs.rename(old, own)
    for rest in (aside, old):
        fs.delete(rest, True)
    df.write.partitionBy(*by).format(fmt).save(aside.toString())
    if fs.exists(own):
        fs.rename(own, old)
    part = "part-" if not by else f"{by[0]}="
    if any(st.getPath().getName().startswith(part) for st in fs.listStatus(aside)) and not _is_empty(df, aside.toString(), fmt):
        fs.rename(aside, own)
    for rest in (aside, old):
        fs.delete(rest, True)


def _is_empty(df: DataFrame, path: str, fmt: str) -> bool:
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path).isEmpty()


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Truncate-and-load as an overwrite. Never point it at a path the same job reads: use
    :func:`write_version` for tables that are read and rewritten (facts, dimensions)."""
    df.write.mode("overwrite").format(fmt).save(path)


def file_system(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(conf), p, jvm


def versions(spark: SparkSession, root: str) -> list[str]:
    """Committed versions of a table (folders ``v=<n>`` holding a ``_SUCCESS`` marker), oldest first."""
    fs, p, jvm = file_system(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(name)
    return sorted(out, key=lambda n: int(n[2:]))


def write_version(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Write ``df`` as a new version folder of the table at ``root`` and return its path. Readers of the
    previous version are never disturbed; the new version becomes visible once its job commits."""
    spark = df.sparkSession
    existing = versions(spark, root)
    n = max([int(v[2:]) for v in existing], default=0)
    n = max(n + 1, int(time.time() * 1000))
    path = f"{root.rstrip('/')}/v={n}"
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def read_latest(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    """Latest committed version of a versioned table, or ``None``."""
    vs = versions(spark, root)
    if not vs:
        return None
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{vs[-1]}")


def write_report(df: DataFrame, path: str, run_id: str) -> str:
    """Q-8: a run report (a handful of rows, e.g. the counts snapshot) as JSON lines under ``run_id=<id>``;
    re-running the run replaces its report."""
    out = f"{path.rstrip('/')}/run_id={run_id}"
    df.coalesce(1).write.mode("overwrite").json(out)
    return out
