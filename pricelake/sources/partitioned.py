"""Versioned tables in partitions, rewritten only where a change falls.

A table has data folders (one per write, in them one folder per partition value) and versions. A version is a manifest: a
row per partition value with the folder that holds it and, if asked for, the greatest value of an id column. An upsert
looks up the partitions that its source falls in, merges these alone into a new data folder, and writes a manifest that
names the new folders and carries all others over, so the files of untouched partitions stay the same files. A version is
visible once its manifest is committed; a failed write leaves the last one as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.session import cut_lineage
from pricelake.sources import sinks as SK

_MANIFEST = "value string, path string, max_id long, schema string"
_PART = "__part"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """(value, path, max_id, schema) of the latest version, a row per partition value (as text; null for null)."""
    found = SK.versions(spark, f"{root.rstrip('/')}/versions")
    return spark.read.schema(_MANIFEST).json(f"{root.rstrip('/')}/versions/{found[-1]}") if found else None


def _entries(spark: SparkSession, root: str) -> list:
    found = manifest(spark, root)
    return found.collect() if found is not None else []  # a row per partition value


def _load(spark: SparkSession, root: str, entries: list, values: Sequence[str | None] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entries[0]["schema"]))
    paths = [f"{root.rstrip('/')}/{e['path']}" for e in entries if e["path"] and (values is None or e["value"] in values)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_partitions(spark: SparkSession, root: str, values: Sequence[str | None] | None = None) -> DataFrame | None:
    """The table's latest version, or of it the partitions of these values (as text) alone; ``None`` without a version."""
    entries = _entries(spark, root)
    return _load(spark, root, entries, values) if entries else None


def max_id(spark: SparkSession, root: str) -> int:
    """The greatest id of the latest version, from its manifest alone (0 without any)."""
    return max((e["max_id"] or 0 for e in _entries(spark, root)), default=0)


def _write(spark: SparkSession, root: str, df: DataFrame, part_col: str, id_col: str | None) -> list[tuple]:
    """Writes ``df`` as a new data folder; (value, path, max_id) of its partitions. Adaptive execution evens out the
    partitions that tasks write, so a value with a third of all rows is written by many tasks."""
    data = f"data/{uuid.uuid4().hex}"
    full = f"{root.rstrip('/')}/{data}"
    parted = df.withColumn(_PART, F.col(part_col).cast("string"))
    parted.hint("rebalance", _PART).write.partitionBy(_PART).parquet(full)
    fs, folder, jvm = SK.file_system(spark, full)
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    folders = [st.getPath().getName() for st in fs.listStatus(folder) if st.isDirectory() and st.getPath().getName().startswith(_PART + "=")]
    values = {name: unescape(name.split("=", 1)[1]) for name in folders}
    ids = {}
    if id_col and folders:
        written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_PART, T.StringType())])).parquet(full)
        ids = {r[0]: r[1] for r in written.groupBy(_PART).agg(F.max(id_col).cast("long")).collect()}
    none = lambda v: None if v == _NULL else v
    return [(none(v), f"{data}/{name}", ids.get(none(v))) for name, v in values.items()]


def _commit(spark: SparkSession, root: str, entries: list[tuple], schema: T.StructType) -> str:
    entries = entries or [(None, None, None)]  # an empty table still has its schema
    rows = spark.createDataFrame([(*e, schema.json()) for e in sorted(entries, key=str)], _MANIFEST)
    return SK.write_version(rows.coalesce(1), f"{root.rstrip('/')}/versions", "json")


def write_partitions(df: DataFrame, root: str, part_col: str, id_col: str | None = None) -> str:
    """``df`` as the table's next version, all partitions new. With ``id_col`` the manifest holds the greatest ids."""
    return _commit(df.sparkSession, root, _write(df.sparkSession, root, df, part_col, id_col), df.schema)


def upsert_partitions(
    source: DataFrame, root: str, part_col: str, merge: Callable[[DataFrame, DataFrame], DataFrame], id_col: str | None = None
) -> list[str | None]:
    """The table's next version: the partitions that ``source`` falls in are replaced by ``merge(target, source)``, with
    ``target`` their rows so far; the others are carried over. Returns the values rewritten; a source without rows makes
    no version. ``merge`` must keep the table's columns, and rows in their partitions. One writer at a time."""
    spark = source.sparkSession
    source = cut_lineage(source)
    entries = _entries(spark, root)
    touched = [r[0] for r in source.select(F.col(part_col).cast("string")).distinct().collect()]  # at most a row per partition
    if not touched:
        return []
    target = _load(spark, root, entries, touched) if entries else None
    merged = merge(target, source) if target is not None else merge(source.limit(0), source)
    if target is not None:
        if sorted(merged.columns) != sorted(target.columns):
            raise ValueError(f"the merged columns {merged.columns} aren't the table's {target.columns}")
        merged = merged.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    fresh = _write(spark, root, merged, part_col, id_col)
    strange = {e[0] for e in fresh} - set(touched)
    if strange:
        raise ValueError(f"rows were merged into other partitions: {sorted(map(str, strange))}")
    kept = [(e["value"], e["path"], e["max_id"]) for e in entries if e["path"] and e["value"] not in touched]
    _commit(spark, root, kept + fresh, merged.schema if target is None else target.schema)
    return touched


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes all versions but the last ``keep`` and the data folders that none of these names; returns how many folders
    went. Run it while nobody reads the older versions or writes the table."""
    base = f"{root.rstrip('/')}/versions"
    names = SK.versions(spark, base)
    fs, _, jvm = SK.file_system(spark, root)
    used = set()
    for v in names[-keep:]:
        used |= {r["path"].rsplit("/", 1)[0] for r in spark.read.schema(_MANIFEST).json(f"{base}/{v}").collect() if r["path"]}
    for v in names[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{v}"), True)
    data = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/data")
    gone = [st.getPath() for st in fs.listStatus(data) if f"data/{st.getPath().getName()}" not in used] if fs.exists(data) else []
    for path in gone:
        fs.delete(path, True)
    return len(gone)
