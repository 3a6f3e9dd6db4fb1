"""Incremental pick-up of file drops (S3, incremental form) with Structured Streaming.

New files under a landing root are discovered by the file stream source (its checkpoint remembers what was
processed, so a restart after a failure neither loses nor repeats a drop). Each micro-batch runs the same batch
operators as the batch plan inside ``foreachBatch``; the sink is the idempotent per-run partition overwrite, so
replaying a batch after a crash rewrites the same partition instead of duplicating rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelake.plans.price_index import raw_rows
from pricelake.session import cut_lineage
from pricelake.sources import files as S
from pricelake.sources import sinks as SK

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_files(spark: SparkSession, root: str, glob: str = "*.csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``binaryFile`` scan of ``root`` (recursive), with ``rel_path`` like :func:`S.scan_tree`."""
    r = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
    )
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(root)
    root_norm = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "", root).rstrip("/")
    bare = F.regexp_replace(F.col("path"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "")
    rel = F.when(bare.startswith(root_norm + "/"), F.substring(bare, len(root_norm) + 2, 1 << 30)).otherwise(bare)
    return df.withColumn("archive", F.lit("")).withColumn("rel_path", rel)


def with_members(files: DataFrame) -> DataFrame:
    """archive, rel_path, content: the files that aren't ZIP drops, and the CSV members of those that are."""
    is_zip = F.lower("rel_path").endswith(".zip")
    columns = ["archive", "rel_path", "content"]
    members = S.explode_archives(files.where(is_zip)).where(F.lower("rel_path").endswith(".csv"))
    return files.where(~is_zip).select(*columns).unionByName(members.select(*columns))


def write_raw(files: DataFrame, out_path: str, run_id: str) -> DataFrame:
    """Parses files (archive, rel_path, content) and writes run ``run_id`` with the schema of the batch plan: ``raw_rows``
    below ``out_path``, and ``raw_files`` and ``skipped_rows`` beside them. Returns the raw rows written."""
    parsed = cut_lineage(S.to_rows(S.sniff(files)))
    out = out_path.rstrip("/")
    raw = raw_rows(parsed, run_id)
    SK.append_run(raw.drop("run_id"), f"{out}/raw_rows", run_id, by=["dataset"])
    SK.append_run(S.manifest(parsed, run_id).drop("run_id"), f"{out}/raw_files", run_id)
    SK.append_run(S.skipped_rows(parsed), f"{out}/skipped_rows", run_id)
    return raw


def rows_sink(out_path: str, run_prefix: str = "stream") -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: parse the batch's files (and the members of its ZIP drops) and write them as run
    ``<prefix>-<batch>`` (:func:`write_raw`). The batch id is stable across replays, so a replay overwrites its own run."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_raw(with_members(batch), out_path, f"{run_prefix}-{batch_id:08d}")

    return handle


def checkpoint_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that belongs to a checkpoint folder for as long as it exists: kept in a file beside the offsets. A new
    checkpoint, whose batches count from 0 again, gets another one and so never overwrites older runs."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    path = jvm.org.apache.hadoop.fs.Path(checkpoint, "pricelake-run-name")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(path):
        stream = fs.create(path)
        stream.writeUTF(uuid.uuid4().hex[:12])
        stream.close()
    stream = fs.open(path)
    name = stream.readUTF()
    stream.close()
    return name


def start_drops(
    spark: SparkSession,
    root: str,
    out_path: str,
    checkpoint: str,
    glob: str = "*.{csv,zip}",
    available_now: bool = True,
    handler: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start the pick-up. ``available_now=True`` processes everything new and stops (scheduled runs);
    otherwise it keeps polling. ``checkpoint`` must be on shared storage."""
    src = stream_files(spark, root, glob)
    sink = handler or rows_sink(out_path, f"stream-{checkpoint_name(spark, checkpoint)}")
    w = src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
