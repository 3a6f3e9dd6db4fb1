"""From file drops to the fact, incrementally (S3, U1, U2 as a stream).

New files (and the members of ZIP drops) are known by what they say: the place and file type that their path gives, and
the digest of their bytes. Structured Streaming's state store keeps these keys, so a drop that comes again, under whatever
name, does nothing. Each micro-batch lands its raw rows, stages them, grows the trade dimensions and upserts the stored
fact, of which only the batch's years are rewritten. The fact keeps the row that the dedupe would have chosen among all
rows so far, so it doesn't depend on how files fall into batches, and a batch that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelake import constants as K
from pricelake.operators import paths as P
from pricelake.plans import price_index as PI
from pricelake.plans.index_facts import build_index_fact, upsert_fact
from pricelake.session import cut_lineage
from pricelake.sources import files as S
from pricelake.sources import partitioned as PT
from pricelake.sources import sinks as SK
from pricelake.streaming import drops

TIE_BREAK = ["source_file", "row_index"]
GEOGRAPHY, TRADE = ("region", "province", "commune"), ("metier", "corps", "activite", "produit", "variete")


def load_geography(spark: SparkSession, ref_root: str, out_path: str, run_id: str = "references") -> None:
    """The geographic dimensions below ``out_path`` from a folder of reference files; known keys keep their ids."""
    files = S.scan_tree(spark, ref_root, "*.csv")
    named = files.select("archive", F.concat(F.lit(K.REFERENCE_FOLDER + "/"), "rel_path").alias("rel_path"), "content")
    raw = drops.write_raw(named, out_path, run_id)
    geo = PI.geography(PI.silver_references(raw, run_id), _dims(spark, out_path, GEOGRAPHY))
    for k, v in geo.items():
        SK.write_version(v, f"{out_path.rstrip('/')}/dim_{k}")


def _dims(spark: SparkSession, out_path: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {k: d for k in names if (d := SK.read_latest(spark, f"{out_path.rstrip('/')}/dim_{k}")) is not None}


def once_each(files: DataFrame) -> DataFrame:
    """archive, rel_path, content of files (a stream or not) that say something new: (level, region, city, file type,
    digest of the content) is looked up in the state store. The content itself isn't kept there."""
    level = P.classify_level("rel_path")
    keys = {"__level": level.niveau, "__region": level.region, "__city": level.agglomeration, "__type": P.file_type("rel_path"), "__digest": F.sha2("content", 256)}
    known = drops.with_members(files).select("archive", "rel_path", "content", *[c.alias(k) for k, c in keys.items()])
    return known.dropDuplicates(list(keys)).drop(*keys)


def facts_sink(out_path: str, run_prefix: str = "stream") -> Callable[[DataFrame, int], None]:
    """foreachBatch handler for the files of :func:`once_each`: raw rows, staging, trade dimensions and the fact
    (``fact_indice``, partitioned by year) below ``out_path``, where the geographic dimensions must be."""
    out = out_path.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"{run_prefix}-{batch_id:08d}"
        staged, _ = PI.stage_prices(drops.write_raw(batch, out, run_id))
        staging = cut_lineage(staged)
        SK.append_run(staging, f"{out}/staging_prices", run_id)
        if staging.isEmpty():
            return
        geo = _dims(spark, out, GEOGRAPHY)
        if "province" not in geo:
            raise ValueError("the fact needs the province reference: call load_geography first")
        for k, v in PI.trade_chain(staging, _dims(spark, out, TRADE)).items():
            SK.write_version(v, f"{out}/dim_{k}")
        trade = _dims(spark, out, TRADE)
        columns = ["annee", "indice", "prix_ttc", "file_type", "agglomeration", "produit", "variete", *TIE_BREAK]
        provinces, exclusions, overrides = PI.fact_references(spark, geo)
        rows = build_index_fact(
            staging.select(*columns), provinces, trade["produit"].select("name", "id"), trade["variete"].select("name", "id"), exclusions, overrides, tie_break=TIE_BREAK
        )
        upsert_fact(rows, f"{out}/fact_indice", TIE_BREAK, best=True)

    return handle


def read_fact(spark: SparkSession, out_path: str) -> DataFrame | None:
    """The stored fact's latest version, ``None`` before the first row."""
    fact = PT.read_partitions(spark, f"{out_path.rstrip('/')}/fact_indice")
    return fact.drop(*TIE_BREAK) if fact is not None else None


def start_facts(
    spark: SparkSession, root: str, out_path: str, checkpoint: str, glob: str = "*.{csv,zip}", available_now: bool = True, max_files_per_trigger: int | None = None
) -> StreamingQuery:
    """Starts the stream from the drops under ``root`` to the fact under ``out_path``. ``checkpoint`` (offsets and the
    state store) must be on shared storage; a new one forgets which drops were seen."""
    files = once_each(drops.stream_files(spark, root, glob, max_files_per_trigger))
    sink = facts_sink(out_path, f"stream-{drops.checkpoint_name(spark, checkpoint)}")
    w = files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
