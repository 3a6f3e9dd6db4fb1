"""Landing of CSV trees and archives.

Files are read with the ``binaryFile`` source: one record per file, so every later step is a distributed job over files
(Spark refuses a file of more than 2 GB instead of cutting it). Encoding and separator are decided per file by Spark
expressions over all its bytes; the parse of one file into row objects is a small Arrow-batched helper, because headers
differ from file to file. One parser serves every size. A file's key is (archive, rel_path): members of different
archives may have equal paths.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re
import sys
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import constants as K
from pricelake.functions.text import normalize_header, normalize_run_id
from pricelake.operators.paths import dataset_class

FILE_KEY = ["archive", "rel_path"]
PARSE_SCHEMA = "archive string, rel_path string, row_index int, row_json string, status string"
#: rows of a file handed over at a time
BATCH_ROWS = 5_000

# bytes that cp1252 leaves undefined; a file containing one can only be latin-1
_CP1252_HOLES = r"[\x{81}\x{8D}\x{8F}\x{90}\x{9D}]"


def _strip_scheme(p: Column) -> Column:
    return F.regexp_replace(p, r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "")


def scan_tree(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Every file matching ``glob`` under ``root`` (recursive), with ``rel_path`` relative to the root and
    ``/``-separated. Content is only read if a later step uses it (the source prunes the column)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    root_norm = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "", root).rstrip("/")
    bare = _strip_scheme(F.col("path"))
    rel = F.when(bare.startswith(root_norm + "/"), F.substring(bare, len(root_norm) + 2, 1 << 30)).otherwise(bare)
    return df.select("path", F.lit("").alias("archive"), rel.alias("rel_path"), "modificationTime", "length", "content")


def explode_archives(archives: DataFrame) -> DataFrame:
    """Each ZIP record becomes one row per member: archive (the ZIP's ``rel_path``), rel_path, length, content. One
    archive per record, so archives are spread over tasks; members stay bytes until parsed."""

    def fan_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["archive", "rel_path", "length", "content"]
        for pdf in batches:
            for archive, blob in zip(pdf["rel_path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(blob)) as z:
                    for info in z.infolist():
                        if info.is_dir():
                            continue
                        name = info.filename.replace("\\", "/").lstrip("/")
                        data = z.read(info)
                        # one member per output batch: memory holds one archive and one member at a time
                        yield pd.DataFrame([(archive, name, len(data), data)], columns=cols)

    return archives.select("rel_path", "content").mapInPandas(
        fan_out, "archive string, rel_path string, length long, content binary"
    )


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)  # noqa: SLF001


def latest_drop(spark: SparkSession, folders: Sequence[str], glob: str = "*.zip", recursive: bool = False) -> DataFrame:
    """S3 (batch): the lexicographically last full path among the drops of all folders (one row); raise when
    there is none. A folder that doesn't exist holds no drop; any other error is raised. Only paths are read."""
    paths = None
    for f in folders:
        if not _exists(spark, f):
            continue
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
        d = found.load(f).select("path")
        paths = d if paths is None else paths.unionByName(d)
    newest = None if paths is None else paths.agg(F.max("path").alias("path"))
    if newest is None or newest.first()["path"] is None:
        raise FileNotFoundError(f"no {glob} under {', '.join(folders)}")
    return newest


def sniff(files: DataFrame, separators: Sequence[str] = K.CSV_SEPARATORS) -> DataFrame:
    """S4 as Spark expressions per file, over all its bytes: ``charset`` (utf-8 if the bytes are valid UTF-8, else cp1252
    unless a byte undefined in cp1252 occurs, else latin-1; a BOM is noted) and ``sep``: the first separator, in list
    order, that splits the header into more than one field and gives the first data line the same field count
    (Q1 fix), else the first separator found in the header, else ``;``. Separators inside quotes don't count."""
    text = F.col("content").cast("string")
    holes = F.decode(F.col("content"), "ISO-8859-1").rlike(_CP1252_HOLES)
    charset = F.when(F.is_valid_utf8(text), F.lit("utf-8")).when(holes, F.lit("latin1")).otherwise(F.lit("cp1252"))
    bom = F.substring(F.col("content"), 1, 3) == F.unhex(F.lit("EFBBBF"))
    # the first two lines that aren't blank
    two = r"\A(?:[ \t]*(?:\r?\n|\r))*([^\r\n]+)(?:(?:\r?\n|\r)[ \t]*)*([^\r\n]*)"
    bare = F.regexp_replace(text, r'"(?:[^"]|"")*+"', '""')
    # in a projection of their own: each is used many times below
    files = files.withColumns({"__header": F.regexp_extract(bare, two, 1), "__first": F.regexp_extract(bare, two, 2)})
    header, first = F.col("__header"), F.col("__first")

    def n_fields(line: Column, sep: str) -> Column:
        return F.size(F.split(line, re.escape(sep), -1))

    consistent = any_sep = F.lit(None).cast("string")
    for s in reversed(separators):
        found = n_fields(header, s) > 1
        any_sep = F.when(found, F.lit(s)).otherwise(any_sep)
        consistent = F.when(found & ((first == "") | (n_fields(first, s) == n_fields(header, s))), F.lit(s)).otherwise(consistent)
    sep = F.coalesce(consistent, any_sep, F.lit(separators[0]))
    return files.withColumn("charset", charset).withColumn("has_bom", F.coalesce(bom, F.lit(False))).withColumn("sep", sep).drop("__header", "__first")


# ---------------------------------------------------------------------------------------------------------------- S5
def _unique_headers(names: list[str]) -> list[str]:
    """Duplicate headers become ``a``, ``a.1``, ...; a blank header becomes ``Unnamed: i`` (Q34)."""
    out, seen = [], {}
    for i, n in enumerate(names):
        n = n if n.strip() != "" else f"Unnamed: {i}"
        base = n
        k = seen.get(base, 0)
        while n in seen:
            k += 1
            n = f"{base}.{k}"
        seen[base] = k
        seen[n] = 0
        out.append(n)
    return out


def _decode(blob: bytes, charset: str) -> str:
    if charset == "utf-8":
        return blob.decode("utf-8-sig")
    return blob.decode(charset)


def parse_csv(blob: bytes, sep: str, charset: str) -> Iterator[list[str] | None]:
    """One file: its header, then its rows, one at a time. Cells are text; a short row is padded with ''; a row longer
    than the header is rejected (None); blank lines are skipped; a quoted cell may hold line breaks."""
    csv.field_size_limit(sys.maxsize)
    header: list[str] | None = None
    for rec in csv.reader(io.StringIO(_decode(blob, charset), newline=""), delimiter=sep, quotechar='"'):
        if not rec or rec == [""]:
            continue
        if header is None:
            header = _unique_headers(rec)
            yield header
        else:
            yield rec + [""] * (len(header) - len(rec)) if len(rec) <= len(header) else None


def _compat_parse(blob: bytes) -> tuple[str, str] | None:
    """Source-system order: separators outer, encodings inner, first combination that parses wins."""
    for s in K.CSV_SEPARATORS:
        for enc in K.CSV_ENCODINGS:
            try:
                text = blob.decode(enc)
            except UnicodeDecodeError:
                continue
            try:
                recs = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=s) if r]
            except csv.Error:
                continue
            if not recs:
                continue
            if any(len(r) > len(recs[0]) for r in recs[1:]):
                continue
            return s, ("utf-8" if enc in ("utf-8", "utf-8-sig") else enc)
    return None


def to_rows(files: DataFrame, compat: bool = False) -> DataFrame:
    """Each file (``archive``, ``rel_path``, ``content``, and ``sep``/``charset`` from :func:`sniff`) becomes its row
    objects, status ``ok``: ``row_index`` 1-based within the file, ``row_json`` a flat JSON object of text cells keyed by
    header (non-ASCII kept). A row longer than the header is ``rejected`` (without data). Last comes one row of status
    ``file``, or ``unreadable`` if the file broke the parser: ``row_index`` is its number of ok rows and ``row_json`` the
    MD5 of its bytes, so a manifest needs no second pass.

    ``compat=True`` ignores the sniffed dialect and takes the first separator x encoding that parses."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "rel_path", "row_index", "row_json", "status"]
        kinds = pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()
        out: list[tuple] = []  # rows of as many files as fill a batch

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for b in batches:
            archives, paths, seps, charsets = (b.column(i).to_pylist() for i in (0, 1, 3, 4))
            for archive, rel, blob, sep, charset in zip(archives, paths, b.column(2), seps, charsets, strict=True):
                blob, n, ended = blob.as_py(), 0, "file"
                dialect = _compat_parse(blob) if compat else (sep, charset)
                try:
                    records = parse_csv(blob, *dialect) if dialect else iter(())
                    header = next(records, [])
                    ended = ended if dialect else "unreadable"
                    for rec in records:
                        if rec is None:
                            out.append((archive, rel, 0, None, "rejected"))
                        else:
                            n += 1
                            out.append((archive, rel, n, encode(dict(zip(header, rec))), "ok"))
                        if len(out) >= BATCH_ROWS:
                            yield batch()
                            out.clear()
                except (UnicodeDecodeError, csv.Error):
                    ended = "unreadable"
                out.append((archive, rel, n, hashlib.md5(blob).hexdigest(), ended))
        if out:
            yield batch()

    encode = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode
    return files.select("archive", "rel_path", "content", "sep", "charset").mapInArrow(parse, PARSE_SCHEMA)


def row_map(c: Column | str = "row_json") -> Column:
    """row object text -> ``map<string,string>`` (key order kept)."""
    return F.from_json(c if isinstance(c, Column) else F.col(c), "map<string,string>")


def row_variant(c: Column | str = "row_json") -> Column:
    """row object text -> VARIANT, parsed once for all readers; null where it isn't valid JSON."""
    return F.try_parse_json(c if isinstance(c, Column) else F.col(c))


def variant_fields(v: Column | str, fields: Mapping[str, str]) -> list[Column]:
    """Typed fields of a VARIANT row object: one column per ``{header: type}``, null where the header is missing or its
    value isn't of the type. A header is taken as it is, whatever characters it has."""
    v = v if isinstance(v, Column) else F.col(v)

    def field(header: str, kind: str) -> Column:
        if "'" in header and '"' in header:  # a path can't name it
            return F.try_variant_get(F.try_variant_get(v, "$", "map<string,variant>")[header], "$", kind)
        return F.try_variant_get(v, f'$["{header}"]' if "'" in header else f"$['{header}']", kind)

    return [field(h, t).alias(h) for h, t in fields.items()]


def variant_schema(rows: DataFrame, v: str) -> Column:
    """The schema of all row objects together, as a scalar: the headers with the types that hold their values."""
    return rows.select(F.schema_of_variant_agg(v)).scalar()


# ---------------------------------------------------------------------------------------------------------- S6, S8
def manifest(rows: DataFrame, run_id: str) -> DataFrame:
    """One row per file with data rows, from the rows of :func:`to_rows`: run, archive, path, dataset class, data
    rows, md5 of the bytes, load stamp."""
    return rows.where((F.col("status") == "file") & (F.col("row_index") > 0)).select(
        normalize_run_id(F.lit(run_id)).alias("run_id"),
        *FILE_KEY,
        dataset_class(F.col("rel_path"), fold=True).alias("dataset"),
        F.col("row_index").alias("row_count"),
        F.col("row_json").alias("md5_hash"),
        F.current_timestamp().alias("load_ts"),
    )


def latest_run(files_manifest: DataFrame) -> DataFrame:
    """Run id of the newest load (greatest ``load_ts``; ties by run id, so the choice is deterministic)."""
    return files_manifest.agg(F.max_by("run_id", F.struct("load_ts", "run_id")).alias("run_id"))


def load_summary(rows: DataFrame) -> DataFrame:
    """Q-9: processed rows and skipped rows (rejected rows and unreadable files)."""
    return rows.agg(
        F.count_if(F.col("status") == "ok").cast("long").alias("processed"),
        F.count_if(F.col("status").isin("rejected", "unreadable")).cast("long").alias("skipped"),
    )


def skipped_rows(rows: DataFrame) -> DataFrame:
    """Rows that the parser left out, per file and reason (unreadable files are named)."""
    left = rows.where(F.col("status").isin("rejected", "unreadable"))
    return left.groupBy(*FILE_KEY, F.col("status").alias("reason")).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


# ---------------------------------------------------------------------------------------------------------------- S7
def read_rows(raw: DataFrame, run_id: str | Column, dataset: str, candidates: Sequence[str]) -> DataFrame:
    """Row objects of one run and dataset whose path equals one of ``candidates`` case- and
    accent-insensitively (``UNICODE_CI_AI``); the map keys are normalised headers."""
    rid = run_id if isinstance(run_id, Column) else F.lit(run_id)
    sel = raw.where(
        (F.col("run_id") == rid)
        & (F.col("dataset") == dataset)
        & F.collate(F.col("rel_path"), "UNICODE_CI_AI").isin([F.lit(c) for c in candidates])
    )
    m = F.transform_keys(row_map("row_json"), lambda k, v: normalize_header(k))
    return sel.select("rel_path", "row_index", m.alias("row"))


def widen(rows: DataFrame, map_col: str = "row") -> DataFrame:
    """Row objects -> one text column per key ('' where a row lacks the key). The key set is header metadata
    (bounded by the header width), gathered with one small distinct job."""
    keys = rows.select(F.posexplode(F.map_keys(map_col)).alias("pos", "k")).groupBy("k").agg(F.min("pos").alias("pos"))
    names = [r["k"] for r in keys.orderBy("pos", "k").collect()]
    return rows.select(*[c for c in rows.columns if c != map_col], *[F.coalesce(F.col(map_col)[n], F.lit("")).alias(n) for n in names])
