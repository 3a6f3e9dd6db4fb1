"""CSV files of any size, read in byte ranges (S4/S5 beyond the size of a record).

Spark's text source reads a file in byte ranges and gives each line to the range that it begins in. Whether a line begins
inside a quoted cell can't be seen from the line, so a first pass takes every range with both possible starts and notes in
which state it ends for each (a row per range). Composed in order, these give the state that every range really begins in.
A second pass parses each range from there. A record belongs to the range that it begins in; where it goes on in later
ranges, its pieces are put together afterwards. A line with quotes is looked at by the rules of the parser of small files:
a quote opens a cell only at the cell's beginning, and is plain text elsewhere.
"""

from __future__ import annotations

import contextlib
import csv
import io
import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.operators.dims import number_rows
from pricelake.session import cut_lineage
from pricelake.sources import files as S

#: Bytes of a file's beginning that the separator is chosen by.
HEAD_BYTES = 1 << 16
#: Bytes of lines parsed at a time.
PARSE_BYTES = 4 << 20
_BOM = b"\xef\xbb\xbf"


class QuoteState:
    """Whether a quoted cell is open behind a line, for either state before it."""

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        closed = rb'"(?:[^"]|"")*+"(?!")[^' + s + rb"\r]*"  # a quoted cell; what follows its end is plain
        plain = rb"(?:[^" + s + rb'\r"][^' + s + rb"\r]*)?"
        opened = rb"(?:(?:" + plain + rb"|" + closed + rb")[" + s + rb'\r])*+"(?:[^"]|"")*+\Z'
        self.outside = re.compile(opened)
        self.inside = re.compile(rb'(?:[^"]|"")*+(?:\Z|"(?!")[^' + s + rb"\r]*[" + s + rb"\r]" + opened + rb")")

    def after(self, line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return inside
        return (self.inside if inside else self.outside).match(line) is not None


@contextlib.contextmanager
def _range_bytes(spark: SparkSession, size: int | None):
    """Within it, files are read in ranges of ``size`` bytes (as the session has it for null)."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if size:
        spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block (the range's first byte), line: the lines of each range, in order within a task."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    for b in batches:
        for file, block, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            yield (file, block), line.as_py()


def dialects(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, str]]:
    """(separator, charset) of each file, as :func:`pricelake.sources.files.sniff` finds them: the charset by all lines, the
    separator by the file's first lines. A row per file."""
    lines = _lines(spark, paths)
    text = F.col("line").cast("string")
    holes = F.decode("line", "ISO-8859-1").rlike(S._CP1252_HOLES)
    charset = F.when(F.bool_and(F.is_valid_utf8(text)), "utf-8").when(F.bool_or(holes), "latin1").otherwise("cp1252")
    charsets = {r["file"]: r["charset"] for r in lines.groupBy("file").agg(charset.alias("charset")).collect()}
    seps = {r["file"]: r["sep"] for r in S.sniff(_heads(lines)).select("file", "sep").collect()}
    return {f: (seps.get(f, ";"), c) for f, c in charsets.items()}


def _heads(lines: DataFrame) -> DataFrame:
    """file, content: the file's first lines, from the ranges that begin within ``HEAD_BYTES``, up to as much of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[tuple[str, int], list[bytes]] = {}
        sizes: dict[tuple[str, int], int] = {}
        for key, line in _by_range(batches):
            if key[1] < HEAD_BYTES and sizes.get(key, 0) < HEAD_BYTES:
                heads.setdefault(key, []).append(line + b"\n")
                sizes[key] = sizes.get(key, 0) + len(line) + 1
        columns = [pa.array([f for f, _ in heads], pa.string()), pa.array([b for _, b in heads], pa.int64()), pa.array([b"".join(h) for h in heads.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "head"])

    parts = lines.mapInArrow(run, "file string, block long, head binary").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "head"))).alias("p"))
    return parts.select("file", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["head"])).alias("content"))


def start_states(spark: SparkSession, paths: list[str], seps: dict[str, str]) -> dict[tuple[str, int], bool]:
    """For every range whether it begins inside a quoted cell: the ranges' state changes, composed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, states, rows = None, (False, True), []
        rules: dict[str, QuoteState] = {}
        for key, line in _by_range(batches):
            if key != at:
                if at:
                    rows.append((*at, *states))
                at, states = key, (False, True)
                rule = rules.setdefault(seps[key[0]], QuoteState(seps[key[0]]))
            states = tuple(rule.after(line, s) for s in states)
        if at:
            rows.append((*at, *states))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = pa.string(), pa.int64(), pa.bool_(), pa.bool_()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "a", "b"])

    changes = _lines(spark, paths).mapInArrow(run, "file string, block long, a boolean, b boolean").collect()  # a row per range
    found, at, state = {}, None, False
    for r in sorted(changes, key=lambda r: (r["file"], r["block"])):
        state = state if r["file"] == at else False
        at = r["file"]
        found[at, r["block"]] = state
        state = r["b"] if state else r["a"]
    return found


_RECORDS = "file string, block long, seq long, cells array<string>, opens boolean, piece binary"


def _records(raw: bytes, sep: str, charset: str) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    for rec in csv.reader(io.StringIO(raw.decode(charset), newline=""), delimiter=sep, quotechar='"'):
        if rec and rec != [""]:
            yield rec


def records(spark: SparkSession, paths: list[str], dialect: dict[str, tuple[str, str]], starts: dict[tuple[str, int], bool]) -> DataFrame:
    """file, block, seq, cells: the records of the files, in the order of (block, seq) within each."""
    shared = spark.sparkContext.broadcast((dialect, starts))  # a row per file and per range

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.split()[0] for f in _RECORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dialect, starts = shared.value
        at, rules = None, {}
        held: list[bytes] = []  # lines not yet parsed; those up to ``whole`` end outside quotes
        whole = size = seq = 0
        inside = mended = False  # mended: what is held began in an earlier range

        def parsed(lines: list[bytes]) -> list[tuple]:
            nonlocal seq
            rows = []
            for rec in _records(b"\n".join(lines) + b"\n", *dialect[at[0]]):
                rows.append((*at, seq, rec, None, None))
                seq += 1
            return rows

        def flush(ended: bool) -> list[tuple]:
            nonlocal held, whole, size
            rows = parsed(held[:whole]) if whole else []
            held, whole, size = held[whole:], 0, 0
            if ended and held:
                rows.append((*at, (1 << 40) if not mended else -1, None, not mended, b"\n".join(held) + b"\n"))
                held = []
            return rows

        for key, line in _by_range(batches):
            if key != at:
                if at and (rows := flush(True)):
                    yield out(rows)
                at, seq = key, 0
                sep, charset = dialect[key[0]]
                rule = rules.setdefault(sep, QuoteState(sep))
                inside = mended = starts[key]
                if key[1] == 0 and charset == "utf-8":
                    line = line.removeprefix(_BOM)
            held.append(line)
            size += len(line) + 1
            inside = rule.after(line, inside)
            if not inside:
                if mended:
                    yield out([(*at, -1, None, False, b"\n".join(held) + b"\n")])
                    held, size, mended = [], 0, False
                whole = len(held)
                if size >= PARSE_BYTES:
                    if rows := flush(False):
                        yield out(rows)
        if at and (rows := flush(True)):
            yield out(rows)

    found = cut_lineage(_lines(spark, paths).mapInArrow(run, _RECORDS))
    whole = found.where("cells IS NOT NULL").select("file", "block", "seq", "cells")
    # the pieces of a record: the one that opens it and those up to the next that opens one
    order = Window.partitionBy("file").orderBy("block", "seq")
    pieces = found.where("cells IS NULL").withColumn("owner", F.sum(F.col("opens").cast("int")).over(order))
    joined = pieces.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "piece"))).alias("p"))
    raw = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["piece"]))
    joined = joined.select("file", F.get("p", F.lit(0))["block"].alias("block"), raw.alias("raw"))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for file, block, raw in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                rows += [(file, block, (1 << 40) + i, rec, None, None) for i, rec in enumerate(_records(raw, *shared.value[0][file]))]
            if rows:
                yield out(rows).select(["file", "block", "seq", "cells"])

    return whole.unionByName(joined.mapInArrow(mend, "file string, block long, seq long, cells array<string>"))


def read_csv_ranges(spark: SparkSession, paths: list[str], rel_paths: dict[str, str] | None = None, dialect: dict[str, tuple[str, str]] | None = None, range_bytes: int | None = None) -> DataFrame:
    """The rows of CSV files of any size with the columns of :func:`pricelake.sources.files.to_rows` (archive, rel_path,
    row_index, row_json, status), equal to what it gives for small ones. ``rel_paths`` names files (the path if absent);
    ``dialect`` gives (separator, charset) by path, else they are found. The ``file`` row's digest is one of the rows, as an
    MD5 of the bytes would need them in one task. A quoted cell that the file's end leaves open ends in a line break."""
    if not paths:
        return spark.createDataFrame([], S.PARSE_SCHEMA)
    with _range_bytes(spark, range_bytes):
        dialect = dialect or dialects(spark, paths)
        starts = start_states(spark, paths, {f: d[0] for f, d in dialect.items()})
        found = cut_lineage(records(spark, paths, dialect, starts))
    headers = found.groupBy("file").agg(F.min_by("cells", F.struct("block", "seq")).alias("header"), F.min(F.struct("block", "seq")).alias("first"))
    data = found.join(headers, "file").where(F.struct("block", "seq") > F.col("first")).drop("first")
    ok = F.size("cells") <= F.size("header")

    def objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, header = None, []
        for b in batches:
            out = []
            for names, cells in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if names != last:
                    last, header = names, S._unique_headers(names)
                out.append(json.dumps(dict(zip(header, cells + [""] * (len(header) - len(cells)))), ensure_ascii=False, separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(out, pa.string())], names=["file", "block", "seq", "row_json"])

    rows = data.where(ok).select("file", "block", "seq", "header", "cells").mapInArrow(objects, "file string, block long, seq long, row_json string")
    numbered = number_rows(rows, ["block", "seq"], ["file"], "row_index").select("file", F.col("row_index").cast("int").alias("row_index"), "row_json", F.lit("ok").alias("status"))
    rejected = data.where(~ok).select("file", F.lit(0).alias("row_index"), F.lit(None).cast("string").alias("row_json"), F.lit("rejected").alias("status"))
    digest = F.md5(F.concat_ws(":", F.count("row_json").cast("string"), F.coalesce(F.bit_xor(F.xxhash64("row_index", "row_json")), F.lit(0)).cast("string")).cast("binary"))
    every = headers.select("file").join(numbered, "file", "left")
    ended = every.groupBy("file").agg(F.count("row_json").cast("int").alias("row_index"), digest.alias("row_json")).withColumn("status", F.lit("file"))
    names = F.create_map(*[F.lit(x) for pair in (rel_paths or {}).items() for x in pair]) if rel_paths else None
    rel = F.coalesce(F.try_element_at(names, F.col("file")), F.col("file")) if rel_paths else F.col("file")
    out = numbered.unionByName(rejected).unionByName(ended)
    return out.select(F.lit("").alias("archive"), rel.alias("rel_path"), "row_index", "row_json", "status")
