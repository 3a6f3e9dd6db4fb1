"""WARC archives: a writer and a splittable reader.

Archives are gzip members, one per record. Spark's text writer stores them as raw bytes: a row is a run of whole members,
and the line separator is an empty gzip member, which readers pass over. The reader is Spark's text reader with the gzip
magic as line separator, so files are read in byte ranges, and a task owns the pieces that begin inside its range. A piece
is a candidate: it is a member if its gzip header decodes and its content begins like a WARC record. Where a member holds
the magic by chance, the piece after it is not a candidate and is appended; if that piece lies in the next task's range,
both are joined afterwards by file. Archive names must not end in .gz, or Hadoop unpacks the whole file in one task.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import column_bytes, scratch_path, small_batches

MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 4 << 20
_RECORD_SCHEMA = (
    "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
)
_LEFT_SCHEMA = "file string, block long, seq int, piece binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A record as a gzip member: a response, or with ``refers_to`` a revisit (HTTP headers only)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id if page_id is not None else ''}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """A record per row of ``pages``. Of rows with equal payloads of at least ``min_bytes``, those with the smallest id
    are responses and the others revisits of it. Null html is empty; a null id is larger than any other; rows of equal
    id and payload are alike. Other columns are ignored."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256))
    slim = rows.where(F.octet_length("payload") >= min_bytes).select("page_id", "sha")
    firsts = slim.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = slim.join(firsts, "sha").where(~F.col("page_id").eqNullSafe(F.col("first"))).distinct()
    later = later.select(F.col("page_id").alias("id2"), F.col("sha").alias("sha2"), F.col("first").cast("string").alias("refers_to"))
    decided = rows.join(later, rows["page_id"].eqNullSafe(later["id2"]) & (rows["sha"] == later["sha2"]), "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for b in small_batches(batches):
            ids, urls, refers = (b.column(i).to_pylist() for i in (0, 1, 3))
            for page_id, url, payload, refers_to in zip(ids, urls, column_bytes(b.column(2)), refers, strict=True):
                members.append(record(page_id, url, payload, refers_to, date))
                size += len(members[-1])
                if size >= CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["members"])
                    members, size = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["members"])

    packed = decided.select(F.col("page_id").cast("string"), "url", "payload", "refers_to").mapInArrow(pack, "members binary")
    raw = packed.select(F.col("members").cast("string").alias("value"))  # the bytes stay as they are
    raw.write.option("lineSep", member(b"").decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def _header(content: bytes, name: str) -> str | None:
    m = re.search(rf"^{name}:[ \t]*(.*?)\r?$".encode(), content, re.MULTILINE | re.IGNORECASE)
    return m[1].decode("utf-8", "replace") if m else None


def parse(content: bytes) -> dict | None:
    """The fields of a record's content; None if it isn't a whole page record."""
    head, found, rest = content.partition(b"\r\n\r\n")
    length = _header(head, "Content-Length")
    if not found or not length or len(rest) < int(length):
        return None
    kind, block = _header(head, "WARC-Type"), rest[: int(length)]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    page = re.fullmatch(r"<urn:page:(.*)>", _header(head, "WARC-Record-ID") or "")
    refers = re.fullmatch(r"<urn:page:(.*)>", _header(head, "WARC-Refers-To") or "")
    own = kind == "response"
    return {
        "page_id": page[1] or None if page else None,
        "url": _header(head, "WARC-Target-URI"),
        "record_type": kind,
        "payload_bytes": len(payload) if own else int(_header(http, "Content-Length") or 0),
        "payload_digest": sha1_base32(payload) if own else (_header(head, "WARC-Payload-Digest") or "").removeprefix("sha1:"),
        "refers_to": refers[1] if refers else None,
        "payload": payload if own else None,
    }


class Joiner:
    """Joins the pieces between magics, in order, to members. ``pieces`` are those of the member begun, with their
    numbers; a piece that turns out to belong to none goes to ``rejected``."""

    def __init__(self):
        self.pieces: list[tuple[int, bytes]] = []
        self.rejected: list[tuple[int, bytes]] = []

    def add(self, seq: int, piece: bytes) -> bytes | None:
        """The content of the member that this piece completes, if it does."""
        if self.pieces:
            self._feed(seq, piece)
            if self.pieces:
                return self._ended()
        self.unpacker, self.content = zlib.decompressobj(31), b""
        self._feed(seq, piece)
        if not self.pieces:
            self.rejected.append((seq, piece))
        return self._ended()

    def _feed(self, seq: int, piece: bytes) -> None:
        """Goes on with the member, or rejects all its pieces if this one can't follow them."""
        data = MAGIC + piece
        try:
            content = self.content + self.unpacker.decompress(data)
            size = len(data) + sum(len(p) for _, p in self.pieces)
            begins = content[:7] == b"WARC/1." or not content and (self.unpacker.eof or size <= 64)
        except zlib.error:
            begins = False
        if begins:
            self.content = content
            self.pieces.append((seq, piece))
        else:
            self.rejected += self.pieces
            self.pieces = []

    def _ended(self) -> bytes | None:
        if not self.pieces or not self.unpacker.eof:
            return None
        self.pieces = []
        return self.content


def _columns(schema: str) -> list[tuple[str, pa.DataType]]:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return [(n, types[t]) for n, t in (f.split() for f in schema.split(", "))]


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(_columns(schema)))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The page records below ``path``: page_id and refers_to (text), url, record_type, payload_bytes, payload_digest,
    payload (null for revisits). Empty members and other records are passed over."""
    pieces = (
        spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))
    )
    both = _RECORD_SCHEMA + ", " + _LEFT_SCHEMA

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, joiner, seq = None, Joiner(), 0

        def left(pieces: list[tuple[int, bytes]]) -> list[dict]:
            return [{"file": at[0], "block": at[1], "seq": n, "piece": p} for n, p in pieces]

        for b in small_batches(batches):
            rows = []
            for file, block, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), column_bytes(b.column(2)), strict=True):
                if at != (file, block):
                    rows += left(joiner.rejected + joiner.pieces)
                    at, joiner, seq = (file, block), Joiner(), 0
                    if block == 0:
                        continue  # what is before the file's first magic
                seq += 1
                content = joiner.add(seq, piece)
                rows += left(joiner.rejected)
                joiner.rejected = []
                if content and (found := parse(content)):
                    rows.append(found)
            if rows:
                yield _batch(rows, both)
        if joiner.pieces:
            yield _batch(left(joiner.pieces), both)

    def mend(table):
        joiner, rows = Joiner(), []
        ordered = table.sort_by([("block", "ascending"), ("seq", "ascending")])
        for n, piece in enumerate(ordered.column("piece")):
            content = joiner.add(n, piece.as_py())
            if content and (found := parse(content)):
                rows.append(found)
        return pa.Table.from_pylist(rows, pa.schema(_columns(_RECORD_SCHEMA)))

    joined = pieces.mapInArrow(join, both)
    names = [n for n, _ in _columns(_RECORD_SCHEMA)]
    left = joined.where("file IS NOT NULL").select("file", "block", "seq", "piece")  # a few, as magics are rare by chance
    return joined.where("file IS NULL").select(*names).unionByName(left.groupBy("file").applyInArrow(mend, _RECORD_SCHEMA))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` written as archives on shared storage and read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to. An empty table gives no rows; see :func:`write_archives` for nulls and ties."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, html_col, min_bytes)
    kind = pages.schema[id_col].dataType
    return read_archives(pages.sparkSession, path).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )
