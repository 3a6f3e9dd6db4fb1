"""Token ids in binary files, with Elias-Fano coded document boundaries.

A file is one shard: a header, the boundaries of its documents, their ids, and one concatenated array of token ids of two
or four bytes. Boundaries and ids are non-decreasing sequences in Elias-Fano form: the low bits of each value are packed,
the high bits are a unary bit vector in which value i sets bit (high part + i); a select directory of 32-bit places (every
``SAMPLE``-th set bit) returns any offset without a table of 64-bit offsets, in about 2 + log2(tokens per document) bits.

Documents are range-partitioned and sorted by id; a task writes the shards of its range through Spark's text writer (a
shard per row, a row per file), so nothing but Spark needs to reach the storage. Offsets over all documents follow from
the shards' sums, which are added up by range and then within each range.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.llm.common import byte_level_alphabet, column_texts, scratch_path, share_code, small_batches, written

MAGIC = b"TOKIDS01"
#: magic, range, shard of the range, documents, tokens, bytes of an id, documents without id, smallest document id
HEADER = struct.Struct("<8sIIQQBQq")
#: Tokens after which a shard is closed (a single document may have more).
SHARD_TOKENS = 8 << 20
SAMPLE = 256
MAX_TOKENIZER_BYTES = 64 << 20


# --- Elias-Fano ------------------------------------------------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of unsigned numbers, read by ``select`` (one value) or ``values`` (all)."""

    _HEAD = struct.Struct("<QBQ")  # values, low bits, bytes of the bit vector

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        if int(ones[-1]) >= 1 << 32:
            raise ValueError("a shard has too many documents for places of 32 bits")
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel()), np.packbits(high), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = self._HEAD.pack(self.n, self.low_bits, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at byte ``at``, and where it ends."""
        n, low_bits, n_high = cls._HEAD.unpack_from(data, at)
        at += cls._HEAD.size
        parts = []
        for kind, count in (("u1", (n * low_bits + 7) // 8), ("u1", n_high), ("<u4", (n + SAMPLE - 1) // SAMPLE)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(n, low_bits, *parts), at

    def select(self, i: int) -> int:
        """Value ``i``: from the sampled place before it, over the bytes' counts of set bits, to its bit."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skipped = place // 8, place % 8
        left += int(self.high[byte] >> (8 - skipped)).bit_count() if skipped else 0
        while left >= (ones := int(self.high[byte]).bit_count()):
            left -= ones
            byte += 1
        bit = int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1]))[left])
        first = i * self.low_bits
        packed = self.low[first // 8 : (first + self.low_bits + 7) // 8]
        bits = np.unpackbits(packed)[first % 8 : first % 8 + self.low_bits]
        return (byte * 8 + bit - i << self.low_bits) | sum(int(b) << k for k, b in enumerate(bits))

    def values(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            for k in range(self.low_bits):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out


# --- shards ----------------------------------------------------------------------------------------------------------


def pack_shard(part: int, shard: int, doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """A shard of documents in order (those without id first); ``ids`` are their token ids of ``width`` bytes each."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    lengths = np.fromiter((len(x) // width for x in ids), np.int64, len(ids))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    head = HEADER.pack(MAGIC, part, shard, len(ids), int(bounds[-1]), width, len(doc_ids) - len(known), base)
    offsets = EliasFano.of(bounds).to_bytes()
    keys = EliasFano.of(np.array([d - base for d in known], np.uint64)).to_bytes()
    return b"".join([head, offsets, keys, *ids])


class Shard:
    """A shard as read from a file."""

    def __init__(self, data: bytes):
        magic, self.part, self.shard, self.n_docs, self.n_tokens, width, self.n_null, self.base = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        self.offsets, at = EliasFano.read(data, HEADER.size)
        self.keys, at = EliasFano.read(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", self.n_tokens, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.base + int(k) for k in self.keys.values()]

    def tokens(self, i: int) -> np.ndarray:
        """The ids of the shard's document ``i``."""
        return self.ids[self.offsets.select(i) : self.offsets.select(i + 1)]


# --- encoding --------------------------------------------------------------------------------------------------------

CACHE_ENTRIES, PIECE = 800_000, 1 << 20
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Marks, a word of Latin letters, marks: a pre-token each.
_SIMPLE = re.compile(rf'([("]?)([{_LATIN}]+)([.,;:!?)"]*)')
_BEYOND_LATIN = re.compile("[^\x00-\xff]")


class Encoder:
    """Whole texts by the tokenizers library. Where the tokenizer drops white space (its pre-tokenizer keeps the matches
    of a pattern without white space), a text is encoded blank by blank, and what stands between blanks is looked up among
    those encoded before: the ids are the same, as no token reaches over a blank. In the same way a word is looked up apart
    from the marks around it."""

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        own, vocabulary = json.loads(definition), self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values(), default=0) < 1 << 16 else 4
        steps = (own.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        lower = [n.get("type") for n in (own.get("normalizer") or {}).get("normalizers", [])]
        self.drops_blanks = steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert")) and lower == ["NFC", "Replace", "Lowercase"]
        letters = byte_level_alphabet()
        self.written = {b: c for c, b in letters.items()}
        self.splits_marks = self.drops_blanks and [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str('"aéz.,;:!?)"')] == ['"', self._in_bytes("aéz"), '.,;:!?)"']
        self.cache: dict[str, bytes] = {}

    def _in_bytes(self, word: str) -> str:
        return word if word.isascii() else "".join([self.written[b] for b in word.encode()])

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in got]

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """The ids of what stands between blanks, lower-cased unless it has characters beyond Latin-1. A word and the marks
        around it are pre-tokens, which the tokenizer's model cuts up; anything else goes through the whole tokenizer."""
        out, rest, cache, cut = {}, [], self.cache, self.tokenizer.model.tokenize
        kind = f"<u{self.width}"
        for w in words:
            m = _SIMPLE.fullmatch(w) if self.splits_marks else None
            if not m or m[2] != m[2].lower():
                rest.append(w)
                continue
            found = b""
            for part in m.groups():
                if part:
                    if (ids := cache.get(part)) is None:
                        ids = cache[part] = np.array([t.id for t in cut(self._in_bytes(part))], kind).tobytes()
                    found += ids
            out[w] = found
        out.update(zip(rest, self._ids(rest), strict=True))
        return out

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as bytes of ``width`` each."""
        if not self.drops_blanks:
            return self._ids(list(texts))
        cache, out = self.cache, []
        for text in texts:
            found = []
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            for piece in _pieces(text):
                if not _BEYOND_LATIN.search(piece):
                    piece = piece.lower()  # as the tokenizer does; NFC changes nothing here
                words = piece.replace("\n", " ").split(" ")
                if missing := set(words).difference(cache):
                    cache.update(self._words(missing))
                found.append(b"".join(map(cache.__getitem__, words)))
            out.append(b"".join(found))
        return out


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``PIECE`` characters, cut at blanks."""
    at = 0
    while len(text) - at > PIECE:
        end = text.find(" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


@functools.lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    """One per worker process, so that its cache outlives a task."""
    return Encoder(definition)


# --- writing and reading ---------------------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS
) -> None:
    """The token ids of every whole text, in ascending order of the integer ``id_col``, as files below ``path``.

    No special tokens but ``end_id``, which follows each document if given. Null text is empty. A null id comes first;
    rows of equal id are ordered by a hash of their text, equal rows are all written. Other columns are ignored.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(definition) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_file} has more than {MAX_TOKENIZER_BYTES} characters")
    share_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        end = b"" if end_id is None else int(end_id).to_bytes(enc.width, "little")
        part, shard, keys, ids, size = TaskContext.get().partitionId(), 0, [], [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_shard(part, shard, keys, ids, enc.width)], pa.binary())], names=["shard"])

        for b in small_batches(batches, 4 << 20):
            for key, tokens in zip(b.column(0).to_pylist(), enc.encode(column_texts(b.column(1))), strict=True):
                keys.append(key)
                ids.append(tokens + end)
                size += len(ids[-1]) // enc.width
                if size >= shard_tokens:
                    yield closed()
                    shard, keys, ids, size = shard + 1, [], [], 0
        if keys:
            yield closed()

    # equal ids and texts are told apart by their place in the input, so that many copies don't meet in one range
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("place"))
    order = [F.col(c).asc_nulls_first() for c in ("id", "h", "place")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = ranged.select("id", "text").mapInArrow(pack, "shard binary")
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)  # bytes as they are


_DOC_SCHEMA = "doc_id long, part long, shard long, place long, first long, n_tokens long, ids_crc32 long"


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files below ``path``: doc_id, part, shard, place (in the shard), first (token of the
    shard), n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers) and, ``with_ids``, ids (array<int>)."""
    share_code(spark)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                s = Shard(content.as_buffer())
                bounds = s.offsets.values().astype(np.int64)
                keys, wide = s.doc_ids(), s.ids.astype("<u4")
                n_rows = 4096 if with_ids else max(s.n_docs, 1)
                for a in range(0, s.n_docs, n_rows):
                    z = min(a + n_rows, s.n_docs)
                    crc = [zlib.crc32(wide[bounds[i] : bounds[i + 1]]) for i in range(a, z)]
                    whole = np.full(z - a, s.part), np.full(z - a, s.shard), np.arange(a, z), bounds[a:z], np.diff(bounds[a : z + 1])
                    columns = [pa.array(keys[a:z], pa.int64()), *(pa.array(x, pa.int64()) for x in whole), pa.array(crc, pa.int64())]
                    if with_ids:
                        columns.append(pa.array([wide[bounds[i] : bounds[i + 1]].astype(np.int32) for i in range(a, z)], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    schema = _DOC_SCHEMA + ", ids array<int>" * with_ids
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(unpack, schema)


def with_starts(docs: DataFrame) -> DataFrame:
    """``docs`` of :func:`read_documents` with ``start``, the ids of all documents before each. The shards' sums are added
    up within each range, and the ranges' sums over the ranges, so no task holds more rows than there are ranges."""
    shards = docs.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("in_part", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = docs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    base = shards.join(parts, "part").select("part", "shard", (F.col("before") + F.col("in_part")).alias("base"))
    return docs.join(base, ["part", "shard"]).withColumn("start", F.col("base") + F.col("first")).drop("base")


def token_file_round_trip(docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` written by :func:`write_token_files` to shared storage and read back: doc_id, start, n_tokens, ids_crc32.
    An empty table gives no rows; see there for nulls, ties and repeated rows."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_file, end_id, id_col, text_col)
    found = written(read_documents(spark, path), "token_documents")
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")
