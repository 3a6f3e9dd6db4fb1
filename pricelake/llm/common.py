"""Shared helpers: written intermediate tables, Arrow columns, word and shingle hashes."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pricelake.session import ensure_checkpoint_dir


_SHARED: set[str] = set()


def share_code(spark: SparkSession) -> None:
    """Hands this library to the Python workers of the session's application (once), wherever the driver runs."""
    context = spark.sparkContext
    if context.applicationId in _SHARED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="pricelake-code-"), "pricelake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _SHARED.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared storage). It is deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)  # noqa: SLF001
    return path


_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written` that nothing will read again: call it when what was made of them is written. The
    driver's garbage goes too, so that Spark's cleaner drops the shuffles that led to them."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm  # noqa: SLF001
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop(t))
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001
    if tables:
        gc.collect()
        jvm.System.gc()


def column_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; null is empty."""
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def column_texts(column: pa.Array) -> Iterator[str]:
    """Each text of an Arrow column; null is empty."""
    for x in column_bytes(column):
        yield x.decode("utf-8", "replace")


def small_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``max_bytes`` (one row at least), so that what is built from a batch stays small."""
    for b in batches:
        rows = max(1, int(b.num_rows * max_bytes / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character that byte-level vocabularies write: printable Latin-1 as it is, the others in order
    from U+0100."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


# --- words: lower-cased runs of a-z, 0-9 and of every character beyond ASCII -------------------------------------

_LOWER = np.zeros(256, np.uint8)
_LOWER[128:] = np.arange(128, 256)
for _range, _shift in ((b"09", 0), (b"az", 0), (b"AZ", 32)):
    _codes = np.arange(_range[0], _range[1] + 1)
    _LOWER[_codes] = _codes + _shift
#: for ``bytes.translate``: word bytes lower-cased, all others a blank
WORD_BYTES = bytes(int(x) or 32 for x in _LOWER)

_WORD_MARKS = bytes(ord("a") if x else 32 for x in _LOWER)

_RNG = np.random.default_rng(20240607)
_BYTE_HASH = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE, _MIX1, _MIX2, _STEP = (int(x) | 1 for x in _RNG.integers(2**40, 2**63, 4))
_POWERS = np.ones(1, np.uint64)


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 64), _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS


def count_words(text: bytes) -> int:
    return (b" " + text.translate(_WORD_MARKS)).count(b" a")


def _hashed(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, 64-bit hash) of each word of ``text``, in order."""
    low = _LOWER[np.frombuffer(text, np.uint8)]
    inside = low != 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    if not len(edges):
        return edges, np.zeros(0, np.uint64)
    lengths = edges[1::2] - edges[::2]
    starts = np.cumsum(lengths) - lengths
    kept = low[inside]
    place = np.arange(len(kept)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(_BYTE_HASH[kept] * _powers(int(lengths.max()))[place], starts)
    return edges[::2], mix(sums + lengths.astype(np.uint64))


def word_hashes(text: bytes, chunk: int = 1 << 22) -> np.ndarray:
    """A 64-bit hash of each word of ``text``, in order. Long texts are hashed in pieces that end between words."""
    if len(text) > chunk:
        out, at = [], 0
        while at < len(text):
            end = min(at + chunk, len(text))
            while end < len(text) and _LOWER[text[end]]:
                end += 1
            out.append(word_hashes(text[at:end], end - at))
            at = end
        return np.concatenate(out)
    return _hashed(text)[1]


def all_word_hashes(texts: Iterator[bytes], chunk: int = 1 << 16) -> Iterator[np.ndarray]:
    """:func:`word_hashes` of each text; short texts are hashed together."""
    run, size = [], 0

    def hashed() -> list[np.ndarray]:
        if len(run) == 1:
            return [word_hashes(run[0])]
        firsts, hashes = _hashed(b" ".join(run))
        ends = np.cumsum([len(t) + 1 for t in run])
        return np.split(hashes, np.searchsorted(firsts, ends[:-1]))

    for t in texts:
        if run and size + len(t) > chunk:
            yield from hashed()
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield from hashed()


def shingle_hashes(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash of each run of ``size`` words, in order; a shorter text is one shingle, a text without words none."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    # the polynomial of a run from those of its halves
    out, k = hashes, 1
    for bit in bin(size)[3:]:
        out, k = out[: len(out) - k] * np.uint64(pow(_STEP, k, 1 << 64)) + out[k:], 2 * k
        if bit == "1":
            out, k = out[: len(out) - 1] * np.uint64(_STEP) + hashes[k:], k + 1
    return mix(out[:n])
