"""Spelling variants by Bloom-guided neighbourhoods.

The words of a corpus are counted (before the shuffle and after it). Their filters are blocked Bloom filters of 64-bit
blocks, one per word length, built by Spark and broadcast; if they would take more than ``FILTER_BYTES``, the vocabulary
is split by hash and the filters are broadcast one part after the other. Every word then makes its edits, as 64-bit
hashes only: a hash of a word is a polynomial over its code points, so that of an edit follows from prefix sums, for all
places of a block of words at once. Being near is symmetric, so deletions (whose converse are insertions) and
replacements by a larger code point are enough. What the filter of the edit's length lets through is shuffled, as
(hash of the word, place, code point, hash of the edit), and joined with the vocabulary: by hash, and then by the edited
text itself, which removes all that a filter or a hash let through by chance.

Roots are found by pointer doubling over (word, form): a form's count is at least twice its word's, so no chain has more
than log2(largest count) steps and 6 rounds are enough for any count of 64 bits.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import column_bytes, mix, share_code, small_batches, written

#: Runs of letters after lower-casing A-Z.
RUNS = re.compile("[a-zÀ-ÿ]+")
#: Code points that a word can have, and their number in 64-bit sums.
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
FILTER_BYTES = 64 << 20
WORDS_A_BLOCK = 4  # words per 64-bit block of a filter: 16 bits each
SHARDS = 512
COUNTED_WORDS = 500_000
BLOCK = 1 << 18  # letters looked at at once

_RNG = np.random.default_rng(11)
_BASE = np.uint64(int(_RNG.integers(2**40, 2**63)) | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTER = np.zeros(0x100, np.uint64)
_LETTER[ALPHABET] = _RNG.integers(1, 2**63, len(ALPHABET), dtype=np.uint64)
_PER_LENGTH = np.uint64(int(_RNG.integers(2**40, 2**63)) | 1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points (all below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * int(_PER_LENGTH) & (1 << 64) - 1))


def word_keys(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.zeros(len(words), np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else []:
        m = letters_of([words[i] for i in own])
        out[own] = finished((_LETTER[m] * powers(_BASE, m.shape[1])).sum(1, dtype=np.uint64), m.shape[1])
    return out


def shard_of(lengths: np.ndarray | int) -> np.ndarray | int:
    """A filter of its own for each length; lengths of 256 and more share 256 filters."""
    return np.where(np.asarray(lengths) < 256, lengths, 256 + np.asarray(lengths) % 256)


def bits_of(keys: np.ndarray) -> np.ndarray:
    """The four bits of a key in its block."""
    out = np.zeros(len(keys), np.uint64)
    for shift in (0, 6, 12, 18):
        out |= np.uint64(1) << ((keys >> np.uint64(shift)) & np.uint64(63))
    return out


def block_of(keys: np.ndarray, n_blocks: np.ndarray | int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.asarray(n_blocks, np.uint64)).astype(np.int64)


class Filters:
    """The filters of one part of the vocabulary (the words whose hash is ``part`` modulo ``parts``): blocks of all shards,
    one after the other."""

    def __init__(self, first: np.ndarray, blocks: np.ndarray, part: int = 0, parts: int = 1):
        self.first, self.blocks = first, blocks  # shard s: blocks[first[s]:first[s + 1]]
        self.part, self.parts = part, parts

    def size(self, length: int) -> int:
        s = int(shard_of(length))
        return int(self.first[s + 1] - self.first[s])

    def holds(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Places of the keys (of edits of this length) that the shard lets through."""
        s, n = int(shard_of(length)), self.size(length)
        bits = bits_of(keys)
        held = (self.blocks[self.first[s] + block_of(keys, n)] & bits) == bits
        if self.parts > 1:
            held &= keys.view(np.int64) % self.parts == self.part
        return np.flatnonzero(held)


def edits(words: list[str], filters: Filters) -> Iterator[tuple[np.ndarray, ...]]:
    """For words of one length: (word's number, place from 0, code point or 0 for a deletion, hash of the edit) of the
    edits that the filters let through, in blocks of about ``BLOCK`` letters."""
    length = len(words[0])
    power, back = powers(_BASE, length), np.uint64(_BACK)
    rows = max(1, BLOCK // length)
    replace, delete = filters.size(length) > 0, filters.size(length - 1) > 0
    for r in range(0, len(words) if replace or delete else 0, rows):
        m = letters_of(words[r : r + rows])
        sums = np.cumsum(_LETTER[m] * power, axis=1, dtype=np.uint64)
        whole = sums[:, -1:]
        for a in range(0, length, BLOCK):
            part, own = m[:, a : a + BLOCK], slice(a, min(a + BLOCK, length))
            if delete:
                following = np.zeros_like(part)
                following[:, :-1] = part[:, 1:]
                if own.stop < length:
                    following[:, -1] = m[:, own.stop]
                i, k = np.nonzero(part != following)  # of equal letters in a row only the last is deleted
                before = sums[:, own][i, k] - (_LETTER[part] * power[own])[i, k]
                keys = finished(before + (whole[i, 0] - sums[:, own][i, k]) * back, length - 1)
                at = filters.holds(keys, length - 1)
                if len(at):
                    yield r + i[at], a + k[at], np.zeros(len(at), np.int32), keys[at]
            if replace:
                base = whole - _LETTER[part] * power[own]
                for c in ALPHABET:
                    i, k = np.nonzero(part < c)
                    keys = finished(base[i, k] + _LETTER[c] * power[own][k], length)
                    at = filters.holds(keys, length)
                    if len(at):
                        yield r + i[at], a + k[at], np.full(len(at), c, np.int32), keys[at]


def count_words(docs: DataFrame, id_col: str, text_col: str, drop_every: int, min_length: int) -> DataFrame:
    """(word, n): maximal runs of letters with A-Z lower-cased, counted. With ``drop_every``, a run whose h, the crc32 of
    ``<id>:<run>``, it divides loses its code point h % length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for b in small_batches(batches, 4 << 20):
            for doc_id, text in zip(b.column(0).to_pylist(), column_bytes(b.column(1)), strict=True):
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(RUNS.findall(text.lower().decode("utf-8", "replace"))).items():
                    if drop_every:
                        h = zlib.crc32(word.encode(), before)
                        if not h % drop_every:
                            i = h % len(word)
                            word = word[:i] + word[i + 1 :]
                    if len(word) >= min_length:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED_WORDS:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    found = docs.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _with_keys(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            keys = word_keys(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys.view(np.int64))], names=["word", "n", "h"])

    return words.mapInArrow(run, "word string, n long, h long")


def part_filters(words: DataFrame, part: int, parts: int, first: np.ndarray) -> Filters:
    """The filters of the words whose hash is ``part`` modulo ``parts``: blocks are put together by Spark and make at
    most ``FILTER_BYTES``, which the driver hands on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy().view(np.uint64)
            shard = shard_of(b.column(1).to_numpy())
            place = first[shard] + block_of(keys, first[shard + 1] - first[shard])
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(bits_of(keys).view(np.int64))], names=["place", "bits"])

    own = words.where(F.pmod("h", F.lit(parts)) == part).select("h", F.length("word").cast("long"))
    blocks = own.mapInArrow(run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(int(first[-1]), np.uint64)
    out[blocks.column("place").to_numpy()] = blocks.column("bits").to_numpy().view(np.uint64)
    return Filters(first, out, part, parts)


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n, h; a written table) that differ by one inserted, deleted
    or replaced code point, in both orders."""
    spark = words.sparkSession
    shard = F.when(F.length("word") < 256, F.length("word")).otherwise(256 + F.length("word") % 256)
    sizes = {r["shard"]: r["n"] for r in words.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}  # SHARDS rows
    parts = max(1, -(-sum(sizes.values()) * 8 // (WORDS_A_BLOCK * filter_bytes)))
    per_shard = np.array([-(-sizes.get(s, 0) // (WORDS_A_BLOCK * parts)) for s in range(SHARDS)], np.int64)
    first = np.concatenate([[0], np.cumsum(per_shard)])
    found = None
    for part in range(parts):
        shared = spark.sparkContext.broadcast(part_filters(words, part, parts, first))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filters = shared.value
            for b in small_batches(batches, 1 << 20):
                own = b.column(0).to_pylist()
                keys = b.column(1).to_numpy()
                by_length: dict[int, list[int]] = {}
                for i, w in enumerate(own):
                    by_length.setdefault(len(w), []).append(i)
                for members in by_length.values():
                    number = np.array(members)
                    for i, place, letter, edit in edits([own[j] for j in members], filters):
                        columns = keys[number[i]], place.astype(np.int64), letter, edit.view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "place", "letter", "edit"])

        probed = written(words.select("word", "h").mapInArrow(run, "h long, place long, letter int, edit long"), "edits")
        found = probed if found is None else found.unionByName(probed)
        shared.unpersist()
    target = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("h").alias("edit"))
    hits = found.join(target, "edit").join(words, "h")
    place = F.col("place").cast("int")
    letter = F.when(F.col("letter") == 0, F.lit("")).otherwise(F.char(F.col("letter")))
    edited = F.concat(F.substring("word", F.lit(1), place), letter, F.substring("word", place + 2, F.length("word")))
    pairs = hits.where(edited == F.col("near")).select("word", "n", "near", "near_n")
    both = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form; written) that have a form: pointers are doubled until none
    moves. A word without form is a root."""
    up = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "up")
    while True:
        after = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(up.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went_on")), "up")
        up = moved.select("word", "root")
        if moved.where("went_on").isEmpty():
            return up


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3, drop_every: int = 0, ratio: float = 2, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """One row per word of ``docs`` with ``min_length`` code points or more and ``min_count`` occurrences or more: word, n,
    n_near (words at one edit), form (the near word of largest n, of equal ones the smallest in code-point order, if its
    n is at least ``ratio`` times the word's; else null), form_n, root (the end of the chain of forms).

    Null texts have no words; a null id counts as an empty text in ``drop_every`` (see :func:`count_words`); repeated rows
    count each; other columns are ignored; an empty table gives no rows. ``ratio`` must be more than 1.
    """
    share_code(docs.sparkSession)
    counted = count_words(docs, id_col, text_col, drop_every, min_length).where(F.col("n") >= min_count)
    words = written(_with_keys(counted), "words")
    pairs = near_pairs(words, filter_bytes)
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    best = pairs.groupBy(F.col("word").alias("own"), F.col("n").alias("own_n")).agg(F.count(F.lit(1)).alias("n_near"), first.alias("best"))
    form_n = -F.col("best.less")
    is_form: Column = form_n >= F.col("own_n") * F.lit(ratio)
    best = best.select("own", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, form_n).alias("form_n"))
    forms = written(words.join(best, F.col("word") == F.col("own"), "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n"), "forms")
    return forms.join(roots_of(forms), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
