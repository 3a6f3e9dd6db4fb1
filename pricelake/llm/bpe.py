"""Byte-level BPE: encoding and decoding by a rank file.

The pattern splits a text into pre-tokens. Tier one: a minimal perfect hash over the vocabulary resolves a pre-token
that is a whole vocabulary entry. Tier two: any other pre-token is merged as a linked list of byte spans, with a heap of
adjacent pairs by rank. A bounded cache of encoded pre-tokens stands before both tiers. The vocabulary is a file of
proven size (checked below), read by the driver and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from pricelake.llm.common import column_texts, small_batches

#: Largest rank file that is broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
CACHE_ENTRIES = 250_000


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file (base64, blank, rank), by rank. Ranks must be 0 to n - 1."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, data.splitlines()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks must be 0 to n - 1")
    return [t for _, t in pairs]


class PerfectHash:
    """Minimal perfect hash by bucket displacement. Buckets of several keys try displacements until all their slots are
    free, the fullest first; buckets of one key then name one of the free slots left (as -1 - slot)."""

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), len(keys) // 3 + 1
        halves = [self._halves(k) for k in keys]
        groups: dict[int, list[int]] = {}
        for i, (_, high) in enumerate(halves):
            groups.setdefault(high % self.buckets, []).append(i)
        self.shift, self.keys_at = [0] * self.buckets, [-1] * self.n
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:
                break
            for d in range(1 << 20):
                at = [self._place(*halves[i], d) for i in members]
                if len(set(at)) == len(at) and all(self.keys_at[s] < 0 for s in at):
                    break
            else:
                raise ValueError("no displacement found: are the keys distinct?")
            self.shift[bucket] = d
            for i, s in zip(members, at, strict=True):
                self.keys_at[s] = i
        free = iter([s for s in range(self.n) if self.keys_at[s] < 0])
        for bucket, members in groups.items():
            if len(members) == 1:
                s = next(free)
                self.shift[bucket], self.keys_at[s] = -1 - s, members[0]

    @staticmethod
    def _halves(key: bytes) -> tuple[int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return h & 0xFFFFFFFFFFFFFFFF, h >> 64

    def _place(self, low: int, high: int, d: int) -> int:
        return (((low + d * 0x9E3779B97F4A7C15) ^ high) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF) % self.n

    def find(self, key: bytes) -> int:
        """The index of ``key``; of any other key some index, so the caller compares."""
        low, high = self._halves(key)
        d = self.shift[high % self.buckets]
        return self.keys_at[-1 - d if d < 0 else self._place(low, high, d)]


class Codec:
    """Encodes and decodes with a vocabulary by rank."""

    def __init__(self, vocabulary: list[bytes], pattern: str, perfect: PerfectHash | None = None):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.perfect = perfect or PerfectHash(vocabulary)
        self.ranks = {t: r for r, t in enumerate(vocabulary)}
        self.cache: dict[str, bytes] = {}

    def whole(self, token: bytes) -> int | None:
        i = self.perfect.find(token)
        return i if self.vocabulary[i] == token else None

    def merged(self, token: bytes) -> list[int]:
        n, rank = len(token), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(token[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if j <= 0 or j >= n or after[j] != end:
                continue  # one side has been merged meanwhile
            after[i], after[j] = end, 0
            if end < n:
                before[end] = i
                if (r := rank(token[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (p := before[i]) >= 0 and (r := rank(token[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[token[i : after[i]]])
            i = after[i]
        return out

    def encode(self, text: str) -> np.ndarray:
        pieces, cache = self.pattern.findall(text), self.cache
        try:
            joined = b"".join([cache[p] for p in pieces])
        except KeyError:
            found = []
            for p in pieces:
                if (ids := cache.get(p)) is None:
                    token = p.encode()
                    one = self.whole(token)
                    ids = np.array([one] if one is not None else self.merged(token), "<u4").tobytes()
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    if len(p) <= 64:
                        cache[p] = ids
                found.append(ids)
            joined = b"".join(found)
        return np.frombuffer(joined, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (little-endian 32-bit ids), decoded_sha256 (the bytes
    that the ids decode to) and, unless ``with_ids`` is false, ids (array<int>).

    Whole texts, without special tokens; null or empty text has no tokens. Repeated rows and null ids stay; other
    columns are ignored; an empty table gives no rows.
    """
    vocabulary = read_ranks(rank_file)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, PerfectHash(vocabulary)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value[0], pattern, shared.value[1])
        for b in small_batches(batches, 4 << 20):
            n, ids_hex, text_hex, ids = [], [], [], []
            for text in column_texts(b.column(1)):
                got = codec.encode(text)
                n.append(len(got))
                ids_hex.append(hashlib.sha256(got).hexdigest())
                text_hex.append(hashlib.sha256(codec.decode(got)).hexdigest())
                if with_ids:
                    ids.append(got.astype(np.int32))
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)
