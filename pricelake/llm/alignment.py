"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes in two ways. Every token points to the farthest-right token of the other side that it
overlaps (of equal ends to the B token, which points to itself); successors are doubled for all tokens of a batch at once
until nothing changes, and the terminal token they then name is the label of the token's group.

Both tokenizers cut a text at a blank between two marks that aren't white space, so a text is a run of chunks (a blank and
what follows up to the next such blank), and no group reaches over two of them. Two passes over the texts:

1. the distinct chunks are counted (before the shuffle and after it), each is aligned once, and its linked id pairs are
   summed up with its count: the corpus-wide counts of id pairs, in a written table;
2. every text's chunks are looked up among those aligned before by the worker. The counts of the most frequent pairs
   (``HOT_PAIRS`` at most) are broadcast; the links of all other pairs are joined with the written table by pair.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import byte_level_alphabet, column_texts, share_code, small_batches, written

MAX_FILE_BYTES = 64 << 20
#: Id pairs whose counts are broadcast at most (20 bytes each).
HOT_PAIRS = 1 << 18
#: Distinct chunks that a worker keeps, and chunks counted before they are handed on.
KEPT_CHUNKS, COUNTED_CHUNKS = 700_000, 300_000
#: Texts are cut into chunks in pieces of about this many characters.
PIECE = 1 << 20

_CHUNK = re.compile(r"\s*\S+(?:(?! \S)\s+\S+)*(?:\s+\Z)?|\s+\Z")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_ODD_BLANKS = re.compile(r"\s\s|\A\s|\s\Z")
_PLAIN = "\t\n\r" + "".join(map(chr, [*range(32, 127), *range(0xA0, 0x180)]))
_NOT_PLAIN = re.compile(r"[^\t\n\r -~\xa0-ſ]")
_BLOCK = "▁"


def chunks_of(text: str) -> Iterator[list[str]]:
    """The chunks of a text without the blank that each begins with (the first with the added one), a list per piece."""
    if len(text) <= PIECE and not _ODD_BLANKS.search(text):
        yield text.split(" ")
        return
    text, at = " " + text, 0
    while len(text) - at > PIECE:
        cut = _CUT.search(text, at + PIECE)
        if not cut:
            break
        yield [c[1:] for c in _CHUNK.findall(text[at : cut.start()])]
        at = cut.start()
    yield [c[1:] for c in _CHUNK.findall(text[at:])]


class Tokenizers:
    """The two tokenizers and the bytes of their entries."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=model)
        letters = byte_level_alphabet()
        added = {t["id"]: t["content"].encode() for t in json.loads(definition).get("added_tokens", [])}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = added[i] if i in added else bytes(letters[c] for c in token)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            one = self.b.is_byte(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if one else piece.replace(_BLOCK, " ").encode())
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        steps = json.loads(definition).get("pre_tokenizer") or {}
        # chunks need A's usual pattern and no piece of B with a blank behind another character
        self.cuts = steps.get("type") == "ByteLevel" and bool(steps.get("use_regex", True)) and not steps.get("add_prefix_space")
        self.cuts = self.cuts and not any(re.search(f"[^{_BLOCK}]{_BLOCK}", self.b.id_to_piece(i)) for i in range(len(self.b_bytes)))
        whole = f"a{_PLAIN}  b \n c"
        self.plain_is_kept = self.cuts and all(self.joined_b(x) == " " + x for x in (whole, whole[::-1]))

    def joined_b(self, text: str) -> str:
        return b"".join(self.b_bytes[i] for i in self.b.encode(text)).decode("utf-8", "replace")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The A ids of each text behind a blank, the B ids of each text (which adds the blank)."""
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(texts, num_threads=1)

    def keeps(self, a: list[int], b: list[int], raw: bytes) -> bool:
        """Both sides' bytes are ``raw``."""
        return b"".join([self.a_bytes[i] for i in a]) == raw and b"".join([self.b_bytes[i] for i in b]) == raw


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and B token, numbered from the left; both sides cover the same bytes, without empty tokens."""
    n_a, n_b = len(a_ends), len(b_ends)
    a_starts, b_starts = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    last_a = np.searchsorted(a_starts, b_ends, "left") - 1  # the last A token that begins before the B token's end
    last_b = np.searchsorted(b_starts, a_ends, "left") - 1
    own = np.arange(n_a, n_a + n_b)
    terminal = a_ends[last_a] == b_ends
    successor = np.concatenate([last_b + n_a, np.where(terminal, own, last_a)])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    number = np.cumsum(terminal) - 1
    label = number[successor - n_a]
    return label[:n_a], label[n_a:]


class Aligned:
    """Chunks aligned so far: numbers of tokens, groups, links; group texts; linked id pairs (a << 32 | b)."""

    def __init__(self, tools: Tokenizers, scores: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.tools, self.scores = tools, scores
        size = max(len(tools.a_bytes), len(tools.b_bytes))
        self.texts = np.array([f"{i}{s}" for s in ",|;" for i in range(size)], object)
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 6), np.int64)  # n_a, n_b, n_groups, n_links, n_best, count_sum
        self.first = np.zeros(1, np.int64)  # of a chunk's pairs
        self.pairs = np.zeros(0, np.int64)
        self.rare = np.zeros(0, bool)  # of the pairs that aren't in the scores
        self.has_rare = np.zeros(0, bool)  # of the chunks with such pairs
        self.n, self.n_pairs = 0, 0
        self.unequal: set[int] = set()

    def ids(self, chunks: list[str]) -> np.ndarray:
        """The index of each chunk; new ones are aligned."""
        if missing := [*set(chunks).difference(self.index)]:
            for i in range(0, len(missing), 1 << 15):
                self._add(missing[i : i + (1 << 15)])
        return self.known(chunks)

    def known(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def make_room(self) -> None:
        """Called between texts: forgets all if there is too much."""
        if len(self.index) > KEPT_CHUNKS or self.n_pairs > 16 * KEPT_CHUNKS:
            self.clear()

    def _add(self, chunks: list[str]) -> None:
        """Aligns new chunks: those that neither begin nor end with white space in texts of 64, others one by one. Where a
        text isn't kept by both sides, its chunks are looked at one by one."""
        regular = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        rest = [[c] for c in (set(chunks).difference(regular) if len(regular) < len(chunks) else ())]
        groups = [regular[i : i + 64] for i in range(0, len(regular), 64)] + rest
        texts = [" ".join(g) for g in groups]
        a, b = self.tools.encode(texts)
        flat = [*itertools.chain.from_iterable(a)], [*itertools.chain.from_iterable(b)]
        if not self.tools.keeps(*flat, "".join([" " + t for t in texts]).encode()):
            good = [self.tools.keeps(x, y, f" {t}".encode()) for x, y, t in zip(a, b, texts, strict=True)]
            bad = [g for g, ok in zip(groups, good, strict=True) if not ok]
            for c in (g[0] for g in bad if len(g) == 1):
                self.unequal.add(self.n)
                self._keep([c], [""], np.zeros((1, 6), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
            for g in bad:
                for c in g if len(g) > 1 else ():
                    self._add([c])
            groups = [g for g, ok in zip(groups, good, strict=True) if ok]
            flat = [[i for x, ok in zip(side, good, strict=True) if ok for i in x] for side in (a, b)]
        order = [*itertools.chain.from_iterable(groups)]
        if order:
            lengths = np.fromiter((len(c) if c.isascii() else len(c.encode()) for c in order), np.int64, len(order)) + 1
            self._align(order, np.cumsum(lengths), *(np.array(x, np.int64) for x in flat))

    def _align(self, chunks: list[str], ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        a_ends, b_ends = np.cumsum(self.tools.a_length[a]), np.cumsum(self.tools.b_length[b])
        a_group, b_group = groups_of(a_ends, b_ends)
        bounds = np.union1d(a_ends, b_ends)  # between two bounds lies one link
        pairs = a[np.searchsorted(a_ends, bounds)] << 32 | b[np.searchsorted(b_ends, bounds)]
        a_to, b_to, to = (np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, bounds))
        if not (np.array_equal(a_ends[a_to - 1], ends) and np.array_equal(b_ends[b_to - 1], ends)):
            raise ValueError("a token reaches over a chunk's end")
        side = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(side, kind="stable")
        side, ids = side[order], np.concatenate([a, b])[order]
        step = np.concatenate([np.diff(side), [1]])  # to the next token: same side, from A to B, to the next group
        mark = np.where(step == 0, 0, np.where(side % 2 == 0, 1, 2))
        parts = self.texts[mark * self.size + ids].tolist()
        both = (a_to + b_to).tolist()
        groups = ["".join(parts[x:y])[:-1] for x, y in zip([0, *both[:-1]], both, strict=True)]
        numbers = np.zeros((len(chunks), 6), np.int64)
        numbers[:, 0], numbers[:, 1] = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        numbers[:, 2] = np.diff(b_group[b_to - 1] + 1, prepend=0)
        numbers[:, 3] = np.diff(to, prepend=0)
        self._keep(chunks, groups, numbers, pairs, to)

    def _keep(self, chunks: list[str], groups: list[str], numbers: np.ndarray, pairs: np.ndarray, to: np.ndarray) -> None:
        n, m = len(chunks), len(pairs)
        rare = np.zeros(m, bool)
        if self.scores is not None and m:
            hot, counts, best = self.scores
            at = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
            known = hot[at] == pairs if len(hot) else np.zeros(m, bool)
            rare = ~known
            for k, value in ((4, best), (5, counts)):
                sums = np.concatenate([[0], np.cumsum(np.where(known, value[at] if len(hot) else 0, 0))])
                numbers[:, k] = sums[to] - sums[np.concatenate([[0], to[:-1]])]
        self.numbers = _put(self.numbers, self.n, numbers)
        self.first = _put(self.first, self.n + 1, to + self.n_pairs)
        self.pairs = _put(self.pairs, self.n_pairs, pairs)
        self.rare = _put(self.rare, self.n_pairs, rare)
        upto = np.concatenate([[0], np.cumsum(rare)])
        self.has_rare = _put(self.has_rare, self.n, upto[to] > upto[np.concatenate([[0], to[:-1]])])
        self.groups += groups
        self.index.update(zip(chunks, range(self.n, self.n + n), strict=True))
        self.n, self.n_pairs = self.n + n, self.n_pairs + m

    def pairs_of(self, ids: np.ndarray, weights: np.ndarray, rare_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The id pairs of chunks, each with its weight, summed up by pair."""
        lengths = self.first[ids + 1] - self.first[ids]
        places = np.repeat(self.first[ids] - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        n = np.repeat(weights, lengths)
        if rare_only:
            places, n = places[self.rare[places]], n[self.rare[places]]
        found, inverse = np.unique(self.pairs[places], return_inverse=True)
        return found, np.bincount(inverse, n, len(found)).astype(np.int64)


def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """``array`` with ``values`` from ``at`` on; it grows by doubling."""
    if at + len(values) > len(array):
        grown = np.zeros((max(2 * len(array), at + len(values)), *array.shape[1:]), array.dtype)
        grown[:at] = array[:at]
        array = grown
    array[at : at + len(values)] = values
    return array


class Reader:
    """What a worker keeps between tasks: the tokenizers, and the chunks aligned for a query's pass."""

    tools: tuple[str, Tokenizers] | None = None
    aligned: tuple[str, Aligned] | None = None

    @classmethod
    def of(cls, key: str, definition: str, model: bytes, scores=None) -> Aligned:
        files = hashlib.sha256(definition.encode() + model).hexdigest()
        if cls.tools is None or cls.tools[0] != files:
            cls.tools = (files, Tokenizers(definition, model))
        if cls.aligned is None or cls.aligned[0] != key + files:
            cls.aligned = (key + files, Aligned(cls.tools[1], scores))
        return cls.aligned[1]


def read_texts(aligned: Aligned, texts: list[str]) -> Iterator[list[np.ndarray]]:
    """For each text the indices of its chunks, in pieces; none if it is empty or not kept by both tokenizers. If any chunk
    isn't kept, the whole text is looked at as one chunk. The new chunks of many texts are aligned together; indices hold
    until the next text is asked for."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= 4 * PIECE):
            size += len(texts[end])
            end += 1
        group, at = texts[at:end], end
        aligned.make_room()
        cut = [[*chunks_of(t)] if aligned.tools.cuts else [[t]] for t in group] if len(group) > 1 else []
        if cut:
            aligned.ids([c for lists in cut for chunks in lists for c in chunks])
        for k, text in enumerate(group):
            lists = cut[k] if cut else chunks_of(text) if aligned.tools.cuts else [[text]]
            found = [aligned.known(c) if cut else aligned.ids(c) for c in lists] if text else []
            if aligned.unequal and any(not aligned.unequal.isdisjoint(x.tolist()) for x in found):
                found = [aligned.ids([text])]
                if not aligned.unequal.isdisjoint(found[0].tolist()):
                    found = []
            yield found


def count_chunks(docs: DataFrame, text_col: str, shared) -> DataFrame:
    """(chunk, n): the chunks of all texts that both tokenizers keep. Where the tokenizers keep Latin characters as they
    are (tried out when they are loaded), only texts with other characters are encoded to see that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = Reader.of("chunks", *shared.value)
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())], names=["chunk", "n"])

        for b in small_batches(batches, 4 << 20):
            other = []
            for text in column_texts(b.column(0)):
                if aligned.tools.plain_is_kept and not _NOT_PLAIN.search(text):
                    for chunks in chunks_of(text) if text else ():
                        counts.update(chunks)
                else:
                    other.append(text)
            for text, found in zip(other, read_texts(aligned, other), strict=True):
                if found:
                    whole = not aligned.tools.cuts or len(found) == 1 and len(found[0]) == 1
                    for chunks in [[text]] if whole else chunks_of(text):
                        counts.update(chunks)
            if len(counts) > COUNTED_CHUNKS:
                yield out()
                counts.clear()
        if counts:
            yield out()

    found = docs.select(text_col).mapInArrow(run, "chunk string, n long")
    return found.groupBy("chunk").agg(F.sum("n").alias("n"))


def count_pairs(chunks: DataFrame, shared) -> DataFrame:
    """(pair, n): how many links of the counted chunks hold the id pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = Aligned(Reader.of("chunks", *shared.value).tools)
        for b in small_batches(batches, 1 << 20):
            aligned.clear()
            ids = aligned.ids(b.column(0).to_pylist())
            pairs, n = aligned.pairs_of(ids, b.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    return chunks.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def scored_pairs(pairs: DataFrame) -> DataFrame:
    """(pair, n, best, level): ``best`` if no pair of the same B id has a larger n; ``level``, n on a scale of 16 steps a
    doubling."""
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    top = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("top"))
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    joined = pairs.join(top, b == F.col("b"))
    return joined.select("pair", "n", (F.col("n") == F.col("top")).alias("best"), level.alias("level"))


def align_tokenizers(
    docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS, with_groups: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and,
    ``with_groups``, groups (``a1,a2|b1;a3|b2,b3``).

    A is a byte-level tokenizer of the tokenizers library (blank + text), B a sentencepiece model (which adds the blank).
    Texts that are null, empty or not kept byte by byte by both have no tokens: zeros and ''. Null ids and repeated rows
    stay; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    with open(a_file, encoding="utf-8") as f:
        definition = f.read(MAX_FILE_BYTES + 1)
    with open(b_file, "rb") as f:
        model = f.read(MAX_FILE_BYTES + 1)
    if max(len(definition), len(model)) > MAX_FILE_BYTES:
        raise ValueError(f"a tokenizer file has more than {MAX_FILE_BYTES} bytes")
    share_code(spark)
    shared = spark.sparkContext.broadcast((definition, model))
    counted = written(count_pairs(count_chunks(docs, text_col, shared), shared), "pairs")
    pairs = written(scored_pairs(counted), "scored_pairs")

    # the levels are a few hundred at most; the most frequent ones are taken whole as long as they fit
    levels = pairs.groupBy("level").count().orderBy(F.desc("level")).collect()
    total, least = 0, 1 << 30
    for r in levels:
        total += r["count"]
        if total > hot_pairs:
            break
        least = r["level"]
    table = pairs.where(F.col("level") >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    hot = spark.sparkContext.broadcast((uuid.uuid4().hex, *(table.column(c).to_numpy() for c in ("pair", "n", "best"))))
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "pairs", "counts"]
    schema = f"doc_id {id_type}, row long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, pairs array<long>, counts array<long>"
    schema += ", groups string" * with_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, *scores = hot.value
        aligned = Reader.of(key, *shared.value, scores)
        row = TaskContext.get().partitionId() << 36
        for b in small_batches(batches, 4 << 20):
            rows, digests, rest, groups = np.zeros((b.num_rows, 7), np.int64), [], ([], []), []
            for i, lists in enumerate(read_texts(aligned, [*column_texts(b.column(1))])):
                rows[i, 0], row = row, row + 1
                digest, kept, rare = hashlib.sha256(), [], []
                for k, ids in enumerate(lists):
                    part = ";" * bool(k) + ";".join([aligned.groups[j] for j in ids.tolist()])
                    digest.update(part.encode())
                    kept += [part] * with_groups
                    rows[i, 1:] += aligned.numbers[ids].sum(0)
                    rare.append(ids[aligned.has_rare[ids]])
                others = np.concatenate([np.zeros(0, np.int64), *rare])
                pairs, n = aligned.pairs_of(others, np.ones(len(others), np.int64), True) if len(others) else ((), ())
                rest[0].append(pairs)
                rest[1].append(n)
                digests.append(digest.hexdigest() if lists else "")
                groups.append("".join(kept))
            arrays = [b.column(0), *(pa.array(rows[:, k]) for k in range(7)), pa.array(digests, pa.string())]
            arrays += [pa.array(x, pa.list_(pa.int64())) for x in rest]
            if with_groups:
                arrays.append(pa.array(groups, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=names + ["groups"] * with_groups)

    found = written(docs.select(id_col, text_col).mapInArrow(run, schema), "aligned")
    links = found.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("row", "p.pairs", "p.counts")
    others = pairs.where(F.col("level") < least).select(F.col("pair").alias("pairs"), "n", "best")
    more = links.join(others, "pairs").groupBy("row").agg(
        F.sum(F.col("counts") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("counts") * F.col("n")).alias("more_sum")
    )
    out = found.drop("pairs", "counts").join(more, "row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256", *["groups"] * with_groups,
    )
