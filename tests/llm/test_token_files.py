"""op13: Elias-Fano sequences, shards, and the query against the tokenizers library text by text."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricelake.llm import token_files as T
from pricelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def expected(docs, library):
    out, start = [], 0
    for doc_id, text in docs:
        ids = np.array([*library(text), 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [5, 5, 9, 9, 2**62], list(range(1000)), [3 * i * i for i in range(3000)], [0] * 600 + [10**6]])
def test_elias_fano(values):
    ef = T.EliasFano.of(np.array(values, np.uint64))
    data = b"xy" + ef.to_bytes() + b"z"
    back, end = T.EliasFano.read(data, 2)
    assert end == len(data) - 1
    assert back.values().tolist() == values
    assert [back.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        back.select(len(values))


def test_elias_fano_is_small():
    n = 100_000
    bounds = np.cumsum(np.random.default_rng(1).integers(1, 800, n))
    assert len(T.EliasFano.of(bounds).to_bytes()) * 8 / n < 2 + np.log2(bounds[-1] / n) + 0.5  # 64 in a plain table


def test_shard_round_trip():
    docs = [(None, [4]), (-5, []), (3, [70, 2]), (3, [1, 2, 3]), (2**60, [9])]
    data = T.pack_shard(6, 7, [d for d, _ in docs], [np.array(x, "<u2").tobytes() for _, x in docs], 2)
    s = T.Shard(data + b"\n")
    assert (s.part, s.shard, s.doc_ids()) == (6, 7, [d for d, _ in docs])
    assert [s.tokens(i).tolist() for i in range(5)] == [x for _, x in docs]
    with pytest.raises(ValueError):
        T.Shard(b"x" * 100)


def test_encoder_equals_library(library):
    enc = T.Encoder(open(FILE, encoding="utf-8").read())
    assert enc.drops_blanks
    rng = random.Random(3)
    parts = ["The", "word.", "don't", "'s", "Été", "é", "ΣΣ", "İx", "12", "a1b2", " ", "  ", "\n", "\t", "\x1c", " ", "　", "<|endoftext|>", "</w>", "中文", "\U0001f600", "́", "(\"Hi!\")", "...", "\x00", "_", "x" * 80, "'", "µß", "ẛ̣"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(30))) for _ in range(1500)]
    got = [np.frombuffer(x, f"<u{enc.width}").tolist() for x in enc.encode(texts)]
    assert got == [library(t) for t in texts]
    long = "some Words, and-more " * 150_000
    assert np.frombuffer(enc.encode([long])[0], f"<u{enc.width}").tolist() == library(long)


def test_query(spark, library):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    got = QUERIES["op13_token_files"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(docs, library)


def test_edges(spark, library):
    schema = "doc_id long, text string, part long, shard string, start long"
    rows = [(4, "b a", 1, "x", 2), (None, "null id", 1, "x", 2), (4, "b a", 1, "x", 2), (1, None, 1, "x", 2), (2, "", None, None, None), (-3, "y " * 50_000, 0, "", 0)]
    rows += [(9, "many copies", 0, "", 0)] * 700
    got = sorted(map(tuple, T.token_file_round_trip(spark.createDataFrame(rows, schema).repartition(5), FILE, 2).collect()), key=lambda r: r[1])
    assert got == expected(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0])), library)
    assert T.token_file_round_trip(spark.createDataFrame([], schema), FILE, 2).collect() == []


def test_shards_and_ids(spark, library, tmpdir_path):
    docs = [(i, f"document number {i} with some words") for i in range(300)]
    path = f"{tmpdir_path}/tokens"
    T.write_token_files(spark.createDataFrame(docs, "k long, t string"), path, FILE, 2, "k", "t", shard_tokens=100)
    got = T.with_starts(T.read_documents(spark, path, with_ids=True)).orderBy("start").collect()
    assert len({(r["part"], r["shard"]) for r in got}) > 20
    assert [(r["doc_id"], r["ids"]) for r in got] == [(k, [*library(t), 2]) for k, t in docs]


def test_other_tokenizers(spark, tmpdir_path):
    file = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(file)
    docs = [(1, "two  blanks\n\nkept"), (2, "")]
    T.write_token_files(spark.createDataFrame(docs, "doc_id long, text string"), f"{tmpdir_path}/t", file)
    got = {r["doc_id"]: r["ids"] for r in T.read_documents(spark, f"{tmpdir_path}/t", with_ids=True).collect()}
    assert got == {k: t.encode(x, add_special_tokens=False).ids for k, x in docs}
