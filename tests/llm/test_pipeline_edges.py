"""The pipeline on awkward tables: nulls in any column, empty and long texts, repeated rows, clashing columns, no rows."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, root string, tid long, row long, sig string"
WORDS = {"en": "the house is near a river and we walk there with our dog every day".split(), "fr": "la maison est dans une rue que nous aimons avec le chien et des fleurs".split()}


def sentence(lang, seed, n=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", str(rng.randrange(100))]) for _ in range(n))


@pytest.fixture()
def tables(spark, tmpdir_path):
    def write(rows):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmpdir_path}/documents.parquet")
        items = [(1, sentence("en", "item", 12)), (2, None), (None, ""), (3, "only three words")]
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
        return tmpdir_path

    return write


def test_awkward_rows(spark, tables):
    def row(doc_id, text, lang=None):
        return (doc_id, text, lang, None, None, 1, "x", 2, None, "y")

    rows = [row(i, sentence(lang, i), lang) for i, lang in enumerate(["en", "fr"] * 20)]
    kept = {r[0] for r in rows}
    rows += [rows[4], rows[5], rows[5]]  # repeated rows: one of each stays
    rows.append(row(100, sentence("en", 7 - 1), "en"))  # the text of 6 again: the largest id stays
    kept = kept - {6} | {100}
    near = sentence("fr", 9).split()
    rows.append(row(101, " ".join([*near, "encore"])))  # nearly 9: the smallest id stays
    rows.append(row(102, f"{sentence('en', 'x')} {sentence('en', 'item', 12)} {sentence('en', 'y')}"))  # holds a benchmark item
    rows += [row(103, None), row(104, ""), row(105, "12 34 ..."), row(None, None)]  # no language
    rows.append(row(106, sentence("fr", "long", 60_000)))
    rows.append(row(None, sentence("en", "no id")))
    got = corpus_pipeline.run(spark, tables(rows)).collect()
    assert sorted((r["doc_id"] for r in got), key=lambda d: (d is None, d)) == [*sorted(kept | {106}), None]
    ranks = {}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    of = {r[0]: r[1] for r in rows}
    assert all(list(r["ids"]) == library.encode_ordinary(of[r["doc_id"]] or sentence("en", "no id")) for r in got if r["doc_id"] != 106)


def test_every_stage_keeps_the_columns_and_takes_no_rows(spark, tables):
    path = tables([])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        assert out.collect() == []
        if name != "tokens":
            assert out.columns == docs.columns
    assert corpus_pipeline.run(spark, path).collect() == []


def test_stages_by_themselves(spark, tables):
    """Each stage is judged on its own input: rows that no earlier stage has seen."""
    rows = [(i, t, None, None, None, 1, None, 2, 3, None) for i, t in enumerate([None, "", "same words here", "same words here", sentence("en", 1), None])]
    path = tables(rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    of = {name: stage for name, stage in corpus_pipeline.STAGES}
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(of["exact"](spark, docs, path)) == [3, 4, 5]  # null counts as empty
    assert ids(of["benchmark"](spark, docs, path)) == [0, 1, 2, 3, 4, 5]
    assert {3, 2} & set(ids(of["near"](spark, docs, path))) == {2}
    assert ids(of["tokens"](spark, docs, path)) == [0, 1, 2, 3, 4, 5]
    assert docs.where(F.col("lang").isNotNull()).isEmpty() and ids(of["language"](spark, docs, path)) in ([], [2, 3, 4])
