"""op11: counts, near words, forms and roots against brute force by wildcard keys."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from pricelake.llm import spelling as S
from pricelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(docs, drop_every=97, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near, holes = defaultdict(set), defaultdict(list)
    for w in counts:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1 :]].append(w)
            if (s := w[:i] + w[i + 1 :]) in counts:
                near[w].add(s)
                near[s].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 2 * n:
                form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), counts[form[w]] if w in form else None, root))
    return sorted(out)


def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = QUERIES["op11_spelling"](spark, SF)
    assert set(got.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
    got = sorted(map(tuple, got.collect()))
    assert got == brute(docs)
    assert sum(r[3] is not None for r in got) > 20


SCHEMA = "doc_id long, text string, word string, n long, h long"


@pytest.mark.parametrize("filter_bytes", [S.FILTER_BYTES, 256])
def test_neighbours(spark, filter_bytes):
    """Words of few letters and all lengths; a small bound makes several parts."""
    rng = random.Random(4)
    texts = []
    for _ in range(2500):
        w = "".join(rng.choice("abàÿ×") for _ in range(rng.choice([4, 5, 5, 6, 7, 8])))
        texts.append(" ".join([w] * rng.choice([1, 3, 3, 4, 7, 9, 20, 41])))
    long = "".join(rng.choice("abc") for _ in range(700))
    texts += [f"{x}. {x}, {x}!" for x in (long, long[:300] + long[301:], long[:699], long[:5] + "z" + long[6:], "q" * 30, "q" * 31, "q" * 32)]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)]
    got = S.spelling_variants(spark.createDataFrame(rows, SCHEMA).repartition(4), drop_every=97, filter_bytes=filter_bytes)
    assert sorted(map(tuple, got.collect())) == brute([r[:2] for r in rows])


def test_edges(spark):
    rows = [(1, None, None, None, None), (2, "", "", 0, 0), (None, "WORDS Words words wordy", "", 0, 0), (3, "ÉTUDE Étude Étude étude", "", 0, 0)]
    rows += [(4, "words’s 中words中 āwords", "", 0, 0)] * 3 + [(5, "repeat repeta " * 20_000, "", 0, 0), (6, " ".join(["y" * 2000] * 3), "", 0, 0)]
    got = S.spelling_variants(spark.createDataFrame(rows, SCHEMA), drop_every=97)
    assert sorted(map(tuple, got.collect())) == brute([r[:2] for r in rows])
    assert S.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    long = [(i, w * 3, "", 0, 0) for i, w in enumerate(["y" * 300_000 + " ", "y" * 299_999 + " ", "y" * 299_999 + "z" + " "])]
    got = S.spelling_variants(spark.createDataFrame(long, SCHEMA)).collect()
    assert sorted((len(r["word"]), r["n_near"], r["form"]) for r in got) == [(299_999, 2, None), (300_000, 2, None), (300_000, 2, None)]


def test_keys_of_edits():
    words = ["letter", "lettre", "little"]
    everything = S.Filters(np.concatenate([[0], np.cumsum(np.ones(S.SHARDS, np.int64))]), np.full(S.SHARDS, 2**64 - 1, np.uint64))
    got = {(words[i], p, c): k for block in S.edits(words, everything) for i, p, c, k in zip(*block, strict=True)}
    for (w, p, c), key in got.items():
        assert S.word_keys([w[:p] + (chr(c) if c else "") + w[p + 1 :]])[0] == key
    assert len([k for k in got if k[2] == 0]) == 5 + 5 + 5  # a pair of equal letters has one deletion
    assert len([k for k in got if k[2] and k[0] == "letter"]) == sum(c > ord(x) for x in "letter" for c in S.ALPHABET)


def test_long_chains_of_forms(spark):
    chain = [("w" * i, "w" * (i + 1)) for i in range(5, 45)]
    forms = spark.createDataFrame([*chain, ("w" * 45, None), ("alone", None)], "word string, form string")
    assert {tuple(r) for r in S.roots_of(forms).collect()} == {(a, "w" * 45) for a, _ in chain}
