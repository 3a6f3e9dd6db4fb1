"""op12: groups and links against plain interval overlaps of whole-text encodings."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pricelake.llm import alignment as A
from pricelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Whole texts, token by token."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
        self.a.encode_special_tokens = True
        self.letters = A.byte_level_alphabet()

    def tokens(self, text):
        whole = (" " + text).encode()
        got = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.letters[c] for c in t)) for i, t in zip(got.ids, got.tokens, strict=True)]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        if any(b"".join(x for _, x in side) != whole for side in (a, b)):
            return [], []
        return a, b

    @staticmethod
    def spans(side):
        end = 0
        for i, x in side:
            yield i, end, end + len(x)
            end += len(x)

    def aligned(self, text):
        """(a, b, groups, links)"""
        a, b = ([*self.spans(s)] for s in (self.tokens(text) if text else ([], [])))
        links = [(i, j) for i, s, e in a for j, x, y in b if s < y and x < e] if len(a) < 3000 else None
        if links is None:  # the same by merging
            links, k = [], 0
            for i, s, e in a:
                while b[k][2] <= s:
                    k += 1
                m = k
                while m < len(b) and b[m][1] < e:
                    links.append((i, b[m][0]))
                    m += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, ka, kb = [], 0, 0
        for c in cuts:
            own = [], []
            while ka < len(a) and a[ka][2] <= c:
                own[0].append(str(a[ka][0]))
                ka += 1
            while kb < len(b) and b[kb][2] <= c:
                own[1].append(str(b[kb][0]))
                kb += 1
            groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
        return len(a), len(b), groups, links

    def rows(self, docs):
        found = [(d, *self.aligned(t)) for d, t in docs]
        counts = Counter(x for *_, links in found for x in links)
        best = defaultdict(int)
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        out = []
        for d, n_a, n_b, groups, links in found:
            n_best = sum(counts[x] == best[x[1]] for x in links)
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
            out.append((d, n_a, n_b, len(groups), len(links), n_best, sum(counts[x] for x in links), sha))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


PARTS = ["The", "word.", "don't", " 's", "Été", "é", "naïve", "Σ", "12", "a1b2", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\xa0", "　", "<|endoftext|>", "<s>", "</s>", "<0x41>", "中文", "\U0001f600", "́", "(\"Hi!\")", "...", "_", "x" * 80, "'", "ſ", "\x7f", "￼"]


def texts(n, seed, parts=PARTS):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_chunks_give_the_whole_texts_tokens(plain):
    tools = A.Tokenizers(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())
    assert tools.cuts and tools.plain_is_kept
    for t in texts(1500, 5):
        if not t:
            continue
        chunks = [c for part in A.chunks_of(t) for c in part]
        assert " ".join(chunks) == t
        assert [i for x in tools.encode(chunks)[0] for i in x] == plain.a.encode(" " + t, add_special_tokens=False).ids
        assert [i for x in tools.encode(chunks)[1] for i in x] == plain.b.encode(t)


def test_long_text_in_pieces(monkeypatch):
    t = "some words,  and\n more " * 40
    whole = [c for x in A.chunks_of(t) for c in x]
    monkeypatch.setattr(A, "PIECE", 50)
    lists = [*A.chunks_of(t)]
    assert len(lists) > 10
    assert [c for x in lists for c in x] == whole
    assert [c for x in A.chunks_of("plain words " * 30 + "end") for c in x] == ["plain", "words"] * 30 + ["end"]


def test_groups_by_doubling():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 10, 200):
        ends = [np.array(sorted({*rng.choice(np.arange(1, 2 * n), n - 1, replace=False).tolist(), 2 * n})) for _ in range(2)]
        a, b = A.groups_of(*ends)
        common = np.intersect1d(*ends)
        assert a.tolist() == np.searchsorted(common, ends[0]).tolist()
        assert b.tolist() == np.searchsorted(common, ends[1]).tolist()


def test_query(spark, plain):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = QUERIES["op12_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain.rows(docs))


@pytest.mark.parametrize("hot", [0, 50, 10**6])
def test_edges(spark, plain, hot):
    rows = [(i, t, i, "x") for i, t in enumerate(texts(150, 9, [*PARTS, "▁", "a▁b", "\x00"]))]
    rows += [(7, "the same words", 0, None), (7, "the same words", 0, None), (None, "no id", 1, ""), (900, None, 1, ""), (901, "", 1, ""), (902, "▁", 1, ""), (903, " ", 1, "")]
    rows += [(904, "a long text with words  and blanks\n" * 3000, 1, ""), (905, "y" * 20_000, 1, "")]
    schema = "doc_id long, text string, row long, pairs string"
    got = A.align_tokenizers(spark.createDataFrame(rows, schema).repartition(3), *FILES, hot_pairs=hot).collect()
    by_id = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=by_id) == sorted(plain.rows([r[:2] for r in rows]), key=by_id)
    assert A.align_tokenizers(spark.createDataFrame([], schema), *FILES).collect() == []


def test_groups_as_text(spark, plain):
    got = A.align_tokenizers(spark.createDataFrame([(1, "Naïve tokenizers disagree.")], "k long, t string"), *FILES, "k", "t", with_groups=True).first()
    assert got["groups"] == ";".join(plain.aligned("Naïve tokenizers disagree.")[2])
    assert hashlib.sha256(got["groups"].encode()).hexdigest() == got["groups_sha256"]
