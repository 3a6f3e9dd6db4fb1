"""The registered queries on small whole tables against brute force, an independent library or held-out labels."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from pricelake.llm import langid, licenses, passages, warc
from pricelake.llm.common import shingle_hashes, word_hashes, words
from pricelake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def rows(spark):
    found = {}

    def of(name):
        if name not in found:
            found[name] = QUERIES[name](spark, SF).collect()
        return found[name]

    return of


def shingles(text, size=5):
    w = WORD.findall(lower(text))
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def similar_pairs(texts):
    sets, inverted, common = [shingles(t) for t in texts], defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    for own in inverted.values():
        common.update((a, b) for k, b in enumerate(own) for a in own[:k])
    return [p for p, n in common.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]


def classes(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def test_oracles(spark, rows):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for name, sql in ORACLE.items():
        res = con.execute(sql)
        columns = [d[0] for d in res.description]
        assert Counter(tuple(r[c] for c in columns) for r in rows(name)) == Counter(res.fetchall())


def test_words_and_hashes():
    text = "Ab-c 1é日 x\n\tAB" + " z" * 50
    assert words(text.encode()) == [w.encode() for w in WORD.findall(lower(text))]
    h = word_hashes(text.encode())
    assert h[0] == h[4] and len(set(h.tolist())) == len(set(words(text.encode())))
    assert (word_hashes(text.encode(), chunk=7) == h).all()
    assert len(shingle_hashes(h[:3])) == 1 and len(shingle_hashes(h)) == len(h) - 4 and not len(shingle_hashes(h[:0]))


def test_language_on_held_out_rows(rows, docs):
    lang = {d: x for d, _, x in docs}
    held = [r for r in rows("op1_language") if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows("op1_language"))
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert len(rows("op1_language")) == len(docs)


def test_elastic_net_makes_weights_zero():
    rng = np.random.default_rng(0)
    xs = [(np.sort(rng.choice(50, 5, False)), np.full(5, 0.4)) for _ in range(300)]
    ys = np.array([int((at < 5).any()) for at, _ in xs])
    w, b = langid.ftrl(xs, ys, 2, 5, 0.5, 1.0, 1.0, 0.1)
    assert (w[50:] == 0).all() and (w[:50] == 0).any() and np.abs(w[:5]).mean() > 3 * np.abs(w[5:50]).mean()
    logits = np.array([x @ w[at] + b for at, x in xs])
    ys = np.where(rng.random(300) < 0.2, 1 - ys, ys)
    hot = langid.fit_temperature(logits * 10, ys)
    assert hot == pytest.approx(10 * langid.fit_temperature(logits, ys), rel=0.05)


def test_toxicity_on_held_out_rows(rows):
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    held = [r for r in rows("op3_toxicity") if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows("op3_toxicity"))


def test_toxicity_folding_and_exceptions():
    from pricelake.llm.toxicity import Lexicon, folded

    assert folded("You 1D10T, clоwns m² l0$er café") == " you idiot clowns m2 loser cafe "
    lexicon = Lexicon({" clow": 5.0, " idiot ": 6.0}, ("clown fish",), (-3.0, 2.0, 0.5))
    assert lexicon.score("a clown fish swims") == lexicon.score("") < 0.1 < 0.5 < lexicon.score("what a cl0wn")
    assert lexicon.score("an idiot " + "and more words " * 2000) < lexicon.score("an idiot")


def test_many_exceptions_and_long_words():
    from pricelake.llm.toxicity import Lexicon, folded, terms

    lexicon = Lexicon({" idiot ": 2.0}, ("idiot proof", "clown fish"))
    began = time.process_time()
    assert lexicon.matches(folded("idiot proof clown fish " * 40_000)) == []
    assert len(lexicon.matches(folded("idiot proof idiot clown fish " * 40_000))) == 40_000
    assert time.process_time() - began < 20
    assert f" {'z' * 60} " in terms(folded("z" * 60))


def test_compact_windows_are_the_cartesian_tree():
    tokens = np.random.default_rng(1).integers(0, 2**60, 700).astype(np.uint64)
    tokens[100:130] = tokens[100]
    bounds = np.array([0, 300, 300, 330, 700])
    got = passages.compact_windows(tokens, bounds, 20, passages._SEEDS[0])
    key = passages.packed(tokens, passages._SEEDS[0])
    want = []

    def split(low, high):
        if high - low >= 20:
            c = low + int(key[low:high].argmin())
            want.append((low, c, high - 1))
            split(low, c)
            split(c + 1, high)

    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        split(int(low), int(high))
    assert sorted(map(tuple, got.T.tolist())) == sorted(want)


@pytest.mark.parametrize(("n", "edits"), [(50, (25,)), (50, ()), (96, (31, 63)), (120, (40,))])
@pytest.mark.parametrize("at", [0, 200])
def test_passages_at_exactly_the_similarity(n, edits, at):
    rng = np.random.default_rng(n + at)
    own, other, shared = (rng.integers(0, 1 << 62, k) for k in (300, 300, n))
    a, b = np.concatenate([own[:100], shared, own[100:]]), np.concatenate([other[:at], shared, other[at:]])
    for i in edits:
        a[100 + i] = -i
    tokens = [np.array([hash(tuple(t[i : i + 5])) for i in range(len(t) - 4)]) for t in (a.tolist(), b.tolist())]
    shift, l, r = np.array([100 - at]), np.array([100]), np.array([100 + n - 5])
    want = [(100, 100 + n - 5, at, at + n - 5)]
    assert passages.verify(*tokens, shift, l, r, 46, 0.8) == want
    back = passages.verify(*tokens[::-1], -shift, l - 100 + at, r - 100 + at, 46, 0.8)
    assert back == [(x, y, p, q) for p, q, x, y in want]


@pytest.mark.parametrize("edited", [False, True])
def test_passages_with_a_frequent_line(spark, edited):
    rng = np.random.default_rng(5)

    def some(n):
        return [f"w{x}" for x in rng.integers(0, 10**9, n)]

    texts, want = [], {}
    for _ in range(30):
        line, before, after = some(30), some(15), some(15)
        for k in range(2):
            lead, end = some(40), list(after)
            if edited and k:
                end[8] = "other"
            want[len(texts)] = set(range(40, 100))
            texts.append(lead + before + line + end + some(40))
        texts += [some(40) + line + some(40) for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = passages.repeated_passages(docs).collect()
    spans = {r.doc_id: {i for s in r.spans.split(",") if s for i in range(int(s.split(":")[0]), int(s.split(":")[1]))} for r in got}
    assert [i for i, s in spans.items() if s != want.get(i, set())] == []
    assert all(r.n_links == (r.doc_id in want) for r in got)


def test_repeated_passages(rows, docs):
    seen, of = defaultdict(set), {r.doc_id: r for r in rows("op4_passages")}
    for d, t, _ in docs:
        w = WORD.findall(lower(t))
        for i in range(len(w) - 49):
            seen[hash(tuple(w[i : i + 50]))].add((d, i))
    covered = defaultdict(set)
    for own in seen.values():
        if len({d for d, _ in own}) > 1:
            assert len({of[d].class_id for d, _ in own}) == 1
            for d, i in own:
                covered[d].update(range(i, i + 50))
    found = {d: {i for s in r.spans.split(",") if s for i in range(*map(int, s.split(":")))} for d, r in of.items()}
    missed = sum(len(c - found[d]) for d, c in covered.items())
    assert missed <= 0.01 * sum(map(len, covered.values()))
    assert not [d for d in covered if not of[d].repeated]
    near = classes(len(docs), similar_pairs([t for _, t, _ in docs]))
    alike = Counter(near)
    words_of = {d: set(shingles(t)) for d, t, _ in docs}
    for i, (d, _, _) in enumerate(docs):  # what isn't an exact repetition must still share a passage's worth of shingles
        if of[d].repeated and d not in covered and alike[near[i]] == 1:
            assert max(len(words_of[d] & words_of[e]) for e, _, _ in docs if e != d) >= 30


def test_decontamination(rows, docs):
    windows = defaultdict(set)
    for item, text in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall():
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    of = {r.doc_id: r for r in rows("op5_decontaminate")}
    for d, text, _ in docs:
        w, hit, items = WORD.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= own
        sha = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        r = of[d]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(items), sha, bool(hit))


def test_proximity_matches(spark):
    from pricelake.llm.decontaminate import build_index, search

    texts = spark.createDataFrame([(1, "one two three four"), (2, "one x two three four"), (3, "four three two one")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    index = build_index(texts)
    assert search(index, item).count() == 1 and search(index, item, slop=1).count() == 2


def test_similarity_join(rows, docs):
    texts = list(dict.fromkeys(t for _, t, _ in docs))
    at = {t: i for i, t in enumerate(texts)}
    pairs = similar_pairs(texts)
    links, of, first = Counter(x for p in pairs for x in p), classes(len(texts), pairs), {}
    for d, t, _ in docs:
        first.setdefault(of[at[t]], d)
    got = {r.doc_id: r for r in rows("op6_ngram_join")}
    assert sum(got[d].n_links for d, t, _ in docs) >= 0.97 * sum(links[at[t]] for _, t, _ in docs)
    assert all(got[d].n_links <= links[at[t]] for d, t, _ in docs)
    assert np.mean([got[d].class_id == first[of[at[t]]] for d, t, _ in docs]) >= 0.99


def test_large_groups_are_verified_in_blocks(spark):
    from pricelake.llm.ngram_join import similarity_classes

    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base[:i] + [f"n{i}"] + base[i + 1 :]) for i in range(0, 120, 2)]
    df = spark.createDataFrame(list(enumerate(texts + texts)), "doc_id long, text string")
    want, links = set(similar_pairs(texts)), Counter()
    for a, b in want:
        links.update((a, b))
    for block_rows in (1000, 7):
        got = similarity_classes(df, block_rows=block_rows).collect()
        assert {r.class_id for r in got} == {0} and {r.n_copies for r in got} == {2}
        assert sum(r.n_links for r in got) >= 0.95 * 2 * sum(links.values())


def test_secrets(rows, docs):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    of, kinds = {r.doc_id: r for r in rows("op7_secrets")}, ("assign", "access", "hex")
    for d, t, _ in docs:
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))
        r = of[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in found) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == [s for s in text.split(",") if s]


def test_constants_reach_sensitive_names():
    from pricelake.llm.secrets import literal_spans

    text = 'K = "sk_live_9f8a7b6c5d"\nclient.apiKey = K\ncolour = "sk_live_0000aaaa11"\nexport SECRET=${K}\npassword = "changeme"\n'
    assert [text[a:b] for a, b, _ in literal_spans(text)] == ["sk_live_9f8a7b6c5d"]


def test_literals_that_names_reach():
    from pricelake.llm.secrets import literal_spans

    key = "a8Xk29QmZp41Lw7T"

    def found(text):
        return [text[s:e] for s, e, _ in literal_spans(text)]

    assert found(f'password_{"x" * 300} = "{key}"') == [key]
    assert found(f'password_{"1-" * 300} = "{key}"') == [key]
    assert found(f'{"1" * 500} = "{key}"') == []
    assert found(f"apiKey = K;\nK = '{key}'") == [key]
    assert found(f"<config><password>{key}</password><name>{key}</name></config>") == [key]
    assert found(f'K = "first4Value9here"; K = "{key}"; password = K') == [key]
    chain = f'a0 = "{key}"\n' + "".join(f'a{i} = a{i - 1} + "{i:06d}xyz"\n' for i in range(1, 20_000)) + "secret = a19999"
    began = time.process_time()
    assert len(found(chain)) == 20_000
    assert time.process_time() - began < 10


def test_archives(rows):
    pages = duckdb.sql(f"SELECT page_id, coalesce(html, '') FROM '{SF}/pages.parquet' ORDER BY 1").fetchall()
    first, want = {}, Counter()
    for i, html in pages:
        own = first.setdefault(html, i) == i
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        want[i, len(html.encode()), digest, "response" if own else "revisit", None if own else first[html]] += 1
    assert Counter(map(tuple, rows("op8_warc"))) == want


def test_archive_magics_inside_members_and_ranges(spark, monkeypatch):
    def stored(content):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        return packer.compress(content) + packer.flush()

    def payload(i):
        return (b"<p>" + bytes([i % 250]) + b"\x1f\x8b\x08\x00" * (i % 9) + b"y" * (i * 13 % 700)) * 3

    plain = warc.member
    path = warc.scratch_path(spark, "stored")
    contents = []
    monkeypatch.setattr(warc, "member", lambda c: contents.append(c) or plain(c))
    for i in range(200):
        warc.record(str(i), "u", payload(i), None, "2020-01-01T00:00:00Z")
    members = [stored(c) for c in contents]
    df = spark.createDataFrame([(bytearray(b"".join(members[i::2])),) for i in (0, 1)], "v binary").repartition(2)
    df.selectExpr("cast(v as string) value").write.option("lineSep", plain(b"").decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {int(r.page_id): bytes(r.payload) for r in got} == {i: payload(i) for i in range(200)} and len(got) == 200


def test_licenses(rows, docs):
    notice = re.compile(r"^(Licensed under|Released under|This work is licensed)", re.M)
    of = {r.doc_id: r for r in rows("op9_licenses")}
    for d, t, _ in docs:
        assert bool(of[d].part_licenses) == bool(notice.search(t))


def test_license_texts_by_canonical_digest(spark):
    from pricelake.llm.licenses import KNOWN, scan_licenses

    mit = KNOWN[0][1]
    texts = [mit.upper(), "Copyright (c) 2020 Someone\n\n" + mit.replace(",", " ;"), "Code\n\n" + KNOWN[6][1], mit + " extra"]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].license_id for i in range(4)] == ["MIT", "MIT", None, None]
    assert got[2].part_licenses == ["Apache-2.0"]


def scanned(spark, texts):
    from pricelake.llm.licenses import scan_licenses

    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in got)]


def test_licenses_of_repeated_rows(spark):
    notice = "SPDX-License-Identifier: MIT"
    known = spark.createDataFrame([("MIT", notice), ("Own", "a whole text\n\nof two blocks")], "license_id string, text string")
    rows = [(1, f"x\n{notice}\n\ny"), (1, f"x\n{notice}\n\ny"), (None, notice), (None, notice), (2, "a WHOLE text\n\nof two blocks"), (3, None), (4, f"{notice}\nx\n{notice}")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    assert sorted(((r.doc_id, r.license_id, r.n_parts) for r in got), key=str) == sorted([(1, None, 1), (1, None, 1), (None, "MIT", 1), (None, "MIT", 1), (2, "Own", 0), (3, None, 0), (4, None, 1)], key=str)


def plain_canonical(line):
    """The canonical form in plain Python."""
    own = re.sub(licenses.MARKS.replace(r"[^\p{L}\p{N}(©]", "MARK").replace("MARK", r"(?:(?!\w)[^(©]|_)"), "", line.lower())
    out = " " + re.sub(r"(?:_|\W)+", " ", own) + " "
    for a, b in licenses.SPELLINGS:
        out = out.replace(a, b)
    notice = licenses.NOTICE.replace(r"[^\p{L}\p{N}]", r"(?:_|\W)").replace(r"[\p{L}\p{N}]", r"[^\W_]")
    return "" if re.search(notice, own) else out.strip()


def test_licenses_by_brute_force(rows, docs):
    """Every whole text, block and line of the table by the canonical form in plain Python."""
    def blocks(text):
        return [[c for x in re.split(r"\r?\n", b) if (c := plain_canonical(x))] for b in re.split(r"\r?\n[ \t/*#;%!-]*\r?\n", text or "")]

    known = {}
    for name, text in licenses.known_texts():
        whole = " ".join(x for b in blocks(text) for x in b)
        if whole:
            known[whole] = min(name, known.get(whole, name))
    of = {r.doc_id: r for r in rows("op9_licenses")}
    for d, text, _ in docs:
        own = blocks(text)
        parts = {x for b in own for x in b} | {" ".join(b) for b in own if b}
        found = {known[p] for p in parts if p in known}
        want = known.get(" ".join(x for b in own for x in b)), sorted(found), sum(p in known for p in parts)
        assert (of[d].license_id, list(of[d].part_licenses), of[d].n_parts) == want, d


def test_usual_licenses_are_known(spark):
    from pathlib import Path

    from pricelake.llm import licenses

    files = sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))
    texts = {f.stem: f.read_text() for f in files}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "Unlicense", "CC0-1.0"} <= set(texts)
    mit, apache = licenses.KNOWN[1][1], texts["Apache-2.0"]
    more = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + mit),
        ("MIT", "The MIT License (MIT)\n\n" + mit),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + texts["BSD-3-Clause"]),
        ("Apache-2.0", apache[: apache.index("APPENDIX")]),
        ("GPL-3.0", texts["GPL-3.0"].split("\n\n", 1)[1]),
    ]
    want = [*texts.items(), *more]
    assert [r.license_id for r in scanned(spark, [t for _, t in want])] == [k for k, _ in want]
    assert scanned(spark, ["x = 1\n\n" + apache[apache.index("   Licensed under the Apache") :]])[0].part_licenses == ["Apache-2.0"]


def test_licenses_at_any_width_and_in_comments(spark):
    import textwrap
    from pathlib import Path

    from pricelake.llm import licenses

    notice = re.compile(r"^\s*Copyright (\(C\)|\[yyyy)|^\s*all rights reserved", re.I)
    known = [(f.stem, f.read_text()) for f in sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))]
    known += [("MIT", licenses.KNOWN[1][1]), ("ISC", licenses._ISC)]
    want, texts = [], []
    for name, text in known:
        kept = "\n".join(x for x in text.strip().split("\n") if not notice.search(x))
        for width in (24, 40, 47, 60, 66, 72, 79, 100, 120):
            blocks = re.split(r"\n\s*\n", kept)  # a block with a notice within it (how to apply the terms) stays
            fill = [b if "Copyright (" in b else textwrap.fill(b, width, break_on_hyphens=False, break_long_words=False) for b in blocks]
            body = "\n\n".join(fill)
            want.append((name, width))
            texts.append(body)
        for mark in ("# ", "// ", " * ", "-- ", "; ", "dnl "):
            want.append((name, mark))
            texts.append("\n".join((mark + x).rstrip() for x in ["Copyright (c) 2020 X Y", "Copyright The Authors", "", *text.split("\n")]))
    got = scanned(spark, texts)
    assert Counter(w for w, r in zip(want, got, strict=True) if r.license_id != w[0]) == {}
    header = "\n".join("# " + x for x in textwrap.wrap(dict(licenses.HEADERS)["MPL-2.0"], 70))
    assert scanned(spark, ["#\n" + header + "\n#\nx = 1"])[0].part_licenses == ["MPL-2.0"]


def test_language_with_many_copies(spark, monkeypatch):
    texts = [(f"le mot {i} est ici", "fr") for i in range(30)] + [("le mot", "fr")] * 3000 + [(f"the word {i} is here", "en") for i in range(31)]
    taken = []
    monkeypatch.setattr(langid, "ftrl", lambda rows, labels, *a, ftrl=langid.ftrl: taken.append(Counter(labels.tolist())) or ftrl(rows, labels, *a))
    langid.fit(spark.createDataFrame(texts, "text string, lang string"), sample_rows=40)
    assert sum(taken[0].values()) == 32


def test_texts_of_low_score_stay(spark):
    none = np.zeros((langid.BUCKETS, 10))
    model = langid.Model([f"l{i}" for i in range(10)], np.ones(langid.BUCKETS), none, np.zeros(10), 1.0)  # a score of 0.1 for all
    docs = spark.createDataFrame([("short",), ("12 34",), (None,)], "text string")
    assert [r.text for r in langid.keep_identified(docs, model).collect()] == ["short"]


def test_tokens_equal_the_library(rows, docs):
    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    of = {r.doc_id: r for r in rows("op10_bpe")}
    for d, t, _ in docs:
        ids = library.encode_ordinary(t)
        assert (of[d].n_tokens, of[d].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert of[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_perfect_hash_and_merges():
    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    from pricelake.llm.bpe import Codec, PerfectHash, read_ranks

    vocabulary = read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    perfect = PerfectHash(vocabulary)
    assert sorted(perfect.keys_at) == list(range(len(vocabulary))) and all(perfect.find(k) == i for i, k in enumerate(vocabulary))
    codec = Codec(vocabulary, P.PATTERN, perfect)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={k: i for i, k in enumerate(vocabulary)}, special_tokens={})
    for text in ("", " ", "a" * 5000, "日本語 🎉🎉 ñandú\n\n  x", "\x1c\x85 <|endoftext|> it's 123,456", "é́" * 50):
        assert codec.encode(text).tolist() == library.encode_ordinary(text) and codec.decode(codec.encode(text)) == text.encode()


def test_pipeline(spark, docs, rows):
    """Every stage on the rows that its predecessor kept, against brute force."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "benchmark", "tokens"]
    kept = [(d, t) for d, t, _ in docs if any(c.isalpha() for c in t)]
    last = {t: d for d, t in kept}
    kept = [(d, t) for d, t in kept if last[t] == d]
    of = classes(len(kept), similar_pairs([t for _, t in kept]))
    kept = [x for i, x in enumerate(kept) if of[i] == i]
    dirty = {r.doc_id for r in rows("op5_decontaminate") if r.contaminated}
    want = {d for d, _ in kept if d not in dirty}
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(want ^ {r.doc_id for r in got}) <= 2  # the join's recall
    tokens = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows("op10_bpe")}
    assert all(tokens[r.doc_id] == (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got)


def shifted_pairs(n_words, n_put_in, places, n_pairs, seed):
    """Texts with a passage, and with the passage after words were put in at some places; the passages' tokens."""
    rng = random.Random(seed)

    def junk(n):
        return [f"j{rng.randrange(10**9)}" for _ in range(n)]

    for _ in range(n_pairs):
        own = junk(n_words)
        other = own[:]
        for k in range(places):
            at = (k + 1) * n_words // (places + 1) + rng.randrange(-8, 9)
            other[at:at] = junk(n_put_in // places)
        yield junk(rng.randrange(20, 200)), own, other, junk(rng.randrange(20, 200))


def test_words_put_in_move_a_passage(spark):
    """Near duplicates of 0.8 and more whose shift changes by any number of words: recall of at least 0.9 in each case."""
    rows, want = [], {}
    for case in [(90, 4, 1), (80, 6, 1), (60, 3, 1), (100, 10, 1), (120, 8, 2), (150, 9, 3), (200, 15, 1)]:
        for before, own, other, after in shifted_pairs(*case, 30, case[0]):
            sets = [set(shingle_hashes(word_hashes(" ".join(x).encode())).tolist()) for x in (own, other)]
            assert len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1])
            for k, passage in ((0, own), (1, other)):
                want[len(rows)] = case, len(before[k * 7 :]), len(passage)
                rows.append((len(rows), " ".join(before[k * 7 :] + passage + after[: len(after) - k * 9])))
                before, after = [x + "z" for x in before], [x + "z" for x in after]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter()
    for r in got:
        case, first, n = want[r.doc_id]
        words_in = {w for s in r.spans.split(",") if s for w in range(*map(int, s.split(":")))}
        assert len(words_in - set(range(first, first + n))) <= 10  # little beyond the passage
        found[case] += len(words_in) >= 0.8 * n
    assert len(found) == 7 and min(found.values()) >= 0.9 * 60, found
