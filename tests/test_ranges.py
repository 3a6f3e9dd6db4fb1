"""CSV files read in byte ranges against the parser of small files."""

import glob
import json
import random

import pytest

from pricelake.sources import files as S
from pricelake.sources import ranges as R


def small(spark, root):
    rows = S.to_rows(S.sniff(S.scan_tree(spark, root))).where("status IN ('ok', 'rejected')").collect()
    return sorted((r["rel_path"], r["row_index"], r["row_json"] or "", r["status"]) for r in rows)


def large(spark, root, size):
    paths = sorted("file://" + p for p in glob.glob(f"{root}/*.csv"))
    names = {p: p.rsplit("/", 1)[1] for p in paths} | {p.replace("file://", "file:"): p.rsplit("/", 1)[1] for p in paths}
    rows = R.read_csv_ranges(spark, paths, names, range_bytes=size).collect()
    done = {r["rel_path"]: r["row_index"] for r in rows if r["status"] == "file"}
    out = sorted((r["rel_path"], r["row_index"], r["row_json"] or "", r["status"]) for r in rows if r["status"] != "file")
    assert all(done[f] == sum(1 for r in out if r[0] == f and r[3] == "ok") for f in done)
    return out, {r["rel_path"]: r["row_json"] for r in rows if r["status"] == "file"}


def write(root):
    rng = random.Random(6)
    cells = ["x", "", "long text " * 9, '"quoted"', '"two\nlines"', '"a ""b""\r\nc;d"', 'in"side', '5" pipe', '"end"tail', '"sep;in"', "é", '""', '"""\n"']

    def body(n, sep=";"):
        return [sep.join(rng.choice(cells).replace(";", sep) for _ in range(rng.choice([3, 3, 3, 2, 4]))) for _ in range(n)]

    put = lambda name, data: open(f"{root}/{name}", "wb").write(data)
    put("plain.csv", "\n".join(['a;"b\nhead";c', *body(40), ""]).encode())
    put("bom.csv", b"\xef\xbb\xbf" + "\r\n".join(["a;b;a", *body(40)]).encode())
    put("latin.csv", "\n".join(["a,b,c", *body(40, ","), ""]).encode("cp1252"))
    put("blank.csv", "\n\na;b;c\n\n1;2;3\n\n".encode())
    put("open.csv", 'a;b;c\n1;2;3\n4;"never closed;5\n6;7;8\n'.encode())
    put("returns.csv", 'a;b;c\r1;"x\ry";3\r4;5;6\n7;8;9'.encode())
    put("header.csv", b"a;b;c\n")
    put("empty.csv", b"")


digests_of = []


@pytest.mark.parametrize("size", [23, 300, None])
def test_ranges_equal_the_whole_file(spark, tmpdir_path, size):
    write(tmpdir_path)
    got, digests = large(spark, tmpdir_path, size)
    want = small(spark, tmpdir_path)
    assert got == want
    assert sum(r[3] == "rejected" for r in want) > 5 and any("\\n" in r[2] for r in want)
    digests_of.append(digests)
    assert digests == digests_of[0]  # whatever the ranges


def test_states_of_lines():
    rule = R.QuoteState(";")
    lines = [b'a;"open', b'a;"closed"', b'in"side', b'x;"a""b', b'"a"";', b'";"', b'a";"b', b'"', b'""', b'"""', b'a"b;c"d', b'"x"y"z;"', b'\r"']
    for line in lines:
        for inside in (False, True):
            import csv
            import io

            text = ('"' if inside else "") + line.decode() + "\nEND"
            last = list(csv.reader(io.StringIO(text, newline=""), delimiter=";"))[-1]
            assert rule.after(line, inside) == (last != ["END"]), (line, inside)


def test_large_files_of_a_landing(spark, tmpdir_path):
    from fixtures import build_landing

    from pricelake.plans import price_index as PI

    p = build_landing(tmpdir_path)
    of = lambda **k: sorted((r["rel_path"], r["row_index"], r["row_json"]) for r in PI.land_rows(spark, p["landing"], **k).where("status = 'ok'").collect())
    assert of(large_bytes=100) == of()
    assert json.loads(of(large_bytes=100)[0][2])
