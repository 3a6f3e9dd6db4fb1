"""Secret scan: assignment-aware lexing besides three fixed patterns.

The lexer finds assignment operators, reads the target name before each and the literal, reference or concatenation
after it, and so turns source and configuration syntax into name-literal pairs. Names assigned a literal are constants;
a reference to one passes its literals on. A literal is scored by the most sensitive name that it reaches and by its own
shape; literals that score enough are spans of the kind ``literal``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pricelake.llm.common import column_texts, small_batches

# Fixed patterns of the base kinds. Runs are matched whole, so a least length in the pattern drops the same matches as
# one checked afterwards; for ``assign`` a failing match still uses up its text, so group 2 is checked afterwards.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

OPERATOR = re.compile(r"(?:(?<![=!<>:+*/%&|^~-])(?::=|=>|=(?![=~>]))|(?<!:):(?![:=/]))[ \t]*")
NAME_BEFORE = re.compile(r"""([A-Za-z_$][\w.$-]*)["'`]?\]?[ \t]*\Z""")
QUOTED = re.compile(r""""((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`((?:[^`\\\n]|\\.)*)`""")
REFERENCE = re.compile(r"\$\{([A-Za-z_][\w.]*)\}|\$([A-Za-z_][\w.]*)")
IDENTIFIER = re.compile(r"[A-Za-z_][\w.]*\Z")
BARE = re.compile(r"""[^\s,;'"`()\[\]{}<>&|]+""")
CONCAT = re.compile(r"[ \t]*(?:\+|\.\.?)[ \t]*(?=[\"'`$A-Za-z_])")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
NAME_CHARS = re.compile(r"[\w.$-]*\Z")
NAME_REST = re.compile(r"""[\w.$-]*["'`]?\]?[ \t]*\Z""")
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*)(?:\s[^<>]*)?>[ \t]*([^<>\s](?:[^<>]*[^<>\s])?)[ \t]*</\1>")

# Weights of name parts, and values that stand for no secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 0.9, "authkey": 0.9, "bearer": 0.8,
    "secretkey": 1.0, "signingkey": 0.9, "encryptionkey": 0.9, "connectionstring": 0.8, "auth": 0.6, "key": 0.4,
}
PLACEHOLDERS = {"changeme", "example", "password", "secret", "token", "none", "null", "true", "false", "undefined", "todo", "test", "your", "xxx"}


def name_score(name: str) -> float:
    """How sensitive a target name is, from 0 to 1: the heaviest of its parts and of its adjacent pairs of parts."""
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + [a + b for a, b in zip(parts, parts[1:], strict=False)]), default=0.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, from 0 to 1: length and entropy, none for placeholders."""
    low = value.lower()
    if len(value) < 6 or any(c.isspace() for c in value) or low in PLACEHOLDERS or len(set(value)) <= 2:
        return 0.0
    if any(low.startswith(p) for p in ("example", "your", "changeme", "<", "${", "{{")):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    mixed = (any(c.isdigit() for c in value) + any(c.isalpha() for c in value)) / 2
    return min(1.0, 0.3 + 0.1 * entropy + 0.2 * mixed + 0.1 * (n >= 16))


def _value(text: str, pos: int) -> tuple[str, str, int, int, int] | None:
    """The value at ``pos``: (kind, value, start, end, where reading goes on); kind is ``literal``, ``reference`` or
    ``bare`` (an unquoted word that may be either)."""
    if m := QUOTED.match(text, pos):
        k = m.lastindex
        return "literal", m[k], m.start(k), m.end(k), m.end()
    if m := REFERENCE.match(text, pos):
        return "reference", m[1] or m[2], m.start(), m.end(), m.end()
    if m := BARE.match(text, pos):
        return "bare" if IDENTIFIER.match(m[0]) else "literal", m[0], m.start(), m.end(), m.end()
    return None


def _name(text: str, end: int) -> str | None:
    """The target name that ends before ``end``, however long: the window is doubled while all of it, or all before the
    name found, could belong to a name."""
    size = 64
    while True:
        low = max(0, end - size)
        found = NAME_BEFORE.search(text, low, end)
        within = NAME_CHARS.match(text, low, found.start()) if found else NAME_REST.match(text, low, end)
        if not low or not within:
            return found[1] if found else None
        size *= 2


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """(target name, parts of its value); a part is (kind, value, start, end)."""
    at = 0
    while op := OPERATOR.search(text, at):
        at = op.end()
        name = _name(text, op.start())
        if not name:
            continue
        parts, pos = [], op.end()
        while found := _value(text, pos):
            parts.append(found[:4])
            more = CONCAT.match(text, found[4])
            if not more:
                break
            pos = more.end()
        if parts:
            yield name, parts
            if parts[-1][0] == "literal":
                at = max(at, parts[-1][3])
    if "</" in text:
        for m in ELEMENT.finditer(text):
            yield m[1], [("literal", m[2], m.start(2), m.end(2))]


def literal_spans(text: str, threshold: float = 0.5) -> list[tuple[int, int, float]]:
    """(start, end, score) of the literals that score at least ``threshold``."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    nodes: list[tuple[list[tuple[str, int, int]], list[int]]] = []  # of each assignment: its literals, the ones it names
    constants: dict[str, int] = {}  # a name's last assignment so far
    later: dict[str, list[int]] = {}  # assignments that name what isn't assigned yet
    weights: list[tuple[float, int]] = []
    for name, parts in assignments(text):
        weight, own, refs, open_refs = name_score(name), [], [], []
        for kind, value, start, end in parts:
            if kind == "literal":
                own.append((value, start, end))
            elif value in constants:
                refs.append(constants[value])
            elif kind == "bare" and weight >= 0.8 and literal_score(value) >= 0.6 and any(c.isdigit() for c in value):
                own.append((value, start, end))  # an unquoted value, as in configuration files
            else:
                open_refs.append(value)
        if own or refs or open_refs:
            i = len(nodes)
            nodes.append((own, refs))
            for value in open_refs:
                later.setdefault(value, []).append(i)
            if own or refs:
                constants[name] = i
                for j in later.pop(name, ()):
                    nodes[j][1].append(i)
            if weight:
                weights.append((weight, i))
    # every assignment is visited once, from the heaviest name that reaches it: that name gives its literals' scores
    best, seen = {}, set()
    for weight, i in sorted(weights, key=lambda w: -w[0]):
        stack = [i]
        while stack:
            if (j := stack.pop()) in seen:
                continue
            seen.add(j)
            stack += nodes[j][1]
            for value, start, end in nodes[j][0]:
                score = weight * literal_score(value)
                if score >= threshold:
                    best[start, end] = max(score, best.get((start, end), 0.0))
    return sorted((s, e, v) for (s, e), v in best.items())


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the three fixed patterns, in code points."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "key")):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal, max_score.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then by kind, joined by commas. Null text
    is empty and has none. Repeated rows and null ids stay; other columns are ignored; an empty table gives no rows.
    """
    schema = (
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans string, n_literal long, max_score double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out: list[tuple] = []
            for text in column_texts(b.column(1)):
                base, literals = base_spans(text), literal_spans(text, threshold)
                n = Counter(k for _, k, _ in base)
                spans = joined(base + [(s, "literal", e) for s, e, _ in literals])
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                top = max((v for _, _, v in literals), default=0.0)
                out.append((n["assign"], n["access"], n["hex"], digest, spans, len(literals), top))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
