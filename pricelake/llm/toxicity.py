"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, strips accents, maps look-alike letters to Latin ones and, next to letters, digits and signs to the
letters they stand for. Lexicon entries are words or word beginnings (families of inflected forms); their weights are
log odds between toxic and clean labelled documents. Matches inside an exception phrase don't count. The sum of weights
and the same sum per 100 words go through a fitted logistic curve.

The lexicon and the curve are learned from a bounded sample of labelled rows (``sample_rows``).
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import WORD_BYTES, column_texts, small_batches
from pricelake.llm.langid import fold_of

# Look-alike letters of other scripts, and signs that stand for letters.
LOOKALIKES = str.maketrans(
    "абвеёіјкмнорѕтухһԁԛԝαβεικνορτυχωılı",
    "abbeeijkmhopstyxhdqwabeikvoptuxwili",
)
SUBSTITUTES = str.maketrans("0134578@$", "oieastbas")
_FOREIGN = re.compile("[ıͰ-ԯ]")
_ACCENTS = re.compile("[̀-ͯ]+")
_SIGNS = re.compile(r"(?<=[a-z])[0-9@$]+|(?<![0-9@$])[0-9@$]++(?=[a-z])")
#: Phrases whose words are harmless together; more are learned.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "pathetic fallacy")
PREFIXES = range(4, 9)
LEAST_SUPPORT, LEAST_G2, LEAST_ODDS = 6, 30.0, 2.0


def folded(text: str) -> str:
    """Folded words, one blank before and after each."""
    text = text.lower()
    if not text.isascii():
        text = _ACCENTS.sub("", unicodedata.normalize("NFKD", text))
        if _FOREIGN.search(text):
            text = text.translate(LOOKALIKES)
    text = _SIGNS.sub(lambda m: m[0].translate(SUBSTITUTES), text)
    return f" {' '.join(text.encode('utf-8', 'replace').translate(WORD_BYTES).decode('utf-8', 'replace').split())} "


def terms(fold: str) -> set[str]:
    """The candidate entries of a folded text: " word " and " begin"."""
    found = set()
    for w in set(fold.split()):
        found.add(f" {w} ")
        found.update(" " + w[:n] for n in PREFIXES if n <= len(w))
    return found


class Lexicon:
    """Entries with weights, exception phrases and the logistic curve (bias, weight of the sum, of the density)."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = (), curve: tuple[float, float, float] = (-3.0, 1.0, 0.0)):
        self.weights, self.exceptions, self.curve, self._automaton = weights, exceptions, curve, None

    def __getstate__(self):
        return self.weights, self.exceptions, self.curve

    def __setstate__(self, state):
        self.__init__(*state)

    def matches(self, fold: str) -> list[tuple[int, int, str]]:
        """(start, end, entry), without matches inside an exception phrase."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for w in self.weights:
                self._automaton.add_word(w, (w, False))
            for p in self.exceptions:
                entry = folded(p)
                self._automaton.add_word(entry, (entry, True))
            self._automaton.make_automaton()
        if not len(self._automaton):
            return []
        hits, spared = [], []
        for end, (entry, harmless) in self._automaton.iter(fold):
            (spared if harmless else hits).append((end + 1 - len(entry), end + 1, entry))
        if spared:
            spared.sort()
            starts = [s for s, _, _ in spared]
            furthest = [*itertools.accumulate((e for _, e, _ in spared), max)]  # of the phrases that begin up to there

            def harmless(start: int, end: int) -> bool:
                i = bisect.bisect_right(starts, start)
                return i > 0 and end <= furthest[i - 1]

            hits = [h for h in hits if not harmless(h[0], h[0] + len(h[2].rstrip()))]
        return hits

    def inputs(self, fold: str) -> tuple[float, float]:
        """log(1 + sum of weights), and the same of the sum per 100 words."""
        found = Counter(entry for _, _, entry in self.matches(fold))
        total = sum(self.weights[w] * (1 + np.log(n)) for w, n in found.items())
        size = max(1, fold.count(" ") - 1)
        return float(np.log1p(max(0.0, total))), float(np.log1p(100 * max(0.0, total) / size))

    def score(self, text: str) -> float:
        a, b = self.inputs(folded(text))
        bias, wa, wb = self.curve
        return float(1 / (1 + np.exp(-(bias + wa * a + wb * b))))


def log_odds(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    return float(np.log((pos + 0.5) / (n_pos - pos + 0.5)) - np.log((neg + 0.5) / (n_neg - neg + 0.5)))


def g2(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    """The log likelihood ratio of an entry's frequency in toxic against clean texts; 0 if it isn't more frequent."""
    table = np.array([[pos, n_pos - pos], [neg, n_neg - neg]], float)
    if pos * n_neg <= neg * n_pos:
        return 0.0
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    return float(2 * np.where(table > 0, table * np.log(np.maximum(table, 1e-9) / np.maximum(expected, 1e-9)), 0).sum())


def significant(counts: list[tuple[str, int, int]], n_pos: int, n_neg: int) -> dict[str, tuple[int, int]]:
    """The entries that are clearly more frequent in toxic texts. counts: (entry, toxic texts, clean texts)."""
    return {
        t: (pos, neg)
        for t, pos, neg in counts
        if pos >= LEAST_SUPPORT and log_odds(pos, neg, n_pos, n_neg) >= LEAST_ODDS and g2(pos, neg, n_pos, n_neg) >= LEAST_G2
    }


def choose(counts: dict[str, tuple[int, int]], contexts: dict[str, set[int]], n_pos: int, n_neg: int) -> dict[str, float]:
    """Entry -> log odds. An entry must be significant by its distinct contexts (the words beside it), which copies of
    a text don't add to, and have one for every other toxic text at least. Of entries that begin alike, the shorter
    stays if its odds are about as high, else the longer if it explains most of the shorter's texts."""
    good = {}
    for t, (pos, neg) in counts.items():
        n = min(len(contexts.get(t, ())), pos)
        if n >= max(LEAST_SUPPORT, pos / 2) and g2(n, neg, n_pos, n_neg) >= LEAST_G2:
            good[t] = log_odds(pos, neg, n_pos, n_neg)
    chosen = dict(good)
    for t in sorted(good, key=lambda t: (len(t), t)):
        for n in PREFIXES:
            short = t[: n + 1]
            if len(short) < len(t) and short in chosen and t in chosen:
                if good[short] >= good[t] - 1:
                    del chosen[t]
                elif counts[t][0] >= 0.8 * counts[short][0]:
                    del chosen[short]
    return chosen


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Logistic regression on the two inputs by Newton's method; ridge bounds the weights of separable data."""
    if not len(y):
        return -3.0, 1.0, 0.0
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    penalty = np.diag([1e-3, ridge, ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _counted(rows: DataFrame, wanted=None) -> DataFrame:
    """(term, n): in how many texts of ``rows`` each term is; of ``wanted`` (broadcast) only, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["term", "n"])

        for b in batches:
            for text in column_texts(b.column(0)):
                own = terms(folded(text))
                found.update(own if wanted is None else own & wanted.value)
                if len(found) > 300_000:
                    yield batch()
                    found.clear()
        yield batch()

    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, candidates: int = 200_000, learned_phrases: int = 10_000, curve_rows: int = 20_000) -> Lexicon:
    """labelled: text, toxic (0/1, no nulls), a bounded sample. ``candidates`` bounds the entries looked at, the most
    frequent in toxic texts first; ``learned_phrases`` the exception phrases learned beside the given ones, the most frequent
    in clean texts first; ``curve_rows`` the rows of the curve. They bound the lexicon, not the texts it is matched with."""
    spark = labelled.sparkSession
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    rows = _counted(labelled.where("toxic = 1")).where(F.col("n") >= LEAST_SUPPORT).orderBy(F.desc("n"), "term").limit(candidates).collect()
    pos = {r["term"]: r["n"] for r in rows}
    neg: dict[str, int] = {}
    if pos and n_neg:
        wanted = spark.sparkContext.broadcast(frozenset(pos))
        neg = {r["term"]: r["n"] for r in _counted(labelled.where("toxic = 0"), wanted).collect()}  # no more than in pos
    good = significant([(t, p, neg.get(t, 0)) for t, p in pos.items()], n_pos, n_neg)
    shared_good = spark.sparkContext.broadcast(frozenset(good))

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = set()
            for text in column_texts(b.column(0)):
                ws = folded(text).split()
                for i, w in enumerate(ws):
                    context = None
                    for t in (f" {w} ", *(" " + w[:n] for n in PREFIXES if n <= len(w))):
                        if t in shared_good.value:
                            context = context or xxhash.xxh3_64_intdigest(" ".join(ws[max(0, i - 1) : i] + [""] + ws[i + 1 : i + 2])) >> 1
                            found.add((t, context))
            rows = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["term", "context"])

    contexts: dict[str, set[int]] = defaultdict(set)
    if good:
        pairs = labelled.where("toxic = 1").select("text").mapInArrow(beside, "term string, context long")
        for r in pairs.distinct().toLocalIterator():  # bounded by the sample
            contexts[r["term"]].add(r["context"])
    weights = choose(good, contexts, n_pos, n_neg)
    lexicon = spark.sparkContext.broadcast(Lexicon(weights, exceptions))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for b in batches:
            for text, toxic in zip(column_texts(b.column(0)), b.column(1).to_pylist(), strict=True):
                fold, own = folded(text), set()
                for start, end, entry in lexicon.value.matches(fold):
                    stop = end - 1 if entry[-1] == " " else fold.index(" ", end)
                    before = fold.rfind(" ", 0, start) if start else -1
                    after = fold.find(" ", stop + 1)
                    own |= {fold[before + 1 : stop]} if before >= 0 and start else set()
                    own |= {fold[start + 1 : after]} if after > 0 else set()
                for phrase in own:
                    found[phrase][toxic] += 1
        columns = [pa.array(list(found), pa.string())] + [pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["phrase", "clean", "toxic"])

    learned = (
        labelled.select("text", F.col("toxic").cast("int")).mapInArrow(phrases, "phrase string, clean long, toxic long")
        .groupBy("phrase").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("clean >= 5 AND clean > 2 * toxic").orderBy(F.desc("clean"), "phrase").limit(learned_phrases).collect()
    )
    best = Lexicon(weights, exceptions + tuple(r["phrase"] for r in learned))
    shared = spark.sparkContext.broadcast(best)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            got = [shared.value.inputs(folded(t)) for t in column_texts(b.column(0))]
            columns = [b.column(1), b.column(2)] + [pa.array([g[i] for g in got], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "key", "a", "b"])

    keyed = labelled.select("text", F.col("toxic").cast("int"), F.xxhash64("text", F.lit(5)).alias("key"))
    got = keyed.mapInArrow(inputs, "toxic int, key long, a double, b double").orderBy("key").limit(curve_rows).collect()
    best.curve = fit_curve(np.array([[r["a"], r["b"]] for r in got]).reshape(-1, 2), np.array([r["toxic"] for r in got], float))
    return best


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, extra: tuple[Column, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (1 from ``threshold`` on), then ``extra``.
    Null text is empty; an empty text has the score of a text without matches."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample it was learned from
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), *extra)
    rest = [f for f in picked.schema.fields if f.name not in ("doc_id", "__text")]
    schema = f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double, predicted int" + "".join(
        f", {f.name} {f.dataType.simpleString()}" for f in rest
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            got = [shared.value.score(t) for t in column_texts(b.column(1))]
            columns = [b.column(0), pa.array(got, pa.float64()), pa.array([int(g >= threshold) for g in got], pa.int32())]
            names = ["doc_id", "score", "predicted"] + [f.name for f in rest]
            yield pa.RecordBatch.from_arrays(columns + [b.column(2 + i) for i in range(len(rest))], names=names)

    return picked.mapInArrow(run, schema)


def train_and_score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 4, held: int = 2, sample_rows: int = 50_000
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``. Learned from at most ``sample_rows`` labelled ids
    outside the held-out fold (chosen by hash, which bounds the broadcast); of several labels of an id the largest holds,
    null labels and labels without document are ignored."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold_of(id_col, folds) != held))
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("toxic"))
        .orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    )
    labelled = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(known), "__id")
    lexicon = fit(labelled.select(F.coalesce("text", F.lit("")).alias("text"), "toxic"))
    found = score(docs, lexicon, id_col, text_col, 0.3, ((fold_of(id_col, folds) == held).alias("held_out"),))
    return found.select("doc_id", "held_out", "score", "predicted")
