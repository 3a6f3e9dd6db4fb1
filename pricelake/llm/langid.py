"""Language identification: sparse multinomial logistic regression over TF-IDF character n-grams.

Features are hashed character n-grams (1 to 3) of the lower-cased text, weighted (1 + log tf) * idf and scaled to unit
length. Document frequencies cover all training rows. The weights are fitted with the proximal follow-the-regularised-
leader method (per-coordinate rates, elastic net: L1 makes weights exactly zero, L2 shrinks them) over a bounded sample
of training rows; the temperature is fitted on a part of that sample which the weights never saw.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import column_texts, small_batches

BUCKETS = 1 << 15
UNKNOWN = "und"
_FACTORS = np.random.default_rng(7).integers(1, 2**62, 3, dtype=np.int64) | 1
#: The n-grams of a text are counted in pieces of this many characters, to bound memory; neighbours overlap by two.
PIECE = 1 << 20


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of the whole text."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), PIECE):
        piece = text[at : at + PIECE + 2].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        blank = codes <= 32
        codes[blank] = 32
        codes = codes[~(blank & np.append(False, blank[:-1]))]
        last = at + PIECE >= len(text)
        h = np.zeros(len(codes), np.int64)
        for n in range(3):
            h = h[: len(codes) - n] + codes[n:] * _FACTORS[n] if len(codes) > n else h[:0]
            own = h if last else h[: max(0, len(codes) - 2)]
            counts += np.bincount(((own ^ (own >> 29)) * _FACTORS[0] >> 40) & (BUCKETS - 1), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = found
    x = (1 + np.log(counts)) * idf[at]
    return at, x / (np.linalg.norm(x) or 1.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Model:
    """idf, the weights of each class and the temperature."""

    def __init__(self, classes: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.classes, self.idf, self.weights, self.bias, self.temperature = classes, idf, weights, bias, temperature

    def logits(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, x = weighted(found, self.idf)
        return x @ self.weights[at] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        if not any(c.isalpha() for c in text) or not self.classes:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(features(text)) / self.temperature)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def ftrl(rows: list, labels: np.ndarray, k: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets x classes) and bias. rows: (buckets, values). z and n are the method's sums; a weight is zero
    while its |z| is at most l1."""
    z, n = np.zeros((BUCKETS, k)), np.zeros((BUCKETS, k))
    zb, nb = np.zeros(k), np.zeros(k)

    def solve(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            at, x = rows[r]
            w, b = solve(z[at], n[at], l1, l2), solve(zb, nb, 0.0, 0.0)
            g = _softmax(x @ w + b)
            g[labels[r]] -= 1
            gx = x[:, None] * g
            for total, squares, own, weight, grad in ((z, n, at, w, gx), (zb, nb, slice(None), b, g)):
                rate = (np.sqrt(squares[own] + grad**2) - np.sqrt(squares[own])) / alpha
                total[own] += grad - rate * weight
                squares[own] += grad**2
    return solve(z, n, l1, l2), solve(zb, nb, 0.0, 0.0)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden sections of its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    sample_rows: int = 2_400,
    epochs: int = 3,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
    max_classes: int = 200,
) -> Model:
    """``sample_rows`` (the documented bound) is the number of rows that the weights and the temperature are fitted on,
    in equal parts by label, chosen by the hash of the text; idf counts all rows of ``labelled``."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for text in column_texts(b.column(0)):
                total[features(text)[0]] += 1
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], names=["bucket", "n"]
        )

    counted = rows.select("text").mapInArrow(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = {r["bucket"]: r["n"] for r in counted.collect()}  # at most BUCKETS + 1 rows
    n_docs = df.pop(-1, 0)
    idf = np.zeros(BUCKETS)
    at = np.fromiter(df.keys(), np.int64, len(df))
    idf[at] = np.log((1 + n_docs) / (1 + np.fromiter(df.values(), np.float64, len(df)))) + 1

    keyed = rows.withColumn("key", F.xxhash64("text", F.lit(3)))
    sizes = {r["label"]: r["count"] for r in keyed.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_classes + 1).collect()}
    classes = sorted(sizes)
    if len(classes) > max_classes:
        raise ValueError(f"more than {max_classes} labels")
    if not classes:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    share = max(2, sample_rows // len(classes))
    # about four times the share by hash, then the share: no label's rows meet in one task
    texts = {r["label"]: r["count"] for r in keyed.select("label", "key").distinct().groupBy("label").count().collect()}  # copies count once
    limits = [(c, -(2**63) + min(2**64 - 1, int(4 * share / n * 2**64))) for c, n in texts.items()]
    near = keyed.select("label", "key").join(F.broadcast(spark.createDataFrame(limits, "label string, most long")), "label")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("key"))
    picks = near.where(F.col("key") <= F.col("most")).select("label", "key").distinct().withColumn("rank", rank)
    picks = picks.where(F.col("rank") <= share).drop("rank")
    sample = keyed.join(F.broadcast(picks), ["label", "key"]).groupBy("label", "key").agg(F.first("text").alias("text"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4 << 20):
            found = [features(t) for t in column_texts(b.column(1))]
            columns = [b.column(0), b.column(2)] + [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "key", "at", "n"])

    got = sample.select("label", "text", "key").mapInArrow(counts, "label string, key long, at array<long>, n array<long>")
    taken = sorted(got.toLocalIterator(), key=lambda r: (r["key"], r["label"]))
    xs = [weighted((np.array(r["at"]), np.array(r["n"])), idf) for r in taken]
    ys = np.array([classes.index(r["label"]) for r in taken])
    held = np.arange(len(xs)) % 5 == 4
    train = [x for x, h in zip(xs, held, strict=True) if not h]
    weights, bias = ftrl(train, ys[~held], len(classes), epochs, alpha, beta, l1, l2)
    logits = [x @ weights[at] + bias for (at, x), h in zip(xs, held, strict=True) if h]
    temperature = fit_temperature(np.array(logits), ys[held])
    return Model(classes, idf, weights, bias, temperature)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", extra: tuple[Column, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (calibrated probability, 0 to 1), then ``extra``.

    Null texts and texts without a letter are ``und`` with score 0, as are all texts if the model has no class."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS x classes weights
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), *extra)
    rest = [f for f in picked.schema.fields if f.name not in ("doc_id", "__text")]
    schema = f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double" + "".join(
        f", {f.name} {f.dataType.simpleString()}" for f in rest
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            got = [shared.value.predict(t) for t in column_texts(b.column(1))]
            columns = [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            names = ["doc_id", "lang_pred", "score"] + [f.name for f in rest]
            yield pa.RecordBatch.from_arrays(columns + [b.column(2 + i) for i in range(len(rest))], names=names)

    return picked.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known (not ``und``) with at least ``min_score``."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = (shared.value.predict(t) for t in column_texts(b.column(at)))
            yield b.filter(pa.array([lang != UNKNOWN and p >= min_score for lang, p in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def train_and_predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows that aren't held out (fold 0) only."""
    model = fit(docs.where(fold_of(id_col, folds) != 0), text_col, lang_col)
    found = predict(docs, model, id_col, text_col, ((fold_of(id_col, folds) == 0).alias("held_out"),))
    return found.select("doc_id", "held_out", "lang_pred", "score")
