"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are lower-cased character n-grams of one to three characters, hashed. A feature's value is its share of
the document's n-grams times its inverse document frequency, which is counted over all documents that may be
learned from. The model is trained with follow-the-regularised-leader and an elastic net (per-coordinate rates,
weights below the L1 threshold exactly zero) on a bounded sample of labelled rows, the same number for each
language; a quarter of the sample is kept back to fit the temperature that calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import code_points, grams, held_out, materialise, ship, slices

BITS = 15
ORDERS = (1, 2, 3)
SCALE = 50.0  # brings the shares to a size at which the training rates work
BLOCK_CHARS = 500_000
UNKNOWN = "und"


def text_blocks(column: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Whole texts, a bounded number of characters at a time; null counts as empty."""
    held, size = [], 0
    for text in column.to_pylist():
        text = text or ""
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams and their texts, one order after the other."""
    points, ends, owner = code_points([t.lower() for t in texts])
    for n in ORDERS:
        yield grams(points, ends, owner, n, BITS)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BITS, np.int64)
    for batch in slices(batches):
        for texts in text_blocks(batch.column(0)):
            for at in range(0, len(texts), 64):
                part = texts[at: at + 64]
                seen = np.zeros(len(part) << BITS, bool)
                for ids, owner in features(part):
                    seen[(owner << BITS) + ids] = True
                total += seen.reshape(len(part), -1).sum(0)
    which = np.flatnonzero(total)
    yield pa.record_batch([pa.array(which, pa.int32()), pa.array(total[which])], names=["feature", "df"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids_out, counts_out = [], []
        for text in batch.column(2).to_pylist():
            ids, count = np.unique(np.concatenate([i for i, _ in features([text])]), return_counts=True)
            ids_out.append(ids.astype("<i4").tobytes())
            counts_out.append(count.astype("<i4").tobytes())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ids_out, pa.binary()),
                               pa.array(counts_out, pa.binary())], names=["lang", "tune", "ids", "counts"])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages, inverse document frequency and scale included
    bias: np.ndarray
    temperature: float = 1.0


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, alpha: float = 0.3, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.5, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from (class, features, values) rows. The rows are passed in the order given, so the result
    is the same each time."""
    size = 1 << BITS
    z, n = np.zeros((size + 1, n_classes)), np.zeros((size + 1, n_classes))

    def weights(ids):
        zi = z[ids]
        return np.where(np.abs(zi) <= l1, 0.0,
                        -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[ids])) / alpha + l2))

    for _ in range(epochs):
        for label, ids, values in rows:
            ids, values = np.append(ids, size), np.append(values, 1.0)  # the last feature is the bias
            w = weights(ids)
            gradient = softmax(values @ w)
            gradient[label] -= 1.0
            g = values[:, None] * gradient
            grown = n[ids] + g * g
            z[ids] += g - (np.sqrt(grown) - np.sqrt(n[ids])) / alpha * w
            n[ids] = grown
    w = weights(np.arange(size + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, on a fine grid."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, per_language: int = 800) -> Model:
    """Learn from the rows that are not held out and have a language and a text: about ``per_language`` of each
    language, chosen by a hash of the id. All of these rows count for the document frequencies."""
    ship(docs.sparkSession)
    usable = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("text").isNotNull())
    df = usable.select("text").mapInArrow(_document_frequencies, "feature int, df bigint").groupBy("feature").agg(
        F.sum("df").alias("df")).collect()
    n_docs = usable.count()
    idf = np.full(1 << BITS, np.log(1.0 + n_docs) + 1.0)
    for r in df:
        idf[r["feature"]] = np.log((1.0 + n_docs) / (1.0 + r["df"])) + 1.0

    labelled = usable.where("lang IS NOT NULL")
    # Written first, so that its size is known and no text is shuffled by language.
    per = materialise(labelled.groupBy("lang").agg(F.count("*").alias("rows")).select(F.col("lang").alias("of"), "rows"),
                      "languages")
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    sample = labelled.join(per, F.col("lang") == F.col("of")).where(lot * F.col("rows") < per_language)
    order = F.xxhash64("doc_id", F.lit("order"))
    rows = (sample.orderBy(order, "doc_id", "text").select("lang", (F.pmod(order, F.lit(4)) == 0).alias("tune"), "text")
            .mapInArrow(_counts, "lang string, tune boolean, ids binary, counts binary").collect())
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    index = {x: i for i, x in enumerate(languages)}

    def example(r):
        ids = np.frombuffer(r["ids"], "<i4").astype(np.int64)
        counts = np.frombuffer(r["counts"], "<i4").astype(float)
        return index[r["lang"]], ids, SCALE * counts / max(counts.sum(), 1.0) * idf[ids]

    weights, bias = fit_ftrl([example(r) for r in rows if not r["tune"]], len(languages))
    kept_back = [example(r) for r in rows if r["tune"]]
    logits = np.array([v @ weights[i] + bias for _, i, v in kept_back]).reshape(-1, len(languages))
    temperature = fit_temperature(logits, np.array([c for c, _, _ in kept_back], np.int64))
    return Model(languages, (SCALE * idf[:, None] * weights).astype(np.float32), bias, temperature)


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    n_classes = len(model.languages)
    for batch in slices(batches):
        langs: list[str] = []
        scores: list[float] = []
        for texts in text_blocks(batch.column(0)):
            n = len(texts)
            if not n_classes:
                langs += [UNKNOWN] * n
                scores += [0.0] * n
                continue
            sums, counts = np.zeros((n, n_classes)), np.zeros(n)
            for ids, owner in features(texts):
                counts += np.bincount(owner, minlength=n)
                for c in range(n_classes):
                    sums[:, c] += np.bincount(owner, model.weights[:, c][ids], minlength=n)
            letters = np.array([any(map(str.isalpha, t)) for t in texts])
            p = softmax((sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
            best = p.argmax(1)
            langs += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
            scores += np.where(letters, p[np.arange(n), best], 0.0).tolist()
        yield pa.record_batch([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                              names=[*batch.schema.names[1:], "lang_pred", "score"])


def predict(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, lang_pred and score of each row of ``docs``. A text that is null or has no letter is
    ``und`` with score 0, as is every text if no language was learned."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("text").alias("_text"), *carry)
    sent = spark.sparkContext.broadcast(model)  # at most 2**BITS weights per language
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[1:])
    return rows.mapInArrow(lambda b: _predict(b, sent.value), f"{schema}, lang_pred string, score double")
