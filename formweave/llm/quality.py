"""Quality classifier with supervised subword embeddings.

Words and character n-grams of a document are hashed into one table of learned vectors; the document is the average
of its vectors, and a softmax layer tells the classes. An average of single words cannot see a word said over and over,
so the word bigrams of two equal words share one more entry of the table. Vectors and layer are trained together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows with as many of either class; the shares of the
classes among all labelled rows are put back into the scores.

Scoring is linear in the average, so each table entry is reduced to one number before it goes to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import SPACES, U64, Spans, block_of, blocks, code_points, grams, held_out, ship, slices, words
from formweave.llm.langid import softmax

BITS = 16
REPEAT = 1 << BITS  # the entry of two equal words in a row
ENTRIES = REPEAT + 1
ORDERS = (2, 3, 4)
SIZE = 16


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed words, repeated words and character n-grams with their texts."""
    block = block_of(texts)
    starts, ends, owner = words(block, SPACES)
    hashes = Spans(block.data).at(starts, ends)
    yield (hashes >> U64(64 - BITS)).astype(np.int64), owner
    again = owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])]
    yield np.full(len(again), REPEAT, np.int64), again
    points, last, of = code_points([t.decode() for t in texts])
    for n in ORDERS:
        yield grams(points, last, of, n, BITS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids_out, counts_out = [], []
        for text in batch.column(1).to_pylist():
            ids, count = np.unique(np.concatenate([i for i, _ in features([(text or "").encode()])]),
                                   return_counts=True)
            ids_out.append(ids.astype("<i4").tobytes())
            counts_out.append(count.astype("<i4").tobytes())
        yield pa.record_batch([batch.column(0), pa.array(ids_out, pa.binary()), pa.array(counts_out, pa.binary())],
                              names=["label", "ids", "counts"])


@dataclass
class Model:
    values: np.ndarray  # what an entry adds to the odds of class 1, before averaging
    bias: float


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.5,
        seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, layer and bias from (class, features, counts) rows by plain stochastic gradient descent."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / SIZE, 1 / SIZE, (ENTRIES, SIZE)).astype(np.float32)
    layer, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    steps = epochs * len(rows)
    for step in range(steps):
        if step % len(rows) == 0:
            order = random.permutation(len(rows))
        label, ids, counts = rows[order[step % len(rows)]]
        if not len(ids):
            continue
        speed = np.float32(rate * (1 - step / steps))
        share = (counts / counts.sum()).astype(np.float32)
        average = share @ vectors[ids]
        gradient = softmax(average @ layer + bias)
        gradient[label] -= 1.0
        back = layer @ gradient
        layer -= speed * np.outer(average, gradient)
        bias -= speed * gradient
        # An entry's rate grows with the number of entries, or the average would hardly move.
        vectors[ids] -= speed * len(ids) ** np.float32(0.5) * share[:, None] * back[None, :]
    return vectors, layer, bias


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1500) -> Model:
    """Learn from at most ``per_class`` labelled rows of either class, chosen by a hash of the id among the rows
    that are not held out. A document with contradicting labels counts as class 0; labels that are null, or other
    than 0 and 1, are left out. With one class only, every score is that class's."""
    ship(docs.sparkSession)
    marks = labels.select("doc_id", F.col(label).alias("label")).where("label IN (0, 1)").groupBy("doc_id").agg(
        F.min("label").cast("int").alias("label")).where(~held_out())
    shares = {r["label"]: r["rows"] for r in marks.groupBy("label").agg(F.count("*").alias("rows")).collect()}
    chosen = None
    for kind in (0, 1):
        some = marks.where(F.col("label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most 2 * per_class rows.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(
        F.xxhash64("doc_id", F.lit("order")), "doc_id", "text")
    rows = texts.select("label", "text").mapInArrow(_counts, "label int, ids binary, counts binary").collect()
    examples = [(r["label"], np.frombuffer(r["ids"], "<i4").astype(np.int64),
                 np.frombuffer(r["counts"], "<i4").astype(np.float32)) for r in rows]
    seen = [sum(e[0] == k for e in examples) for k in (0, 1)]
    if not all(seen):
        return Model(np.zeros(ENTRIES, np.float32), 20.0 if seen[1] else -20.0 if seen[0] else 0.0)
    vectors, layer, bias = fit(examples)
    prior = np.log(shares[1] / shares[0]) - np.log(seen[1] / seen[0])
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0] + prior))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        scores: list[np.ndarray] = []
        for _, block in blocks(batch, "text", 500_000):
            n = len(block.texts)
            sums, counts = np.zeros(n), np.zeros(n)
            for ids, owner in features(block.texts):
                counts += np.bincount(owner, minlength=n)
                sums += np.bincount(owner, model.values[ids], minlength=n)
            scores.append(1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + model.bias))))
        yield pa.record_batch([batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                              names=["doc_id", "score"])


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted of each row of ``docs``; a null or empty text has the score of the bias alone."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", "text")
    sent = spark.sparkContext.broadcast(model)  # one number per entry
    scored = rows.mapInArrow(lambda b: _score(b, sent.value), f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
