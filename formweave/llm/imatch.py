"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds the terms whose document frequency lies in a band: rare enough to tell, frequent enough to be
shared. From it several sub-lexicons are drawn by hash, at rates from one term in four to one in 1,024. For each
sub-lexicon the distinct terms a document has in it are sorted and hashed to 8 bits; the fingerprint is the row of
these hashes, and a 64-bit hash of all distinct terms of the document.

Where few terms change, many sub-lexicons have none of them and keep their hash. Whether a sub-lexicon is small
enough to show that depends on the document's length, so likeness is the share of equal hashes at the rate where it
is highest, among the rates at which at least ``USED`` sub-lexicons have a term of either document. With about one
term in a sub-lexicon that share is the share of common terms. Two documents without a term in any sub-lexicon are
alike if all their terms are the same.

Frequencies are exact over all documents: tasks count what they hold, and the counts are summed by term. The lexicon
has at most (mean distinct terms of a document) / low terms however many documents there are, and so can go to every
task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import (LOWERED, SPACES, U64, Block, Spans, block_of, blocks, mix, ship,
                                  shuffle_partitions, slices, sort_within, words)

LOW, HIGH = 0.001, 0.05
RATES = {4: 32, 16: 64, 64: 64, 256: 64, 1024: 64}  # sub-lexicons with one term in so many
USED = 6
WHOLE_BYTES = 8  # of the hash of all terms
HELD_TERMS = 1_000_000  # that a task counts before it passes them on


def distinct_terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes of each text of a block, and their texts."""
    starts, ends, owner = words(block, SPACES)
    hashes = Spans(LOWERED[block.data]).at(starts, ends)
    sort_within(hashes, np.searchsorted(owner, np.arange(len(block.texts) + 1)))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], owner[fresh]


# ---- lexicon -----------------------------------------------------------------------------------------------


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    terms, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    return terms, np.bincount(at, np.concatenate([c for _, c in parts]), len(terms)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms and the number of this task's texts they are in, in portions."""
    empty = [(np.zeros(0, U64), np.zeros(0, np.int64))]
    parts, held = list(empty), 0

    def portion() -> pa.RecordBatch:
        terms, counts = parts[0]
        return pa.record_batch([pa.array(terms.view(np.int64)), pa.array(counts)], names=["term", "df"])

    for batch in slices(batches):
        for _, block in blocks(batch, "text"):
            parts.append(np.unique(distinct_terms(block)[0], return_counts=True))
            held += len(parts[-1][0])
            if held > HELD_TERMS:
                parts = [_merge(parts)]
                held = len(parts[0][0])
                if held > HELD_TERMS // 2:
                    yield portion()
                    parts, held = list(empty), 0
    parts = [_merge(parts)]
    yield portion()


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in a share of ``low`` to ``high`` of all documents, and in two at least."""
    ship(docs.sparkSession)
    n = docs.count()
    counts = docs.select("text").mapInArrow(_count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    band = counts.where((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= max(2.0, high * n))).select("term")
    return np.sort(band.toPandas()["term"].to_numpy(np.int64).view(U64))


# ---- fingerprints ------------------------------------------------------------------------------------------


def subsets(terms: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each draw the sub-lexicon of each term, and their number; terms from that number on are in none. A draw
    at a rate makes as many disjoint sub-lexicons as are wanted at it, or as the rate allows."""
    draw = 0
    for rate, wanted in RATES.items():
        while wanted > 0:
            draw += 1
            seed = mix(np.array([draw], U64) * U64(0x9E3779B97F4A7C15))[0]
            yield (mix(terms ^ seed) % U64(rate)).astype(np.int64), min(wanted, rate)
            wanted -= rate


def fingerprints(block: Block, terms: np.ndarray) -> np.ndarray:
    """One row of 8-bit hashes per text, 0 where it has no term in the sub-lexicon, and of the bytes of the hash of all
    its terms, 0 if it has none."""
    n = len(block.texts)
    found, owner = distinct_terms(block)
    whole = np.zeros(n, U64)
    np.add.at(whole, owner, mix(found ^ U64(0x2545F4914F6CDD1D)))
    at = np.minimum(np.searchsorted(terms, found), max(len(terms) - 1, 0))
    use = terms[at] == found if len(terms) else np.zeros(len(found), bool)
    found, owner = found[use], owner[use]
    # The hash of a sorted list of distinct terms: the sum of their mixed values, mixed again.
    value = mix(found ^ U64(0x5851F42D4C957F2D))
    parts = []
    for which, count in subsets(found):
        inside = which < count
        sums = np.zeros(n * count, U64)
        np.add.at(sums, owner[inside] * count + which[inside], value[inside])
        parts.append(sums.reshape(n, count))
    out = np.concatenate(parts, 1)
    short = np.where(out == 0, U64(0), (mix(out) % U64(255)) + U64(1)).astype(np.uint8)
    return np.concatenate([short, whole.astype(">u8").view(np.uint8).reshape(n, WHOLE_BYTES)], 1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of fingerprints; equal ones have 1."""
    all_terms = (a[:, -WHOLE_BYTES:] == b[:, -WHOLE_BYTES:]).all(1)
    a, b = a[:, :-WHOLE_BYTES], b[:, :-WHOLE_BYTES]
    used = (a != 0) | (b != 0)
    same = (a == b) & (a != 0)
    n_used, n_same = used.sum(1), same.sum(1)
    whole = np.where(n_used == 0, all_terms, n_same / np.maximum(n_used, 1))
    best = np.full(len(a), -1.0)
    start = 0
    for wanted in RATES.values():
        u, s = used[:, start: start + wanted].sum(1), same[:, start: start + wanted].sum(1)
        best = np.where(u >= USED, np.maximum(best, s / np.maximum(u, 1)), best)
        start += wanted
    return np.where(best < 0, whole, best)


def as_text(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


def edited(text: str, following: str) -> str:
    """The second half of a text replaced by the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows in order of (bucket, ghost, id); the last row of a bucket is a ghost: the first of the next bucket."""
    held: list[tuple] = []
    size = 0

    def flush(rows: list[tuple]) -> pa.RecordBatch | None:
        texts = [r[3] or "" for r in rows]
        own = fingerprints(block_of([t.encode() for t in texts]), terms)
        at = np.array([i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]], np.int64)
        if not len(at):
            return None
        changed = [edited(texts[i], texts[i + 1]) for i in at]
        raw = [t.encode() for t in changed]
        other = fingerprints(block_of(raw), terms)
        return pa.record_batch([
            pa.array([rows[i][2] for i in at]), pa.array([len(texts[i]) for i in at], pa.int64()),
            pa.array([hashlib.sha256(r).hexdigest() for r in raw]), pa.array(as_text(own[at])), pa.array(as_text(other)),
            pa.array(likeness(own[at], other)), pa.array(likeness(own[at], own[at + 1]))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                   "near_next"])

    for batch in slices(batches):
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(r)
            size += len(r[3] or "")
            if size > 1_000_000 and len(held) > 1:
                out = flush(held)
                if out is not None:
                    yield out
                held, size = held[-1:], len(r[3] or "")
    if len(held) > 1:
        out = flush(held)
        if out is not None:
            yield out


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, ghost, doc_id, text) dealt out by id ranges, each range followed by the first row of the next
    one (the last by the first of all). Split points and first ids are as many as buckets."""
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    ids = docs.select("doc_id")
    points = ids.agg(F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 100 * buckets)).first()[0]
    splits = [float("-inf"), *sorted({float(p) for p in points or []}), float("inf")]
    rows = docs.select("doc_id", "text").withColumn("position", F.coalesce(F.col("doc_id").cast("double"),
                                                                           F.lit(float("-inf"))))
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="position", outputCol="place").transform(rows)
    else:
        rows = rows.withColumn("place", F.lit(0.0))
    rows = rows.select(F.col("place").cast("int").alias("bucket"), "doc_id", "text")
    firsts = sorted((r["bucket"], r["first"]) for r in rows.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("f")).select(
            "bucket", F.col("f.doc_id").alias("first")).collect()) if docs.take(1) else []
    if not firsts:
        return rows.withColumn("ghost", F.lit(False)).select("bucket", "ghost", "doc_id", "text")
    heads = spark.createDataFrame([(first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)],
                                  f"first {dict(rows.dtypes)['doc_id']}, before int")
    ghosts = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first"))).select(
        F.col("before").alias("bucket"), F.lit(True).alias("ghost"), "doc_id", "text")
    return rows.select("bucket", F.lit(False).alias("ghost"), "doc_id", "text").unionByName(ghosts)


def fingerprint(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row.

    The next document is the next id; rows with equal ids follow each other by a hash of the text, null ids come
    first, and the last row is followed by the first. A null text counts as empty; an empty text has no terms.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(terms)  # bounded: see above
    placed = _in_order(docs).repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions(
        "bucket", "ghost", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    kind = dict(placed.dtypes)["doc_id"]
    return placed.mapInArrow(
        lambda b: _compare(b, sent.value),
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
