"""Ranked lexical search over trees of documents.

Only terms of the queries matter, so each document becomes a vector of the query terms it holds. Terms are numbered by
falling document frequency, and the vectors of some thousand documents, written in that order, form a trie in which
documents with the same frequent terms share a path (an FP-tree). A subtree keeps the largest tf of each of its terms
and the least m of its documents. With these no document below can score more than the sum of the terms' scores, so a
depth-first search that takes the best subtree first leaves out whatever cannot enter the item's best ten.

Unary paths are one node, and neighbouring subtrees of few documents are one leaf, whose documents are scored exactly.
A task carries the best ten of each item from one tree to the next, so that later trees are cut earlier.

Counts of documents and terms cover the whole corpus. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.blocks import block_of, blocks, materialise, ship, slices
from formweave.llm.decontaminate import word_hashes

TOP = 10
ITEM_BYTES = 2 << 20
TREE_DOCS, TREE_TERMS, LEAF = 4096, 1_000_000, 32
NO_ID = np.iinfo(np.int64).max


# ---- queries and vectors -----------------------------------------------------------------------------------


class Queries:
    """Items as term numbers, and the vocabulary of all of them as sorted hashes."""

    def __init__(self, texts: list[bytes]):
        hashes, owner = word_hashes(block_of(texts))
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        found = [np.unique(numbers[owner == i], return_counts=True) for i in range(len(texts))]
        self.terms = [t for t, _ in found]
        self.repeats = [n.astype(np.int64) for _, n in found]


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = max(len(vocabulary), 1)
    for batch in slices(batches):
        for rows, block in blocks(batch, "text"):
            n = len(block.texts)
            hashes, owner = word_hashes(block)
            at = np.minimum(np.searchsorted(vocabulary, hashes), size - 1)
            known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
            pairs, tf = np.unique(owner[known] * size + at[known], return_counts=True)
            terms, bounds = (pairs % size).astype("<i4"), np.searchsorted(pairs // size, np.arange(n + 1))
            tf = tf.astype("<i4")
            spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            yield pa.record_batch([
                batch.column(0).slice(rows.start, n), pa.array(np.bincount(owner, minlength=n), pa.int64()),
                pa.array([terms[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([tf[a:b].tobytes() for a, b in spans], pa.binary())], names=["doc_id", "n", "terms", "tf"])


def _document_counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(size, np.int64)
    for batch in batches:
        counts += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
    held = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(held, pa.int32()), pa.array(counts[held])], names=["term", "df"])


@dataclass
class Statistics:
    """What scores rest on: documents with a term, terms with repeats, and documents per term of the vocabulary."""

    documents: int
    length: int
    df: np.ndarray
    weight: np.ndarray = field(init=False)
    rank: np.ndarray = field(init=False)

    def __post_init__(self):
        self.weight = np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * d + 1)))
                                for d in self.df.tolist()], np.int64)
        # The most frequent term comes first.
        self.rank = np.empty(len(self.df), np.int64)
        self.rank[np.lexsort((np.arange(len(self.df)), -self.df))] = np.arange(len(self.df))

    def norm(self, n: np.ndarray) -> np.ndarray:
        return 100 - 75 + (75 * n * self.documents) // self.length


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's score before its weight; grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ---- trees -------------------------------------------------------------------------------------------------


class Tree:
    """An FP-tree over documents: node k covers the documents start[k] to end[k] of the sorted order."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, terms: list[np.ndarray], tf: list[np.ndarray]):
        """``terms`` are numbers by frequency, ascending within a document."""
        paths = [t.astype(">u4").tobytes() for t in terms]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.ids, self.m = ids[order], m[order]
        self.paths = [paths[i] for i in order]
        self.bounds = np.concatenate([[0], np.cumsum([len(terms[i]) for i in order])]).astype(np.int64)
        self.terms = np.concatenate([terms[i] for i in order]) if order else np.zeros(0, np.int64)
        self.tf = np.concatenate([tf[i] for i in order]) if order else np.zeros(0, np.int64)
        self.start: list[int] = []
        self.end: list[int] = []
        self.children: list[list[int]] = []
        self._grow(0, len(order))
        self.least_m = np.array([self.m[a:b].min() for a, b in zip(self.start, self.end)], np.int64)
        self.least_id = np.array([self.ids[a:b].min() for a, b in zip(self.start, self.end)], np.int64)
        self._maxima()

    def _node(self, a: int, b: int) -> int:
        self.start.append(a)
        self.end.append(b)
        self.children.append([])
        return len(self.start) - 1

    def _grow(self, a: int, b: int) -> None:
        todo = [(self._node(a, b), 0)] if b > a else []
        while todo:
            node, depth = todo.pop()
            a, b = self.start[node], self.end[node]
            # Sorted paths share what the first and the last share: a unary path is passed over.
            first, last = self.paths[a], self.paths[b - 1]
            while first[4 * depth: 4 * depth + 4] == last[4 * depth: 4 * depth + 4] and 4 * depth < len(first):
                depth += 1
            if b - a <= LEAF or first == last:
                continue
            groups, from_ = [], a
            for i in range(a + 1, b + 1):
                if i == b or self.paths[i][4 * depth: 4 * depth + 4] != self.paths[i - 1][4 * depth: 4 * depth + 4]:
                    groups.append((from_, i))
                    from_ = i
            merged = [groups[0]]
            for low, high in groups[1:]:
                if high - merged[-1][0] <= LEAF:
                    merged[-1] = (merged[-1][0], high)
                else:
                    merged.append((low, high))
            for low, high in merged:
                child = self._node(low, high)
                self.children[node].append(child)
                if high - low > LEAF:
                    todo.append((child, depth))

    def _maxima(self) -> None:
        """For each term the nodes that hold it, with its largest tf below: three arrays sorted by term."""
        parts = []
        for node, (a, b) in enumerate(zip(self.start, self.end)):
            low, high = self.bounds[a], self.bounds[b]
            order = np.argsort(self.terms[low:high], kind="stable")
            terms = self.terms[low:high][order]
            firsts = np.flatnonzero(np.diff(terms, prepend=-1))
            if len(firsts):
                parts.append((terms[firsts], np.full(len(firsts), node), np.maximum.reduceat(self.tf[low:high][order], firsts)))
        held, nodes, most = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        order = np.argsort(held, kind="stable")
        self.held, self.nodes, self.most = held[order], nodes[order], most[order]
        self.norms = self.least_m[self.nodes] if len(self.nodes) else self.nodes

    def limits(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The most a document below each node can score. ``terms`` ascend."""
        out = np.zeros(len(self.start), np.int64)
        low, high = np.searchsorted(self.held, terms), np.searchsorted(self.held, terms, side="right")
        counts = high - low
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        np.add.at(out, self.nodes[at], gain(self.most[at], self.norms[at]) * np.repeat(weights, counts))
        return out

    def scores(self, node: int, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents; ``weight_of`` has the item's weight for each term."""
        a, b = self.start[node], self.end[node]
        bounds = self.bounds[a: b + 1]
        terms, tf = self.terms[bounds[0]: bounds[-1]], self.tf[bounds[0]: bounds[-1]]
        sizes = np.diff(bounds)
        sums = np.zeros(len(terms) + 1, np.int64)
        np.cumsum(weight_of[terms] * gain(tf, np.repeat(self.m[a:b], sizes)), out=sums[1:])
        return sums[bounds[1:] - bounds[0]] - sums[bounds[:-1] - bounds[0]]


class Best:
    """The highest scores of an item so far; of equal scores those of the least ids."""

    def __init__(self, top: int):
        self.top, self.heap = top, []

    def cut(self, limit: int, least_id: int) -> bool:
        """Whether documents with at most this score, and no lesser id, cannot enter."""
        return limit <= 0 or (len(self.heap) == self.top and (limit, -least_id) <= self.heap[0])

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        least = self.heap[0][0] if len(self.heap) == self.top else 1
        for i in np.flatnonzero(scores >= max(least, 1)).tolist():
            entry = (int(scores[i]), -int(ids[i]))
            if len(self.heap) < self.top:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def search(tree: Tree, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, best: Best) -> int:
    """Depth-first, best subtree first; returns the leaves it scored."""
    if not tree.start:
        return 0
    limits = tree.limits(terms, weights)
    stack, scored = [0], 0
    while stack:
        node = stack.pop()
        if best.cut(int(limits[node]), int(tree.least_id[node])):
            continue
        below = tree.children[node]
        if below:
            stack += sorted(below, key=limits.__getitem__)
        else:
            scored += 1
            best.offer(tree.scores(node, weight_of), tree.ids[tree.start[node]: tree.end[node]])
    return scored


# ---- tasks -------------------------------------------------------------------------------------------------


def _trees(batches: Iterator[pa.RecordBatch], numbers: Statistics) -> Iterator[Tree]:
    """Trees of up to TREE_DOCS documents and about TREE_TERMS terms; documents without a query term are left out."""
    ids, lengths, terms, tf, size = [], [], [], [], 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for doc_id, n, packed, counts in zip(*columns):
            if not packed:
                continue
            rank = numbers.rank[np.frombuffer(packed, "<i4")]
            order = np.argsort(rank)
            ids.append(NO_ID if doc_id is None else doc_id)
            lengths.append(n)
            terms.append(rank[order])
            tf.append(np.frombuffer(counts, "<i4").astype(np.int64)[order])
            size += len(order)
            if len(ids) >= TREE_DOCS or size >= TREE_TERMS:
                yield Tree(np.array(ids, np.int64), numbers.norm(np.array(lengths, np.int64)), terms, tf)
                ids, lengths, terms, tf, size = [], [], [], [], 0
    if ids:
        yield Tree(np.array(ids, np.int64), numbers.norm(np.array(lengths, np.int64)), terms, tf)


def _ranked(batches: Iterator[pa.RecordBatch], shared, top: int) -> Iterator[pa.RecordBatch]:
    queries, numbers = shared.value
    best = [Best(top) for _ in queries.terms]
    items = []
    for terms, repeats in zip(queries.terms, queries.repeats):
        rank = numbers.rank[terms]
        order = np.argsort(rank)
        items.append((rank[order], (numbers.weight[terms] * repeats)[order]))
    weight_of = np.zeros(len(numbers.df), np.int64)
    for tree in _trees(batches, numbers):
        for (terms, weights), found in zip(items, best):
            weight_of[terms] = weights
            search(tree, terms, weights, weight_of, found)
            weight_of[terms] = 0
    rows = [(i, None if -key == NO_ID else -key, score) for i, found in enumerate(best) for score, key in found.heap]
    yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                          names=["item", "doc_id", "score"])


# ---- the operator ------------------------------------------------------------------------------------------


def search_items(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: of each row of ``items`` the ``top`` documents with the highest score above 0.

    Equal scores rank by ascending doc_id, rows without an id last; repeated rows are documents of their own, and
    repeated items have a ranking each. Null, empty and wordless texts hold no term: such a document is never found, such
    an item finds nothing. Texts are used whole. Items are collected and sent to the tasks in blocks of about
    ``item_bytes`` bytes of text; each block takes a pass over the documents.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.select("item_id", "text").where("text IS NOT NULL")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // item_bytes))
    block = F.pmod(F.xxhash64("text"), F.lit(n_blocks))
    found = [_search_block(docs, asked.where(block == i).orderBy("item_id", "text").collect(), top, items.schema["item_id"])
             for i in range(n_blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_block(docs: DataFrame, rows: list, top: int, id_field) -> DataFrame:
    spark = docs.sparkSession
    queries = Queries([r["text"].encode() for r in rows])
    vocabulary = spark.sparkContext.broadcast(queries.vocabulary)
    vectors = materialise(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        lambda b: _vectors(b, vocabulary.value), "doc_id bigint, n bigint, terms binary, tf binary"), "vectors")
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    counted = vectors.select("terms").mapInArrow(
        partial(_document_counts, size=len(queries.vocabulary)), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(queries.vocabulary), np.int64)
    for row in counted.toLocalIterator():
        df[row.term] = row.df
    numbers = Statistics(total.documents, total.length or 0, df)
    shared = spark.sparkContext.broadcast((queries, numbers))
    best = vectors.where(F.length("terms") > 0).mapInArrow(partial(_ranked, shared=shared, top=top),
                                                         "item int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                  f"item int, item_id {id_field.dataType.simpleString()}")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
