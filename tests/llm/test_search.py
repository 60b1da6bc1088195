"""Ranked search against scores of every document in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from formweave.llm import fp_search
from tests.llm.brute import lowered
from tests.llm.conftest import sentence

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def ranked(docs, items, top=10):
    """(item_id, rank, doc_id, score) rows."""
    counts = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            m = 25 + 75 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in TERM.findall(lowered(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(corpus):
    texts = [t for _, t in corpus if t]
    r = random.Random(1)
    made = [(i, " ".join(r.choices(re.findall(r"\S+", r.choice(texts)), k=r.randint(1, 30)))) for i in range(25)]
    return [*made, (25, None), (26, ""), (27, "?!"), (28, "word nobody has"), (3, "one one ONE"), (None, "two words"),
            (29, sentence(5, 9000))]


@pytest.mark.parametrize("item_bytes", [fp_search.ITEM_BYTES, 20_000])
def test_search_against_every_document(spark, corpus, corpus_frame, item_bytes):
    items = items_of(corpus)
    frame = spark.createDataFrame(items, ITEMS)
    assert got(fp_search.search_items(corpus_frame, frame, item_bytes=item_bytes)) == ranked(corpus, items)


def test_odd_tables(spark, corpus, odd, empty):
    items = items_of(corpus)
    frame = spark.createDataFrame(items, ITEMS).withColumn("rank", F.lit("clash")).withColumn("doc_id", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(fp_search.search_items(odd.withColumn("n", F.lit("x")).withColumn("item", F.lit("x")), frame)) == ranked(rows, items)
    assert got(fp_search.search_items(empty, frame)) == []
    assert got(fp_search.search_items(odd, spark.createDataFrame([], ITEMS))) == []


def test_branch_and_bound_cuts_nothing_it_needs():
    """Trees of skewed vectors, with many ties: the best ten are those of scoring every document."""
    r = np.random.default_rng(7)
    terms, tf = [], []
    for i in range(3000):
        held = np.unique(np.minimum(r.zipf(1.4, r.integers(1, 25)) - 1, 199)) if i % 3 else np.array([0, 3, 9])
        terms.append(held.astype(np.int64))
        tf.append(r.integers(1, 6, len(held)) if i % 3 else np.array([1, 1, 2]))
    ids, m = r.permutation(3000).astype(np.int64), np.where(np.arange(3000) % 3, r.integers(30, 400, 3000), 50)
    tree = fp_search.Tree(ids, m, terms, tf)
    cut = 0
    for _ in range(60):
        wanted = np.unique(r.integers(0, 200, r.integers(1, 12)))
        weights = r.integers(0, 5000, len(wanted))
        weight_of = np.zeros(200, np.int64)
        weight_of[wanted] = weights
        best = fp_search.Best(10)
        scored = fp_search.search(tree, wanted, weights, weight_of, best)
        every = sorted(((int((weight_of[t] * fp_search.gain(f, np.full(len(t), k))).sum()), -int(d))
                        for t, f, k, d in zip(terms, tf, m, ids)), reverse=True)
        assert sorted(best.heap, reverse=True) == [e for e in every[:10] if e[0] > 0]
        cut += scored < sum(not c for c in tree.children)
    assert cut > 30


def test_tree_shares_paths():
    same = [np.array([0, 2, 5])] * 100
    tree = fp_search.Tree(np.arange(100), np.full(100, 40), same, [np.array([1, 1, 1])] * 100)
    assert len(tree.start) == 1 and tree.least_id[0] == 0
    assert fp_search.Tree(np.zeros(0, np.int64), np.zeros(0, np.int64), [], []).start == []
