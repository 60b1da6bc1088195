"""The similarity join against all pairs, and its index against the similarity itself."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formweave.llm import combination_join as join
from formweave.llm.blocks import U64, mix
from tests.llm import brute
from tests.llm.conftest import near, sentence


def joined(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def expected(docs, width=5, percent=80):
    return sorted(((d, *v) for d, v in brute.components(docs, width, percent).items()), key=str)


@pytest.mark.parametrize("width, percent", [(5, 80), (2, 80), (1, 60), (3, 95)])
def test_join_against_all_pairs(spark, corpus, corpus_frame, width, percent):
    assert joined(join.similarity_join(corpus_frame, width, percent)) == expected(corpus, width, percent)


def test_large_groups(spark):
    """Groups beyond the limits of all classes: copies of one text edited lightly, some edited in chains, and texts
    that share a passage and little else."""
    base, passage = sentence(1, 90), sentence(2, 40)
    texts = [near(base, i, 0.012) for i in range(330)]
    chain = sentence(3, 120).split(" ")
    for i in range(30):
        chain = chain[:4 * i] + [f"c{i}", *chain[4 * i + 1:]]
        texts.append(" ".join(chain))
    texts += [f"{sentence(100 + i, 15)} {passage} {sentence(900 + i, 15)}" for i in range(280)]
    texts += [passage] * 3 + [passage + " end"] + [f"{passage} {i}" for i in range(30)]
    random.Random(4).shuffle(texts)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert joined(join.similarity_join(frame)) == expected(docs)


def test_odd_rows(spark, corpus, odd, empty):
    assert join.similarity_join(empty).collect() == []
    got = join.similarity_join(odd.withColumn("n", F.lit("x")).withColumn("hub", F.lit("x")).withColumn("tokens", F.lit("x")))
    rows = got.collect()
    assert len(rows) == odd.count()
    known = dict((d, (n, c)) for d, n, c in expected([(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]))
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == known[r.doc_id]
    # Without any id the groups have none.
    nameless = odd.where("doc_id IS NULL").select("doc_id", "text")
    assert {r.component_id for r in join.similarity_join(nameless).collect()} == {None}


def tokens_of(values):
    return mix(np.array(sorted(values), dtype=U64) + U64(1))


@pytest.mark.parametrize("rare, common, percent", [(2, 4, 80), (0, 3, 80), (0, 0, 80), (3, 6, 60), (1, 2, 95)])
def test_similar_sets_share_a_combination(monkeypatch, rare, common, percent):
    monkeypatch.setattr(join, "RARE", rare)
    monkeypatch.setattr(join, "COMMON", common)
    r = random.Random(rare + 10 * common)
    sets = []
    for _ in range(40):
        base = r.sample(range(4000), r.choice([1, 2, 3, 5, 8, 15, 16, 19, 20, 24, 31, 40, 63, 70, 130, 300]))
        sets.append(set(base))
        for _ in range(6):
            other = set(base)
            for _ in range(r.randint(0, max(1, len(base) // 5))):
                if r.random() < 0.6 and len(other) > 1:
                    other.remove(r.choice(sorted(other)))
                else:
                    other.add(r.randrange(4000))
            sets.append(other)
    df = {}
    for s in sets:
        for t in s:
            df[t] = df.get(t, 0) + 1
    made = []
    for s in sets:
        shared = sorted(t for t in s if df[t] > 1)
        counts = np.array([df[t] for t in shared], np.int64)
        made.append(set(join.signatures(tokens_of(shared), counts, len(s), len(s), percent).tolist()))
    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a != b and 100 * len(a & b) >= percent * len(a | b):
                links += 1
                assert made[i] & made[j], (sorted(a), sorted(b))
    assert links > 20


def test_bucket_gives_each_shared_token_once(monkeypatch):
    """However the rows of a bucket are cut, a set gets each token that others have once, common ones marked alike."""
    monkeypatch.setattr(join, "COMMON", 5)
    r = np.random.default_rng(3)
    sets = [np.unique(np.minimum(r.zipf(1.3, 60), 500)).astype("<u4") for _ in range(50)]
    df = np.bincount(np.concatenate(sets), minlength=501)
    for settle_every in (1, 7, 100):
        bucket, rows = join.Bucket(3), []
        for i, s in enumerate(sets):
            one = np.array([len(s)], "<u4").tobytes()
            bucket.add({"keys": i.to_bytes(16, "big"), "counts": one, "tokens": s.tobytes()})
            if i % settle_every == settle_every - 1:
                rows += [x for b in bucket.settle(last=False) for x in b.to_pylist()]
        rows += [x for b in bucket.settle(last=True) for x in b.to_pylist()]
        got = {i: {} for i in range(50)}
        for row in rows:
            for token, n in np.frombuffer(row["postings"], join.POSTING).tolist():
                mine = got[int.from_bytes(row["key"], "big")]
                assert token not in mine
                mine[token] = n
        assert got == {i: {int(t): min(int(df[t]), 6) for t in s if df[t] > 1} for i, s in enumerate(sets)}
