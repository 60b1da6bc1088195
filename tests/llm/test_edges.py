"""Null columns, empty tables, repeated rows and clashing extra columns: every operator and every stage."""

import pyarrow as pa
import pytest

import corpus_pipeline
from formweave.llm import blocks, decontaminate, hyperminhash, imatch, langid, pareto_mix, quality, suffix_dedup, token_counts
from tests.llm.test_operators import MODEL


def labelled(spark, docs):
    from pyspark.sql import functions as F

    return docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))


def items(spark, n=3):
    return spark.createDataFrame([(1, "one two"), (2, None), (None, "ba")][:n], "item_id bigint, text string")


OPERATORS = {
    "tokens": lambda s, d: token_counts.count_tokens(d, MODEL),
    "near": lambda s, d: hyperminhash.near_duplicates(d, 2, 80),
    "mix": lambda s, d: pareto_mix.mix(d),
    "repeats": lambda s, d: suffix_dedup.digest(suffix_dedup.remove_repeats(d)),
    "quality": lambda s, d: quality.score(d, quality.train(d, labelled(s, d))),
    "benchmark": lambda s, d: decontaminate.verdicts(decontaminate.matches(d, items(s))),
    "fingerprints": lambda s, d: imatch.fingerprint(d, imatch.lexicon(d)),
    "language": lambda s, d: langid.predict(d, langid.train(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_keeps_all_rows(spark, odd, empty, name):
    run = OPERATORS[name]
    found = run(spark, odd)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in odd.select("doc_id").collect())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found.collect()) == want
    nothing = run(spark, empty)
    assert nothing.count() == 0 and nothing.schema.names == found.schema.names
    only_null = spark.createDataFrame([(None, None, None, None, None), (5, None, None, None, None)], empty.schema)
    assert run(spark, only_null).count() == 2


def test_no_benchmark_hits_nothing(spark, corpus_frame):
    assert decontaminate.matches(corpus_frame, items(spark, 0)).where("size(hit_words) > 0").count() == 0


def test_repeated_rows_are_judged_alike(spark, odd):
    near = {(r["doc_id"], r["component_id"]) for r in hyperminhash.near_duplicates(odd, 2, 80).where(
        "doc_id IS NOT NULL").collect()}
    assert len(near) == len({d for d, _ in near})
    cut = suffix_dedup.digest(suffix_dedup.remove_repeats(odd)).where("doc_id = 3").collect()
    assert len(cut) == 2 and cut[0] == cut[1] and cut[0]["n_removed"] == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, odd, empty, name, stage):
    sf = "/root/testdata/sf0.001"
    for docs in (odd, empty):
        found = stage(spark, docs, sf)
        assert found.schema.names[:5] == list(corpus_pipeline.COLUMNS)
        if name != "mix":
            assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in empty.schema]
        kept = found.count()
        assert kept <= docs.count()
        assert (kept > 0) == (docs is odd)


def test_rows_of_a_group_go_one_by_one(spark, empty):
    """A copy without an id, or under a repeated id, takes no other row with it; classes without any id are linked."""
    from tests.llm.conftest import sentence

    a, b, c, d, e = (sentence(500 + i, 60) for i in range(5))
    near_e = [e + " " + " ".join(f"zz{i}{k}" for k in range(2)) for i in range(4)]
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (5, a), (5, d), (None, None), (9, near_e[0]),
            *((None, x) for x in (e, *near_e[1:]))]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], empty.schema)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (None, b), (None, c), (5, d), (None, None), (9, near_e[0])], key=str)
    # No class of a chain of near copies but its last has an id: every link is found from full sets without one.
    words = sentence(600, 300).split(" ")
    steps = [" ".join(["q%d" % k for k in range(12 * i)] + words[12 * i:]) for i in range(12)]
    chain = [(None, t) for t in steps[1:]] + [(3, steps[0])]
    found = hyperminhash.near_duplicates(spark.createDataFrame([(i, t, None, None, None) for i, t in chain], empty.schema))
    assert {(r["component_id"], r["kept"]) for r in found.where("doc_id IS NULL").collect()} == {(3, False)}


def test_pipeline_keeps_one_of_each_group(spark, tmp_path, corpus_frame):
    corpus_frame.write.parquet(f"{tmp_path}/documents.parquet")
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out and {24, 25}.isdisjoint(out)
    assert all(r["copies"] >= 1 and r["taken"] == r["copies"] * r["size"] for r in out.values())


def test_workers_get_few_texts_at_once_and_give_memory_back(spark, monkeypatch):
    """Texts come to Python in small batches, smaller ones where the session says so, and free memory is returned
    before and after a task's rows."""
    def longest(limit):
        spark.conf.set(blocks.BATCH_CONF, limit)
        blocks.ship(spark)
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(
            lambda batches: (pa.record_batch([pa.array([b.num_rows])], names=["rows"]) for b in batches), "rows bigint")
        return max(r["rows"] for r in sizes.collect())

    before = spark.conf.get(blocks.BATCH_CONF)
    try:
        assert [longest(n) for n in ("10000", "0", "300")] == [blocks.BATCH_ROWS, blocks.BATCH_ROWS, 300]
    finally:
        spark.conf.set(blocks.BATCH_CONF, before)
    given = []
    monkeypatch.setattr(blocks, "give_back", lambda: given.append(1))
    batch = pa.record_batch([pa.array(range(1200))], names=["x"])
    assert [b.num_rows for b in blocks.slices([batch])] == [512, 512, 176] and len(given) == 2
    monkeypatch.undo()
    blocks.give_back()
