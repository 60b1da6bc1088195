"""Components of links: right for any graph, and no more rounds, tasks or files than it takes."""

import random

import pytest

from formweave.llm import combination_join, hyperminhash
from formweave.llm.blocks import few
from tests.llm import brute
from tests.llm.conftest import near, sentence


def least(edges):
    label = {x: x for edge in edges for x in edge if edge[0] != edge[1]}
    for _ in label:
        for a, b in edges:
            if a in label:
                label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.fixture
def written(monkeypatch):
    """Labels of the tables that ``components`` writes."""
    labels, write = [], hyperminhash.materialise
    monkeypatch.setattr(hyperminhash, "materialise", lambda frame, label: labels.append(label) or write(frame, label))
    return labels


def graph(kind):
    r = random.Random(kind)
    if kind == "chain":
        nodes = r.sample(range(1000), 40)
        return list(zip(nodes, nodes[1:]))
    if kind == "hub":
        return [(500, x) for x in range(460, 540)] + [(700, 701), (701, 700), (3, 3)]
    return [(r.randrange(60), r.randrange(60)) for _ in range(45)]


@pytest.mark.parametrize("kind", ["chain", "hub", "random"])
def test_components_of_any_graph(spark, kind):
    edges = graph(kind)
    found = hyperminhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.label for r in found} == least(edges)


def test_stars_take_no_round(spark, written):
    edges = [(10 * i, 10 * i + j) for i in range(5) for j in range(1, 6)]
    found = hyperminhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.label for r in found} == least(edges)
    assert written == ["links"]
    assert hyperminhash.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
    assert written == ["links"] * 2


def test_a_hub_takes_one_round(spark, written):
    hyperminhash.components(spark.createDataFrame([(50, x) for x in range(1, 100)], "a bigint, b bigint"))
    assert written == ["links", "stars"]


def test_join_follows_new_links_only(spark, monkeypatch):
    """The links to hubs are followed once; after that a component is one node."""
    sent, follow = [], combination_join.components
    monkeypatch.setattr(combination_join, "components", lambda edges: sent.append(edges.count()) or follow(edges))
    base = sentence(1, 90)
    chain, texts = sentence(3, 120).split(" "), [near(base, i, 0.012) for i in range(60)]
    for i in range(30):
        chain = chain[:4 * i] + [f"c{i}", *chain[4 * i + 1:]]
        texts.append(" ".join(chain))
    docs = list(enumerate(texts))
    rows = combination_join.similarity_join(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(brute.components(docs, 5, 80))
    assert sent[-1] < sent[0] / 2


def test_few_tasks_for_short_rows(spark):
    parts, cores = (int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = spark.range(1000).repartition(400)
    assert few(rows).rdd.getNumPartitions() == max(parts // 8, 2 * cores)
    assert few(rows).count() == 1000
