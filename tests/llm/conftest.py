import random

import pytest

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(("ba", "de", "ko", "lu", "mi", "no", "ré", "ß", "tha", "st")) for _ in range(
        r.randint(1, 4))) for _ in range(n))


def near(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"x{r.randint(0, 999)}" for w in text.split(" "))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows with copies, near copies, shared passages and odd texts."""
    texts = [sentence(i, 30 + 5 * i) for i in range(24)]
    shared = sentence(99, 40)
    rows = [*texts, texts[3], texts[3], texts[7].upper(), *(near(texts[20], i, 0.02) for i in range(12)),
            *(near(texts[21], i, 0.06) for i in range(12)), *(f"{texts[i][:90]} {shared} {texts[i + 1][:90]}" for i in range(6)),
            "", None, " \t\n", "one", "one", "two words", "a b a b a b a b", "a" * 300, "a" * 200, "é" * 100,
            "x" + "é" * 60, "123 !!! 456", sentence(5, 9000)]
    return list(enumerate(rows))


@pytest.fixture(scope="session")
def corpus_frame(spark, corpus):
    rows = [(d, t, None if d % 9 == 0 else ("en" if d % 2 else "fr"), None if d % 11 == 0 else f"s{d % 5}",
             len(t) if t is not None else None) for d, t in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark, corpus_frame):
    """Repeated rows, rows without an id, and extra columns named like what the operators use themselves."""
    some = corpus_frame.where("doc_id < 30 OR text IS NULL")
    rows = some.unionByName(some.where("doc_id % 3 = 0")).unionByName(
        some.where("doc_id IN (2, 4)").withColumn("doc_id", F.lit(None).cast("bigint")))
    for name in ("size", "target", "bucket", "set_id", "hash", "kind", "rank", "label", "node", "a", "b", "word", "key",
                 "kept", "removed", "score", "lang_pred", "n_words", "position", "place", "ghost", "digest", "of",
                 "component_id", "copies", "path", "host", "_text", "id", "lot"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows
