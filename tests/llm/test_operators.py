import hashlib
import math
import zlib

import numpy as np
import pytest

from formweave.llm import (blocks, decontaminate, hyperminhash, imatch, langid, pareto_mix, quality, suffix_dedup,
                           token_counts, url_rules)
from tests.llm import brute

sp = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")
MODEL = str(tokenizers.path("piece_bpe_32k.model"))


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def by_id(frame):
    return {r["doc_id"]: r for r in rows(frame)}


# ---- token counts ------------------------------------------------------------------------------------------


def test_token_counts_are_the_librarys(corpus, corpus_frame):
    library = sp.SentencePieceProcessor(model_file=MODEL)
    found = by_id(token_counts.count_tokens(corpus_frame, MODEL, limit=500))
    for d, text in corpus:
        n = len(library.encode(text or ""))
        assert (found[d]["n_bytes"], found[d]["n_tokens"], found[d]["over_limit"]) == (
            len((text or "").encode()), n, n > 500)


@pytest.mark.parametrize("chunk, overlap", [(40, 8), (97, 4), (300, 64)])
def test_spliced_chunks_count_like_whole_texts(spark, corpus, chunk, overlap):
    library = sp.SentencePieceProcessor(model_file=MODEL)
    texts = [t for _, t in corpus if t][:40] + ["日本語のテキスト" * 40, "a\n\n b\t<s> \u2581x \U0001f600" * 30, "z" * 500]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(token_counts.count_tokens(frame, MODEL, chunk_chars=chunk, overlap=overlap))
    assert {d: r["n_tokens"] for d, r in found.items()} == {i: len(library.encode(t)) for i, t in enumerate(texts)}


# ---- near duplicates ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_all_pairs(corpus, corpus_frame, width):
    want = brute.components(corpus, width, 80)
    found = by_id(hyperminhash.near_duplicates(corpus_frame, width, 80))
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in found.items()} == {
        d: (n, c, c == d) for d, (n, c) in want.items()}
    assert len({c for _, c in want.values()}) < len(want)


def test_blocks_of_a_crowded_bucket_are_compared(spark, monkeypatch):
    """Chains: each text is near the next one only, and all share registers with the first."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 4)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(20):
        words[i * 18: i * 18 + 18] = [f"v{i}x{k}" for k in range(18)]
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute.components(docs, 2, 80)
    found = by_id(hyperminhash.near_duplicates(frame, 2, 80))
    assert {d: r["component_id"] for d, r in found.items()} == {d: c for d, (_, c) in want.items()}


def test_registers_estimate_similarity():
    random = np.random.default_rng(1)
    base = random.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    for common in (0, 1000, 2400, 3000):
        other = np.concatenate([base[:common], random.integers(0, 2**63, 3000 - common, dtype=np.uint64)])
        values = np.concatenate([np.sort(base), np.sort(other)])
        regs = hyperminhash.registers(values, np.repeat([0, 1], 3000), 2)
        guess, used = hyperminhash.estimate(regs[:1], regs[1:], np.array([3000]), np.array([3000]))
        assert abs(guess[0] - common / (6000 - common)) < 4 * math.sqrt(0.25 / used[0])


# ---- mixing ------------------------------------------------------------------------------------------------


def test_mix_meets_its_targets(corpus, corpus_frame):
    size = {d: len(brute.re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in corpus}
    source = {r["doc_id"]: r["source"] for r in corpus_frame.collect()}
    want = brute.targets([(source[d], size[d]) for d in size])
    found = by_id(pareto_mix.mix(corpus_frame))
    again = by_id(pareto_mix.mix(corpus_frame.repartition(7)))
    taken = dict.fromkeys(want, 0)
    for d, r in found.items():
        assert r["size"] == size[d] and r["taken"] == r["copies"] * size[d] <= 2 * size[d]
        assert r["target"] == pytest.approx(want[source[d]])
        taken[source[d]] += r["taken"]
    for s, target in want.items():
        held = [size[d] for d in size if source[d] == s and size[d]]
        # A source of which one document is more than half: that document is taken once more or not.
        lone = max(held) > sum(held) / 2
        assert abs(taken[s] - target) <= (max(held) / 2 if lone else max(0.005 * target, min(held) / 2)), s
    assert found == again


def test_long_documents_are_likelier_in_the_mix(spark):
    words = {i: 10 if i < 3000 else 1000 for i in range(3300)}
    docs = spark.createDataFrame([(i, "w " * n, "long" if n > 10 or i % 2 else "short") for i, n in words.items()],
                                 "doc_id bigint, text string, source string")
    found = by_id(pareto_mix.mix(docs, weights=(1, 1), share=0.5, carry=("doc_id", "source")))
    mine = [r for r in found.values() if r["source"] == "long"]
    # 1,500 documents of weight 2 and 300 of weight 16 share the target.
    target = mine[0]["target"]
    level = target / (1500 * 10 * 2 + 300 * 1000 * 16)
    for size, weight, n in ((10, 2, 1500), (1000, 16, 300)):
        share = level * weight
        assert 0 < share < 1
        taken = sum(r["copies"] for r in mine if r["size"] == size)
        assert abs(taken - n * share) < 4 * math.sqrt(n * share * (1 - share)) + 18
    assert abs(sum(r["taken"] for r in mine) - target) <= 5


@pytest.mark.parametrize("most", [1.0, 1.5, 2.0])
def test_no_document_passes_the_most_copies(spark, most):
    docs = spark.createDataFrame([(i, "w " * (1 + i * i), f"s{i % 2}") for i in range(40)],
                                 "doc_id bigint, text string, source string")
    found = by_id(pareto_mix.mix(docs, share=3.0, most=most))
    assert max(r["copies"] for r in found.values()) <= math.ceil(most)
    for r in found.values():  # all sources are full
        assert r["target"] == pytest.approx(most * r["source_size"])
        if most != 1.5:
            assert r["copies"] == most


# ---- repeated passages -------------------------------------------------------------------------------------


def test_repeats_match_every_window(corpus, corpus_frame):
    want = brute.repeats(corpus)
    found = by_id(suffix_dedup.digest(suffix_dedup.remove_repeats(corpus_frame)))
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in found.items()} == want
    assert sum(w[1] for w in want.values()) > 3000


def test_repeats_settled_across_tasks(spark, monkeypatch):
    """Many rows per bucket and per flush; matches that begin and end anywhere."""
    random = np.random.default_rng(3)
    pool = bytes(random.integers(97, 101, 4000, dtype=np.uint8)).decode()
    docs = []
    for i in range(120):
        cuts = random.integers(0, 3900, 3)
        docs.append((i, "".join(pool[c: c + int(random.integers(20, 100))] for c in cuts)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(9)
    want = brute.repeats(docs)
    found = by_id(suffix_dedup.digest(suffix_dedup.remove_repeats(frame)))
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in found.items()} == want


@pytest.mark.parametrize("hot_runs", [1, 4, 1 << 20])
def test_a_common_phrase_is_dealt_over_many_buckets(spark, monkeypatch, hot_runs):
    """A phrase shorter than the width in all documents, with other words around it: some neighbours stand twice."""
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot_runs)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    random = np.random.default_rng(11)
    phrase = "the very same words everywhere"

    def around(n):
        return bytes(random.integers(97, 123, n, dtype=np.uint8)).decode()

    docs = [(i, f"{around(60)}{phrase}{around(60)}") for i in range(200)]
    docs += [(200 + i, f"{around(9)}{docs[3 * i][1][20 + i: 120 - i]}{around(70)}{phrase}{docs[i][1][90:]}") for i in range(40)]
    docs += [(None, docs[5][1]), (300, docs[6][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    found = by_id(suffix_dedup.digest(suffix_dedup.remove_repeats(frame)))
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in found.items()} == brute.repeats(
        docs)

    rows = frame.selectExpr("doc_id id", "xxhash64(text) hash", "text")
    hot = suffix_dedup.hot_grams(rows, 50, 20)
    assert (len(hot[0]) > 0) == (hot_runs < 100)
    batch = pa.record_batch([pa.array([d for d, _ in docs[:200]]), pa.array(range(200)), pa.array([t for _, t in docs[:200]])],
                            names=["id", "hash", "text"])
    held = {}
    for part in suffix_dedup._send_runs([batch], 50, 20, 64, hot):
        for r in part.to_pylist():
            for g in suffix_dedup.unpacked(r["gram"], 5) if r["kind"] else ():
                held.setdefault(int(g), {}).setdefault(r["bucket"], []).append(1)
    common = max(held.values(), key=lambda b: sum(map(len, b.values())))
    assert sum(map(len, common.values())) >= 100
    assert max(map(len, common.values())) <= (20 if hot_runs < 100 else 200)
    # Its windows are dealt out likewise, each with its own bytes.
    (gram,) = (g for g, b in held.items() if b is common)
    looked = [[{"low": np.array([45], "<u4").tobytes(), "size": np.array([30], "<u4").tobytes(),
                "gram": np.array([gram], "<u8").tobytes()}]] * 200
    wanted = batch.append_column("runs", pa.array(looked))
    sizes = {}
    for part in suffix_dedup._send_suffixes([wanted], 50, 64, hot):
        for r in part.to_pylist():
            if r["kind"]:
                sizes[r["bucket"]] = sizes.get(r["bucket"], 0) + int(suffix_dedup.unpacked(r["size"], 4).sum())
    assert sum(sizes.values()) >= 5900
    assert max(sizes.values()) <= (600 if hot_runs < 100 else 6000)


def test_matching_runs_holds_little_more_than_its_bucket():
    """What is made of the rows of a bucket takes less than seven times their own size."""
    import tracemalloc

    import pyarrow as pa

    random = np.random.default_rng(5)
    texts = [bytes(random.integers(97, 123, 4000, np.uint8)).decode() for _ in range(2000)]
    docs = pa.record_batch([pa.array(range(2000), pa.int64()), pa.array(range(2000), pa.int64()), pa.array(texts)],
                           names=["id", "hash", "text"])
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    held = pa.Table.from_batches(list(suffix_dedup._send_runs(iter([docs]), 50, 20, 1, none))).combine_chunks()
    tracemalloc.start()
    for _ in suffix_dedup._match_runs(iter(held.to_batches()), 50):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * held.nbytes


def test_radix_groups_are_equal_windows():
    random = np.random.default_rng(5)
    data = random.integers(97, 99, 3000, dtype=np.uint8)
    place = np.arange(2900)
    ids = place // 290
    (found,) = suffix_dedup.radix_groups(data, place, np.zeros(2900, np.int64), ids, 13)
    first = {}
    for p in place:
        first.setdefault(data[p: p + 13].tobytes(), ids[p])
    assert set(place[found]) == {p for p in place if first[data[p: p + 13].tobytes()] < ids[p]}


# ---- URL rules ---------------------------------------------------------------------------------------------


def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("b.com", "/x/", "block"), ("b.com", "/x/y", "allow"), ("a.b.com", "/", "block"),
             ("", "/", "block"), ("bb.com", "", "block")]
    urls = ["http://b.com/x/1", "https://B.com/x/y?q#f", "http://c.a.b.com/x/y", "http://xb.com/x/", "http://com",
            "http://com/", None, "no scheme", "a://b://c.com/d", "http://b.com?x=/x/", "http://bb.com:80/", "http://z.bb.com",
            "http://.com/", "http://b.com./x/", "ftp://a.b.com/x/y"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows(url_rules.judge(pages, url_rules.rule_table(spark, rules)))}
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            m = brute.re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
            host, path = m[1].lower(), m[2]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else (0, 0, None, "allow")
        assert found[i] == best[2:], url


# ---- classifiers -------------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scores = by_id(quality.score(docs, quality.train(docs, labels)))
    held = [(scores[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(s["predicted"] == q for s, q in held) / len(held) > 0.93
    assert all(0 <= s["score"] <= 1 for s in scores.values())


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = by_id(langid.predict(docs, langid.train(docs)))
    held = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97


def test_held_out_rows_teach_nothing(spark):
    """Changing the labels and languages of held-out rows changes no score."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    other = docs.withColumn("lang", F.when(blocks.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    flipped = labels.withColumn("quality", F.when(blocks.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert by_id(langid.predict(docs, langid.train(docs))) == by_id(langid.predict(docs, langid.train(other)))
    assert by_id(quality.score(docs, quality.train(docs, labels))) == by_id(
        quality.score(docs, quality.train(docs, flipped)))


# ---- benchmark ---------------------------------------------------------------------------------------------


def test_benchmark_hits_match_plain_search(spark, corpus):
    texts = [t for _, t in corpus if t]
    items = [(1, texts[4]), (2, " ".join(texts[5].split()[:6])), (3, None), (4, "!!"), (5, texts[4]), (5, texts[4]),
             (11, texts[9].upper()), (12, "one"), (13, "a a a"), (14, texts[10][30:200])]
    docs = [*corpus, (900, texts[4][:60] + texts[5]), (901, "ONE, two. one!"), (902, "a a a a b a a a"),
            (903, " ".join([*texts[0].split(), *texts[10].split()[5:19], *texts[1].split()]))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute.benchmark_hits(docs, items)
    for limit in (1 << 20, 500):  # one block of items, several blocks
        found = by_id(decontaminate.verdicts(decontaminate.matches(frame, benchmark, max_broadcast=limit)))
        assert {d: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                for d, r in found.items()} == want


def test_longest_matches_are_those_of_plain_search(spark, corpus, monkeypatch):
    def words(text):
        return brute.re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lowered(text or ""))

    texts = [t for _, t in corpus if t]
    items = [(1, texts[4]), (2, " ".join(texts[5].split()[:6])), (3, None), (4, "!!"), (5, texts[4]), (7, "a b c a b c " * 4),
             (12, "one"), (13, "a a a"), (14, texts[10]), (15, "z " * 20)]
    docs = [(i, t) for i, (_, t) in enumerate(corpus) if len(t or "") < 2000]
    docs += [(900, texts[4][:150] + texts[5]), (901, "ONE, two. one!"), (902, "a a a a b a a a"), (903, "Z " * 33),
             (904, " ".join([*texts[0].split(), *texts[10].split()[5:30], *texts[1].split(), *texts[10].split()[2:20]])),
             (905, "b c " + "a b c " * 7 + "x " + "a b c " * 5), (905, "one")]
    want = set()
    for d, text in docs:
        own = words(text)
        for item, other in items:
            theirs = words(other)
            least = min(13, len(theirs))
            for i in range(len(own) if least else 0):
                for j in range(len(theirs)):
                    if i and j and own[i - 1] == theirs[j - 1]:
                        continue
                    n = 0
                    while i + n < len(own) and j + n < len(theirs) and own[i + n] == theirs[j + n]:
                        n += 1
                    if n >= least:
                        want.add((d, item, j, i, n))
    assert len({w[4] for w in want}) > 8
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (1 << 20, 300):
        found = rows(decontaminate.matches(frame, benchmark, max_broadcast=limit, with_spans=True))
        assert {(r["doc_id"], *s) for r in found for s in r["spans"]} == want
    # In small portions, as in large ones.
    hashes, owner = decontaminate.word_hashes(blocks.block_of([(t or "").encode() for _, t in items]))
    tests = decontaminate.TestSuffixes([i for i, _ in items], hashes, owner)
    known = tests.numbers(decontaminate.word_hashes(blocks.block_of([("a b c " * 30 + "z " * 30).encode()]))[0])
    tokens = np.concatenate([[-1], known, [-1] * 13]).astype(np.int32)

    def listed():
        return sorted(m for part in decontaminate.longest_matches(tokens, tests) for m in zip(*(c.tolist() for c in part)))

    whole = listed()
    monkeypatch.setattr(decontaminate, "PORTION", 5)
    assert listed() == whole and len(whole) > 30


def test_what_is_sent_of_the_items_is_bounded(corpus):
    texts = [t.encode() for _, t in corpus if t]
    hashes, owner = decontaminate.word_hashes(blocks.block_of(texts))
    tests = decontaminate.TestSuffixes(list(range(len(texts))), hashes, owner)
    sent = tests.vocabulary.nbytes + tests.words.nbytes + tests.before.nbytes + tests.n_words.nbytes
    assert sent <= 12 * len(hashes) + 12 * len(texts) + 8


# ---- fingerprints ------------------------------------------------------------------------------------------


def test_fingerprints(corpus, corpus_frame):
    found = by_id(imatch.fingerprint(corpus_frame, imatch.lexicon(corpus_frame)))
    texts = [t or "" for _, t in corpus]
    for d, text in enumerate(texts):
        half = len(text) // 2
        changed = text[: len(text) - half] + texts[(d + 1) % len(texts)][:half]
        assert found[d]["n_chars"] == len(text)
        assert found[d]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        if changed == text:
            assert found[d]["near_edited"] == 1 and found[d]["fingerprint"] == found[d]["edited_fingerprint"]
    for a, b in ((3, 24), (24, 25)):
        assert found[a]["fingerprint"] == found[b]["fingerprint"]
    assert found[24]["near_next"] == 1
    long = [d for d, t in enumerate(texts) if 60 < len(t.split()) < 400 and d < 23]
    assert np.mean([found[d]["near_edited"] for d in long]) > 5 * np.mean([found[d]["near_next"] for d in long])


def test_likeness_tells_half_edited_texts_from_others(spark):
    """At the likeness that 0.5 % of next documents pass, 0.9 of the texts whose second half was replaced pass too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = rows(imatch.fingerprint(docs, imatch.lexicon(docs)))
    edge = np.quantile([r["near_next"] for r in found], 0.995)
    assert np.mean([r["near_edited"] > edge for r in found]) >= 0.9


def test_one_word_changes_little_of_a_fingerprint():
    """Also of a text with few terms of the lexicon."""
    block = blocks.block_of([b"l1 l2 l3 l4 rare", b"l1 l2 l3 other rare", b"l1 l2 l3 l4 rare", b"x y", b"x z", b"y x", b"", b""])
    terms = np.sort(imatch.distinct_terms(blocks.block_of([b"l1 l2 l3 l4"]))[0])
    prints = imatch.fingerprints(block, terms)
    def near(i, j):
        return imatch.likeness(prints[i: i + 1], prints[j: j + 1])[0]
    assert 0.3 < near(0, 1) < 1 and near(0, 2) == 1 and (prints[0] == prints[2]).all()
    assert near(3, 4) == 0 and near(3, 5) == 1 and near(6, 7) == 1 and near(3, 6) == 0 and near(0, 3) == 0


def test_terms_are_passed_on_in_portions(corpus_frame, monkeypatch):
    import pyarrow as pa

    texts = [r["text"] for r in corpus_frame.collect()]
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    def total(parts):
        out = {}
        for part in parts:
            for term, df in zip(*(c.to_pylist() for c in part.columns)):
                out[term] = out.get(term, 0) + df
        return out
    whole = total(imatch._count(iter([batch])))
    monkeypatch.setattr(imatch, "HELD_TERMS", 20)
    parts = list(imatch._count(iter([batch.slice(i, 5) for i in range(0, len(texts), 5)])))
    assert len(parts) > 2 and total(parts) == whole


def test_lexicon_counts_all_documents(spark, corpus, corpus_frame):
    counts = {}
    for _, text in corpus:
        for w in set(brute.lowered(text).split()):
            counts[w] = counts.get(w, 0) + 1
    n = len(corpus)
    want = sum(max(2, 0.02 * n) <= c <= 0.3 * n for c in counts.values())
    assert len(imatch.lexicon(corpus_frame, 0.02, 0.3)) == want


# ---- helpers -----------------------------------------------------------------------------------------------


def test_equal_spans_have_equal_hashes():
    block = blocks.block_of([b"abcabc", b"xabc", b""])
    spans = blocks.Spans(block.data)
    a, b, c, d = (spans.at(np.array([s]), np.array([s + 3]))[0] for s in (0, 3, 8, 1))
    assert a == b == c != d
    assert (spans.windows(3)[[0, 3, 8]] == a).all()
