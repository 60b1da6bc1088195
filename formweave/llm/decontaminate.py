"""Benchmark decontamination with suffix arrays over the training texts.

Each task cuts its documents into shards of half a MB and builds, per shard, the array of word suffixes in the order
of their first words, as many as a window is long. Every suffix of every benchmark item is then binary-searched: the
search narrows the range of suffixes that agree with it word by word. Places that agree for a whole window are
followed further, word by word, to the end of the longest verbatim match; a match that begins earlier is found from
there. Its words are hit.

Suffixes that start with a word no benchmark item has are left out of the array: no search can end at them. Words are
numbered by 64-bit hashes, and suffixes ordered by these numbers; the text of a word is not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import LOWERED, Block, Spans, block_of, blocks, ship, slices, words

WINDOW = 13
MAX_BROADCAST = 32 << 20
PORTION = 1 << 19  # suffixes searched, and places followed, at a time

# Words are runs of digits, letters a-z (after lower-casing A-Z) and everything outside ASCII.
BREAKS = np.zeros(256, bool)
BREAKS[:0x30] = BREAKS[0x3A:0x61] = BREAKS[0x7B:0x80] = True
BREAKS[0x41:0x5B] = False
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, owner = words(block, BREAKS)
    return Spans(LOWERED[block.data]).at(starts, ends), owner


class TestSuffixes:
    """The words of a set of items as numbers, each item between two -2; a suffix is its place in them. About 12 bytes
    a word at most."""

    def __init__(self, item_ids: list[int | None], hashes: np.ndarray, owner: np.ndarray, window: int = WINDOW):
        """Hashes of the words of all items in a row, and the item of each."""
        self.vocabulary = np.unique(hashes)
        self.item_ids, self.window = item_ids, window
        self.n_words = np.bincount(owner, minlength=len(item_ids)).astype(np.int32)
        self.before = (np.cumsum(self.n_words) - self.n_words + np.arange(len(item_ids)) + 1).astype(np.int32)
        self.words = np.full(len(hashes) + len(item_ids) + 2, -2, np.int32)
        self.words[np.arange(len(hashes)) + owner + 1] = np.searchsorted(self.vocabulary, hashes)

    def item_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.before, places, "right") - 1

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers in the vocabulary; -1 for a word that no item has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1).astype(np.int32)


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes that begin with a known word, sorted by their first ``depth`` tokens, and those
    tokens. ``tokens`` ends with ``depth`` times -1, and a -1 stands between texts."""
    at = np.flatnonzero(tokens >= 0)
    digits = tokens[at[:, None] + np.arange(depth)]
    order = np.lexsort(digits.T[::-1])
    return at[order], digits[order]


def search(digits: np.ndarray, items: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each test suffix, a place in ``items``: length of its longest match, up to the depth of the array, and the
    range of array rows that match so far."""
    n = len(suffixes)
    low, high = np.zeros(n, np.int32), np.full(n, len(digits), np.int32)
    length = np.zeros(n, np.int32)
    active = np.arange(n)
    for depth in range(digits.shape[1]):
        column, want = digits[:, depth], items[suffixes[active] + depth]
        ends = []
        for right in (False, True):
            a, b = low[active].copy(), high[active].copy()
            while (a < b).any():
                middle = (a + b) // 2
                value = column[np.minimum(middle, len(column) - 1)]
                go = (a < b) & ((value <= want) if right else (value < want))
                b = np.where((a < b) & ~go, middle, b)
                a = np.where(go, middle + 1, a)
            ends.append(a)
        found = (ends[0] < ends[1]) & (want >= 0)
        active, ends = active[found], (ends[0][found], ends[1][found])
        if not len(active):
            break
        low[active], high[active] = ends
        length[active] = depth + 1
    return length, low, high


def longest_matches(tokens: np.ndarray, tests: TestSuffixes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``tokens``, places in the items' words and lengths of all verbatim matches of a whole window, or of a
    whole shorter item, that are as long as they can be to either side. ``tokens`` begins with a -1, ends with as many
    as a window has, and a -1 stands between texts."""
    at, digits = suffix_array(tokens, tests.window)
    every = np.flatnonzero(tests.words >= 0)
    for first in range(0, len(every) if len(at) else 0, PORTION):
        suffixes = every[first: first + PORTION]
        length, low, high = search(digits, tests.words, suffixes)
        whole = np.flatnonzero(length >= np.minimum(tests.window, tests.n_words[tests.item_of(suffixes)]))
        turn = np.cumsum((high - low)[whole].astype(np.int64)) // PORTION
        for k in np.unique(turn):
            some = whole[turn == k]
            counts = (high - low)[some].astype(np.int64)
            item = np.repeat(suffixes[some], counts)
            place = at[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[some], counts)]
            size = np.repeat(length[some], counts)
            # What goes on to the left is part of the match that begins there.
            begins = tokens[place - 1] != tests.words[item - 1]
            item, place, size = item[begins], place[begins], size[begins]
            active = np.flatnonzero(size >= tests.window)
            while len(active):
                here = tokens[np.minimum(place[active] + size[active], len(tokens) - 1)]
                active = active[(here >= 0) & (here == tests.words[item[active] + size[active]])]
                size[active] += 1
            yield place, item, size


SPANS = pa.list_(pa.struct([("item_id", pa.int64()), ("item_word", pa.int32()), ("word", pa.int32()),
                            ("length", pa.int32())]))


def in_text(span: tuple) -> tuple:
    item_id, item_word, word, length = span
    return word, item_word, length, item_id is not None, item_id or 0


def _scan(batches: Iterator[pa.RecordBatch], tests: TestSuffixes, with_spans: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for rows, block in blocks(batch, "_text"):
            hashes, owner = word_hashes(block)
            known = tests.numbers(hashes)
            # A -1 before each text: shift its words by one more than its index.
            tokens = np.full(len(known) + len(block.texts) + tests.window + 1, -1, np.int32)
            place = np.arange(len(known)) + owner + 1
            tokens[place] = known
            text_of = np.full(len(tokens), -1, np.int64)
            text_of[place] = owner
            n = len(block.texts)
            first = np.searchsorted(owner, np.arange(n)) + np.arange(n) + 1
            hits = np.zeros(len(tokens) + 1, np.int32)
            pairs = np.zeros((0, 2), np.int64)
            spans: list[list[tuple]] = [[] for _ in range(n)]
            for at, item_at, size in longest_matches(tokens, tests):
                np.add.at(hits, at, 1)
                np.add.at(hits, at + size, -1)
                item = tests.item_of(item_at)
                pairs = np.unique(np.concatenate([pairs, np.stack([text_of[at], item], 1)]), axis=0)
                if with_spans:
                    for text, *span in zip(text_of[at].tolist(), [tests.item_ids[i] for i in item.tolist()],
                                           (item_at - tests.before[item]).tolist(), (at - first[text_of[at]]).tolist(),
                                           size.tolist()):
                        spans[text].append(tuple(span))
            hit = np.flatnonzero(np.cumsum(hits)[:-1] > 0)
            n_words = np.bincount(owner, minlength=n)
            ends = np.searchsorted(text_of[hit], np.arange(n + 1))
            places = [(hit[a:b] - f).tolist() for a, b, f in zip(ends, ends[1:], first)]
            items: list[list[int]] = [[] for _ in range(n)]
            for text, item in pairs.tolist():
                items[text].append(tests.item_ids[item])
            more = {"spans": pa.array([sorted(s, key=in_text) for s in spans], SPANS)} if with_spans else {}
            source = batch.slice(rows.start, rows.stop - rows.start)
            yield pa.record_batch([*source.columns[1:], pa.array(n_words, pa.int64()),
                                   pa.array(places, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64())),
                                   *more.values()],
                                  names=[*source.schema.names[1:], "n_words", "hit_words", "item_ids", *more])


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_broadcast: int = MAX_BROADCAST,
            carry: tuple[str, ...] = ("doc_id",), with_spans: bool = False) -> DataFrame:
    """The ``carry`` columns, n_words, hit_words (places of the hit words) and item_ids of each row of ``docs``;
    ``with_spans`` also the longest verbatim matches, as an array of (item_id, item_word, word, length): the match
    begins at that word of the item and of the document. Matches of fewer words than the window, or than all words of
    a shorter item, are not given.

    The items go to every task, in blocks of at most ``max_broadcast`` bytes of text; with more than one block the
    documents are searched once per block and the hits of a row are united. Null and wordless texts have no words,
    null and wordless items no window. Of repeated items each id counts once; two items of one id and different texts
    both give their matches. A very long text is searched as a whole, in a shard of its own.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // max_broadcast))

    spans = ", spans array<struct<item_id: bigint, item_word: int, word: int, length: int>>" if with_spans else ""
    found = ["hit_words", "item_ids", *(["spans"] if with_spans else [])]

    def found_in(block: int, rows: DataFrame) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == block).distinct().collect()
        hashes, owner = word_hashes(block_of([r["text"].encode() for r in part]))
        tests = spark.sparkContext.broadcast(TestSuffixes([r["item_id"] for r in part], hashes, owner, window))
        kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[1:])
        return rows.mapInArrow(lambda batches: _scan(batches, tests.value, with_spans),
                               f"{kinds}, n_words bigint, hit_words array<int>, item_ids array<bigint>{spans}")

    rows = docs.select(F.col("text").alias("_text"), *carry)
    if n_blocks == 1:
        return found_in(0, rows)
    # The hits of a row meet by all its columns and its text; how often it is repeated is counted.
    keyed = rows.select("_text", F.struct(*carry, F.sha2("_text", 256).alias("_digest")).alias("_row"))
    every = found_in(0, keyed)
    for block in range(1, n_blocks):
        every = every.unionByName(found_in(block, keyed))
    united = every.groupBy("_row").agg(
        F.first("n_words").alias("n_words"), (F.count("*") / n_blocks).cast("int").alias("_copies"),
        *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in found))
    return united.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(
        *(F.col("_row")[c].alias(c) for c in carry), "n_words", *found)


def is_contaminated() -> Column:
    """At least one word in twenty is hit."""
    n_hit = F.size("hit_words")
    return (n_hit > 0) & (20 * n_hit >= F.col("n_words"))


def verdicts(found: DataFrame) -> DataFrame:
    """doc_id, counts, a digest of the item ids and the verdict, from matches."""
    ids = F.array_sort(F.transform(F.array_distinct("item_ids"), lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))
