"""Similarity join of shingle sets by prefixes of token combinations.

Two sets of n and m shingles (tokens) with a similarity of p percent share at least p percent of the tokens of either,
so at most ``slack = n - ceil(p * n / 100)`` tokens of a set lie outside the other. Tokens have one global order, the
rarest first. Of each set only a prefix in this order is indexed: every token of a rare class on its own, and tokens of
frequent classes in combinations of two or three. A set with c tokens of a class in its prefix that shares no
combination of k of them has at least c - k + 1 of them outside the other set; the prefix is extended until these
numbers add up to more than the slack. Two similar sets then share a combination: of the two prefixes take the one that
ends first; what it shares with the other set lies in the other's prefix, too.

Combinations are made within groups of a class, dealt by the token's hash, so that their number stays in proportion to
the prefix. The number of groups depends on the band of the set's size (powers of two); a set near the upper end of its
band is indexed in the next one as well, so that any two similar sets meet in one band.

Tokens that only one set has need no index: they use up slack. A set with more of them than its slack has no partner,
which is how most documents leave at once.

Documents with equal text are one set. Sets that share a combination are verified on their full tokens, first each with
one hub per combination, which connects large groups of near copies by one comparison per member; then, where members
of a combination are still in different components, all of those with each other, in blocks dealt over the tasks;
combinations with sets in common are compared as one group where that sends less. Links join to components, whatever
their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import U64, blocks, few, materialise, mix, ship, shuffle_partitions, slices, small_side
from formweave.llm.hyperminhash import components, shingle_sets, similar

# Tokens in up to RARE sets are indexed alone, in up to COMMON sets in pairs, others in threes.
RARE, COMMON = 16, 256
# Sets of fewer than 2 ** SINGLES tokens are indexed by single tokens only.
SINGLES = 4
TOKENS_PER_BUCKET = 3_000_000
SEND = 1_000_000
BLOCK = 1024
KEY_BYTES = 16
POSTING = np.dtype([("token", "<u4"), ("df", "<u4")])


# ---- tokens to buckets -------------------------------------------------------------------------------------


def _packed(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that are the items of an array between bounds."""
    data = np.ascontiguousarray(data)
    offsets = (bounds * data.dtype.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data.view(np.uint8))])


def _tokens(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of sets, dealt over 2 ** bits buckets by their first bits; the next 32 bits are the token. Each
    row has sets of one bucket: keys, the number of tokens in this bucket, and those. A row with bucket -1 gives keys
    with their sizes and numbers of distinct tokens."""
    shift = U64(32 - bits)
    held: list[tuple] = []
    size = 0

    def send():
        keys = np.concatenate([h[0] for h in held])
        sizes, distinct = (np.concatenate([h[k] for h in held]).astype("<u4") for k in (1, 2))
        first = np.concatenate([[0], np.cumsum([len(h[0]) for h in held])])
        tokens = np.concatenate([h[3] for h in held])
        owner = np.concatenate([(h[4] + first[i]).astype(np.int32) for i, h in enumerate(held)])
        bucket = (tokens >> U64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        tokens, owner, bucket = tokens[order].astype("<u4"), owner[order], bucket[order]
        # Runs of one set in one bucket.
        runs = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        counts = np.diff(np.append(runs, len(bucket))).astype("<u4")
        of, where = owner[runs], bucket[runs]
        cuts = np.append(np.flatnonzero(np.diff(where, prepend=-1)), len(runs))
        names = ["bucket", "keys", "counts", "tokens"]
        if len(runs):
            yield pa.record_batch([
                pa.array(where[cuts[:-1]].astype(np.int32)), _packed(keys[of], cuts), _packed(counts, cuts),
                _packed(tokens, np.append(runs, len(tokens))[cuts])], names=names)
        whole = np.array([0, len(keys)])
        yield pa.record_batch([pa.array([-1], pa.int32()), _packed(keys, whole), _packed(sizes, whole),
                               _packed(distinct, whole)], names=names)

    for batch in slices(batches):
        for rows, block in blocks(batch, "text"):
            n = len(block.texts)
            values, texts, sizes = shingle_sets(block, width)
            tokens = values >> shift
            fresh = np.ones(len(tokens), bool)
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (texts[1:] != texts[:-1])
            tokens, texts = tokens[fresh], texts[fresh]
            keys = np.frombuffer(b"".join(batch.column(0).slice(rows.start, n).to_pylist()), f"V{KEY_BYTES}")
            held.append((keys, sizes, np.bincount(texts, minlength=n), tokens, texts))
            size += len(tokens)
            if size >= SEND:
                yield from send()
                held, size = [], 0
    if held:
        yield from send()


class Bucket:
    """The sets and tokens of one bucket. Tokens of more than COMMON sets are given out as soon as they are known to
    be, so that what is held is bounded by the number of other tokens."""

    def __init__(self, number: int):
        self.number = number
        self.parts: list[tuple] = []
        self.size = 0
        self.common = np.zeros(0, "<u4")

    def add(self, row: dict) -> None:
        counts = np.frombuffer(row["counts"], "<u4")
        keys = np.frombuffer(row["keys"], f"V{KEY_BYTES}")
        self.parts.append((keys, np.frombuffer(row["tokens"], "<u4"), np.repeat(np.arange(len(keys), dtype=np.int32), counts)))
        self.size += len(self.parts[-1][1])

    def settle(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Give out the common tokens, and at last those of more than one set."""
        first = np.concatenate([[0], np.cumsum([len(p[0]) for p in self.parts])]).astype(np.int32)
        keys, tokens = (np.concatenate([p[k] for p in self.parts]) for k in range(2))
        owner = np.concatenate([p[2] + first[i] for i, p in enumerate(self.parts)])
        self.parts = []
        order = np.argsort(tokens, kind="stable").astype(np.int32)
        tokens, owner = tokens[order], owner[order]
        del order
        starts = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] + np.uint32(1)) != 0)
        counts = np.diff(np.append(starts, len(tokens))).astype(np.int32)
        known = np.isin(tokens[starts], self.common)
        df = np.where(known | (counts > COMMON), COMMON + 1, counts).astype(np.int32)
        self.common = np.union1d(self.common, tokens[starts][df > COMMON])
        df = np.repeat(df, counts)
        out = df > 1 if last else df > COMMON
        yield self._rows(keys, tokens[out], df[out], owner[out])
        if not last:
            used, renumbered = np.unique(owner[~out], return_inverse=True)
            self.parts = [(keys[used], tokens[~out], renumbered.astype(np.int32))]
        self.size = 0

    def _rows(self, keys: np.ndarray, tokens: np.ndarray, df: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(owner, kind="stable")
        postings = np.empty(len(tokens), POSTING)
        postings["token"], postings["df"] = tokens[order], df[order]
        owner = owner[order]
        runs = np.flatnonzero(np.diff(owner, prepend=-1))
        return _set_rows(keys[owner[runs]], np.full(len(runs), self.number), None,
                         _packed(postings, np.append(runs, len(owner))))


def _set_rows(keys: np.ndarray, bucket: np.ndarray, sizes: tuple | None, postings: pa.Array | None) -> pa.RecordBatch:
    n, distinct = (pa.array(x.astype(np.int64)) for x in sizes) if sizes else (pa.nulls(len(keys), pa.int64()),) * 2
    return pa.record_batch([
        _packed(keys, np.arange(len(keys) + 1)), pa.array(bucket.astype(np.int32)), n, distinct,
        pa.nulls(len(keys), pa.binary()) if postings is None else postings],
        names=["key", "bucket", "n", "distinct", "postings"])


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per set and bucket the tokens that other sets have too, with the number of those sets. Rows come sorted by
    bucket; keys and sizes sent alone pass through, without tokens."""
    bucket = None
    for batch in slices(batches, 64):
        for row in batch.to_pylist():
            if row["bucket"] < 0:
                keys = np.frombuffer(row["keys"], f"V{KEY_BYTES}")
                sizes = tuple(np.frombuffer(row[c], "<u4") for c in ("counts", "tokens"))
                yield _set_rows(keys, np.full(len(keys), -1), sizes, None)
                continue
            if bucket is None or bucket.number != row["bucket"]:
                if bucket is not None:
                    yield from bucket.settle(last=True)
                bucket = Bucket(row["bucket"])
            bucket.add(row)
            if bucket.size > TOKENS_PER_BUCKET:
                yield from bucket.settle(last=False)
    if bucket is not None:
        yield from bucket.settle(last=True)


# ---- prefixes and combinations -----------------------------------------------------------------------------


def bands(n: int, percent: int) -> list[int]:
    """The size bands in which a set of n tokens is indexed."""
    band = n.bit_length() - 1
    return [band, band + 1] if 100 * n >= percent << (band + 1) else [band]


@lru_cache(maxsize=256)
def _choices(n: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def signatures(tokens: np.ndarray, df: np.ndarray, n: int, distinct: int, percent: int) -> np.ndarray:
    """Hashes of the combinations that a set is indexed by. ``tokens`` are those that other sets have too, with the
    number of sets; the set has n tokens, ``distinct`` of them different in the bits that tokens keep."""
    slack = n - -(-percent * n // 100)
    need = slack + 1 - (distinct - len(tokens))
    if need <= 0 or not len(tokens):
        return np.zeros(0, U64)
    order = np.lexsort((tokens, df))
    tokens, df = tokens[order], df[order]
    mixed = mix(tokens)
    found = []
    for band in bands(n, percent):
        if band < SINGLES:
            k, group = np.ones(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        else:
            k = 1 + (df > RARE).astype(np.int64) + (df > COMMON)
            group = k * (1 << band) + (mixed % U64(1 << (band - 3))).astype(np.int64)
        # The place of each token among those of its group so far: it counts from the k-th on.
        by_group = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
        place = np.empty(len(tokens), np.int64)
        place[by_group] = np.arange(len(tokens)) - np.repeat(starts, np.diff(np.append(starts, len(tokens))))
        counted = np.cumsum((k == 1) | (place >= k - 1))
        end = min(int(np.searchsorted(counted, need)) + 1, len(tokens))
        salt = U64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        single = np.flatnonzero(k[:end] == 1)
        found.append(mix(mixed[single] ^ salt))
        for g in np.unique(group[:end][k[:end] > 1]).tolist():
            members = np.flatnonzero(group[:end] == g)
            size = int(k[members[0]])
            if len(members) < size:
                continue
            values = np.sort(mixed[members])[_choices(len(members), size)]
            total = np.full(len(values), salt, U64)
            for j in range(size):
                total = mix(total * U64(0xD1342543DE82EF95) + values[:, j])
            found.append(total)
    return np.unique(np.concatenate(found))


def _signatures(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by set, the one with its sizes first."""
    out: list[tuple] = []
    made, key, held, sizes = 0, None, [], (0, 0)

    def index():
        packed = np.concatenate([np.frombuffer(p, POSTING) for _, p in held])
        where = np.repeat(np.array([b for b, _ in held], U64), [len(p) // POSTING.itemsize for _, p in held])
        tokens = (where << U64(32)) | packed["token"].astype(U64)
        return signatures(tokens, packed["df"].astype(np.int64), *sizes, percent), len(tokens)

    def close():
        # Most sets have more tokens of their own than their slack; they need not be unpacked.
        n, distinct = sizes
        if n and distinct - sum(len(p) for _, p in held) // POSTING.itemsize <= n - -(-percent * n // 100):
            found, shared = index()
            if len(found):
                out.append((key, n, 1000 * (distinct - shared) // distinct, found))
                return len(found)
        return 0

    def flush():
        counts = np.array([len(f) for *_, f in out])
        of = np.repeat(np.arange(len(out)), counts)
        keys = np.frombuffer(b"".join(o[0] for o in out), f"V{KEY_BYTES}")[of]
        n, own = (np.array([o[i] for o in out], np.int64)[of] for i in (1, 2))
        return pa.record_batch([pa.array(np.concatenate([o[3] for o in out]).view(np.int64)),
                                _packed(keys, np.arange(len(keys) + 1)), pa.array(n), pa.array(own)],
                               names=["sig", "key", "n", "own"])

    for batch in slices(batches, 4096):
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for k, bucket, n, distinct, postings in zip(*columns):
            if bucket >= 0:
                held.append((bucket, postings))
                continue
            made += close()
            key, held, sizes = k, [], (n, distinct)
            if made > 200_000:
                yield flush()
                out, made = [], 0
    close()
    if out:
        yield flush()


# ---- verifying ---------------------------------------------------------------------------------------------


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for rows, block in blocks(batch, "text"):
            values, _, sizes = shingle_sets(block, width)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.record_batch([batch.column(0).slice(rows.start, len(sizes)), _packed(values.astype("<u8"), bounds)],
                                  names=["key", "tokens"])


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs that are similar; the last two columns are the tokens of both."""
    for part in slices(batches, 256):
        a, b = (column.to_pylist() for column in part.columns[-2:])
        keep = pa.array([i for i in range(len(a)) if similar(np.frombuffer(a[i], "<u8"), np.frombuffer(b[i], "<u8"), percent)],
                        pa.int64())
        yield pa.record_batch([column.take(keep) for column in part.columns[:-2]], names=part.schema.names[:-2])


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within a block or between two; rows come sorted by combination and pair of blocks.
    One set's common tokens with all others are counted at once, by lists of the sets that have a token."""
    def compare(rows: list[dict]) -> pa.RecordBatch | None:
        _, label = np.unique([r["label"] for r in rows], return_inverse=True)
        if label.max() == 0:
            return None
        block = np.array([r["block"] for r in rows])
        crossing = rows[0]["low"] != rows[0]["high"]
        sets = [np.frombuffer(r["tokens"], "<u4") for r in rows]
        # Tokens that became equal when shortened may be common.
        full = np.array([r["n"] for r in rows])
        lost = full - np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        _, column = np.unique(every, return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        holders = np.repeat(np.arange(len(sets)), np.diff(bounds))[np.argsort(column, kind="stable")]
        lists = np.concatenate([[0], np.cumsum(np.bincount(column))])
        found = []
        for i in range(len(rows) - 1):
            mine = column[bounds[i]: bounds[i + 1]]
            counts = lists[mine + 1] - lists[mine]
            at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lists[mine], counts)
            common = np.bincount(holders[at], minlength=len(rows)) + lost + lost[i]
            close = (100 + percent) * common >= percent * (full + full[i])
            close &= (label != label[i]) & (np.arange(len(rows)) > i)
            if crossing:
                close &= block != block[i]
            found += [(i, int(j)) for j in np.flatnonzero(close)]
        if not found:
            return None
        return pa.record_batch([pa.array([rows[p[side]][x] for p in found], pa.binary())
                                for x in ("key", "label") for side in (0, 1)], names=["a", "b", "label_a", "label_b"])

    held: list[dict] = []
    names = ("sig", "low", "high")
    for batch in slices(batches):
        for row in batch.to_pylist():
            if held and any(held[0][x] != row[x] for x in names):
                out = compare(held)
                if out is not None:
                    yield out
                held = []
            held.append(row)
    if held:
        out = compare(held)
        if out is not None:
            yield out


def _short_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        full = [np.frombuffer(x, "<u8") for x in batch.column(1).to_pylist()]
        yield pa.record_batch([
            batch.column(0), pa.array([len(x) for x in full], pa.int64()),
            pa.array([np.unique(x >> U64(32)).astype("<u4").tobytes() for x in full], pa.binary())], names=["of", "n", "tokens"])


# ---- the operator ------------------------------------------------------------------------------------------


def text_key() -> Column:
    """Names a text; NULL for none."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """key, text: every different text once. Texts that stand alone are not shuffled."""
    rows = docs.select(text_key().alias("key"), "text").where("text IS NOT NULL")
    again = materialise(few(rows.groupBy("key").count().where("count > 1").select("key")), "repeated")
    firsts = rows.join(small_side(again, 32), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    alone = rows.join(small_side(again, 32), "key", "left_anti")
    return alone.unionByName(materialise(few(firsts), "copied"))


def shared_tokens(texts: DataFrame, width: int = 5) -> DataFrame:
    """key, bucket, n, distinct, postings of every text: per bucket the tokens that other texts have too, and once per
    text, with bucket -1, its sizes."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(1, (size // (6 * TOKENS_PER_BUCKET)).bit_length())
    dealt = texts.mapInArrow(partial(_tokens, width=width, bits=bits),
                             "bucket int, keys binary, counts binary, tokens binary")
    # Rows without tokens go anywhere.
    place = F.when(F.col("bucket") < 0, F.xxhash64("keys")).otherwise(F.col("bucket").cast("bigint"))
    parts = max(1 << bits, shuffle_partitions(texts.sparkSession))
    return dealt.withColumn("place", place).repartition(parts, "place").sortWithinPartitions("bucket").drop(
        "place").mapInArrow(_shared_tokens, "key binary, bucket int, n bigint, distinct bigint, postings binary")


def connected(texts: DataFrame, shared: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """key, label: the least text key that verified links reach. Texts without a link have no row."""
    sigs = materialise(shared.repartition("key").sortWithinPartitions("key", "bucket").mapInArrow(
        partial(_signatures, percent=percent), "sig bigint, key binary, n bigint, own bigint"), "signatures")
    # The hub is the set with the smallest share of tokens of its own: of a text and its edited copies, the text.
    # Of combinations with the same sets, by 128 bits of their keys' hashes, one is enough.
    crowded = sigs.groupBy("sig").agg(
        F.count("*").alias("size"), F.min(F.struct("own", "key", "n")).alias("hub"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y")).where("size > 1").groupBy("size", "x", "y").agg(
        F.min(F.struct("sig", "hub")).alias("one")).select("size", "one.sig", "one.hub")
    members = materialise(few(sigs.join(crowded, "sig").select(
        "sig", "size", "key", "n", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n"))), "members")

    wanted = materialise(few(members.select("key").distinct()), "wanted")
    sets = materialise(texts.join(small_side(wanted, 32), "key", "left_semi").select("key", "text").mapInArrow(
        partial(_full_sets, width=width), "key binary, tokens binary"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        def side(x: str) -> DataFrame:
            return sets.select(F.col("key").alias(x), F.col("tokens").alias(f"tokens_{x}"))

        both = pairs.join(side("b"), "b").join(side("a"), "a").select(*pairs.columns, "tokens_a", "tokens_b")
        schema = ", ".join(f"{x} binary" for x in pairs.columns)
        return materialise(few(both).mapInArrow(partial(_verify, percent=percent), schema), "verified")

    possible = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    near_hub = verified(members.where((F.col("key") != F.col("hub")) & possible).select(
        F.col("hub").alias("a"), F.col("key").alias("b")).distinct())

    labels = components(near_hub).withColumnRenamed("node", "key")
    now = members.where("size > 2").select("sig", "size", "key").join(labels, "key", "left").select(
        "sig", "size", "key", F.coalesce("label", "key").alias("label"))
    open_ = now.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("sig")
    groups = _groups(materialise(few(now.join(open_, "sig", "left_semi")), "open"))
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    now = groups.withColumn("n_blocks", n_blocks).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int"))
    short = sets.mapInArrow(_short_sets, "of binary, n bigint, tokens binary")
    dealt = now.join(short, F.col("key") == F.col("of")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "sig", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "label",
        "n", "tokens")
    order = ["sig", "low", "high"]
    pairs = dealt.repartition(shuffle_partitions(texts.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(
        partial(_block_pairs, percent=percent), "a binary, b binary, label_a binary, label_b binary")
    # What the hubs have connected counts as one node, so that only the new links are to be followed.
    joined = components(verified(pairs.distinct()).select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    joined = joined.withColumnRenamed("label", "least")
    return labels.join(joined, F.col("label") == F.col("node"), "left").select(
        "key", F.coalesce("least", "label").alias("label")).unionByName(
        joined.join(labels, F.col("node") == F.col("key"), "left_anti").select(
            F.col("node").alias("key"), F.col("least").alias("label")))


def _groups(rows: DataFrame) -> DataFrame:
    """sig, size, key, label: the sets to compare with each other. Combinations that have sets in common are one group,
    so that a set is sent once and not with each of its combinations; but where such a group is so large that it would
    send more, its combinations stay apart. Either way covers all pairs that share a combination."""
    def sent(size: Column) -> Column:
        return size * F.ceil(size / BLOCK)

    first = rows.groupBy("sig").agg(F.min("key").alias("a"))
    joined = components(rows.join(first, "sig").select("a", F.col("key").alias("b"))).select(
        F.col("node").alias("key"), F.col("label").alias("family"))
    placed = materialise(few(rows.join(joined, "key")), "families")
    whole = placed.select("family", "key", "label").distinct()
    sizes = whole.groupBy("family").agg(F.count("*").alias("members"))
    # Each row of a combination is one of `size` rows.
    apart = placed.groupBy("family").agg(F.sum(F.ceil(F.col("size") / BLOCK)).alias("apart"))
    better = materialise(few(sizes.join(apart, "family").select(
        "family", "members", (sent(F.col("members")) <= F.col("apart")).alias("one"))), "ways")
    better = small_side(better, 64)
    return whole.join(better.where("one"), "family").select(
        F.xxhash64("family").alias("sig"), F.col("members").alias("size"), "key", "label").unionByName(
        placed.join(better.where("NOT one"), "family", "left_semi").select("sig", "size", "key", "label"))


def similarity_join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs``.

    Words are what white space leaves, A-Z lower-cased; a text with fewer than ``width`` words is one shingle. Two rows
    are linked if 100 * common shingles >= ``percent`` * all shingles; the component is the least id that links reach.
    Null, empty and wordless texts have no shingles and are linked with nothing; their component is their own id. A
    null id counts as no id: rows that reach no other have a null component. Repeated rows are alike. Texts are used
    whole; a task holds one text's tokens, and about TOKENS_PER_BUCKET tokens of a bucket.
    """
    ship(docs.sparkSession)
    texts = distinct_texts(docs)
    shared = materialise(shared_tokens(texts, width), "shared")
    sizes = shared.where("bucket < 0").select("key", "n")
    labels = connected(texts, shared, width, percent)
    rows = docs.select("doc_id", text_key().alias("key"))
    named = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"))
    classes = sizes.join(named, "key").join(labels, "key", "left").select(
        "key", "n", "rep", F.coalesce("label", "key").alias("label"))
    linked = classes.groupBy("label").agg(F.min("rep").alias("least"))
    told = classes.join(linked, "label").select(
        F.col("key").alias("of"), F.col("n"), "least")
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return rows.join(told, F.col("key") == F.col("of"), "left").select(
        "doc_id", n.alias("n_shingles"), F.when(n == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
