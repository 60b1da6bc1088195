"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct word shingles. Documents with the same set form one class, and all further
work is on classes, so copies cost nothing. A class is sketched into 128 registers: shingle hashes fall into
buckets, and a bucket keeps the leading zeros and the next mantissa bits of its least hash. Empty buckets borrow a
register from another one by a fixed probe order, so that small sets fill all registers and two sets agree in each
with the probability of their similarity.

Registers are banded, four to a band. At a similarity of 0.8 two sets share none of the 32 bands with a
probability of 5e-8. Sets that share a band are compared in two steps:

1. Each member of a band's bucket with the bucket's least member. The confirmed links are closed to components,
   which turns groups of thousands of near copies into one label each, with one comparison per member and bucket.
2. In buckets that still hold several labels, all members with different labels. Such buckets are cut into blocks
   of at most about 1,024 members, pairs of blocks are dealt over the cluster, and a task reports only the pairs
   that pass its filters: sizes that allow the threshold, a similarity estimated from the registers, with the
   agreements that chance explains taken out, no more than 6 standard deviations below it, and then the sets
   themselves in 32-bit hashes. Neither the pairs of a bucket nor whole buckets are ever rows or groups.

So each pair that shares a band is either compared or already connected. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import (LOWERED, SPACES, U64, Block, Spans, blocks, few, materialise, mix, shuffle_partitions, ship,
                                  slices, small_side, sort_within, sums_by, words)

REGISTERS, BAND = 128, 4
MANTISSA = 10
BLOCK = 1024


# ---- sets and sketches -------------------------------------------------------------------------------------


def shingle_sets(block: Block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block, ordered by text and value: hashes, their texts, set size per text."""
    n = len(block.texts)
    starts, ends, owner = words(block, SPACES)
    hashes = Spans(LOWERED[block.data]).at(starts, ends)
    count = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    sizes = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    texts = np.repeat(np.arange(n), sizes)
    at = np.arange(bounds[-1]) - bounds[texts] + first[texts]
    last = np.minimum(at + width, first[texts + 1]) - at
    values = np.zeros(len(at), U64)
    for step in range(width):
        inside = step < last
        part = np.where(inside, hashes[np.minimum(at + step, max(len(hashes) - 1, 0))], U64(0)) if len(at) else values
        values = mix(values * U64(0xD1342543DE82EF95) + part + inside.astype(U64))
    sort_within(values, bounds)
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    texts = texts[fresh]
    return values[fresh], texts, np.bincount(texts, minlength=n)


def _probe_order() -> np.ndarray:
    """For each register the others in the order in which it borrows from them."""
    keys = mix(np.arange(1, REGISTERS * REGISTERS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return np.argsort(keys.reshape(REGISTERS, REGISTERS), axis=1)


PROBES = _probe_order()


def registers(values: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """uint16 registers, 0 where a bucket is empty: leading zeros (6 bits) and mantissa (10 bits) of its least hash."""
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, U64)
    np.minimum.at(least, texts * REGISTERS + (values >> U64(57)).astype(np.int64), values << U64(7))
    filled = least != np.iinfo(np.uint64).max
    high = np.floor(np.log2(np.maximum(least, U64(1 << 11)).astype(np.float64))).astype(np.int64)
    high = np.where(least >> np.minimum(high, 63).astype(U64) == 0, high - 1, high)  # rounding up to the next power
    zeros = 63 - high
    mantissa = (least >> np.maximum(high - MANTISSA, 0).astype(U64)) & U64((1 << MANTISSA) - 1)
    out = np.where(filled, ((zeros + 1).astype(np.uint64) << U64(MANTISSA)) | mantissa, 0).astype(np.uint16)
    return out.reshape(n, REGISTERS)


def densified(rows: np.ndarray) -> np.ndarray:
    """Registers with the empty ones borrowed; sets without shingles stay empty."""
    out, need = rows.copy(), (rows == 0) & rows.any(1)[:, None]
    for step in range(REGISTERS):
        at = np.flatnonzero(need.any(1))
        if not len(at):
            break
        lent = rows[at][:, PROBES[:, step]]
        take = need[at] & (lent != 0)
        out[at] = np.where(take, lent, out[at])
        need[at] &= ~take
    return out


def chance_of_agreement(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets agree, from the distribution of a register by set size."""
    zeros = np.arange(1, 55)
    steps = 1 << MANTISSA
    total = np.zeros(len(sizes_a))
    for zero in zeros:
        # The mantissa of a register is nearly uniform within one count of zeros.
        top, low = 2.0 ** -(zero - 1), 2.0 ** -zero
        p_a = np.exp(-sizes_a / REGISTERS * low) - np.exp(-sizes_a / REGISTERS * top)
        p_b = np.exp(-sizes_b / REGISTERS * low) - np.exp(-sizes_b / REGISTERS * top)
        total += p_a * p_b / steps
    return np.minimum(total, 0.5)


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of pairs, corrected for collisions, and the registers it rests on."""
    used = ((a != 0) | (b != 0)).sum(1)
    agree = ((a == b) & (a != 0)).sum(1)
    chance = chance_of_agreement(a, b, sizes_a.astype(float), sizes_b.astype(float))
    share = agree / np.maximum(used, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1), used


def set_ids(values: np.ndarray, texts: np.ndarray, n: int) -> list[bytes]:
    """16 bytes that tell a set, whatever the order of its members."""
    sums = (sums_by(values, texts, n), sums_by(mix(values ^ U64(0xA5A5A5A5A5A5A5A5)), texts, n))
    data = np.stack(sums, 1).astype(">u8").tobytes()
    return [data[16 * i: 16 * i + 16] for i in range(n)]


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for rows, block in blocks(batch, "text"):
            n = len(block.texts)
            values, texts, sizes = shingle_sets(block, width)
            ids = set_ids(values, texts, n)
            regs = registers(values, texts, n).astype("<u2")
            yield pa.record_batch([
                batch.column(0).slice(rows.start, n), batch.column(1).slice(rows.start, n), pa.array(sizes, pa.int64()),
                pa.array([ids[i] if sizes[i] else None for i in range(n)], pa.binary()),
                pa.array([r.tobytes() for r in regs], pa.binary())], names=["doc_id", "hash", "n_shingles", "set_id", "regs"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(n, REGISTERS)
        keys = np.ascontiguousarray(densified(rows)).view("<i8")
        for band in range(keys.shape[1]):
            yield pa.record_batch([pa.array(np.full(n, band, np.int16)), pa.array(keys[:, band]), batch.column(0)],
                                  names=["band", "key", "set_id"])


# ---- comparing ---------------------------------------------------------------------------------------------


def may_link(size_a: np.ndarray, size_b: np.ndarray, regs_a: np.ndarray, regs_b: np.ndarray,
             percent: int) -> np.ndarray:
    """Pairs that sizes and registers do not rule out."""
    threshold = percent / 100
    possible = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    at = np.flatnonzero(possible)
    guess, used = estimate(regs_a[at], regs_b[at], size_a[at], size_b[at])
    possible[at] = guess >= threshold - 6 * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    return possible


def similar(a: np.ndarray, b: np.ndarray, percent: int, lost: int = 0) -> bool:
    """Whether two sorted sets reach the threshold; ``lost`` members, equal to others in short hashes, may be common."""
    common = len(a) + len(b) - len(np.union1d(a, b)) + lost
    return 100 * common >= percent * (len(a) + len(b) + lost - common)


def _regs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), REGISTERS)


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 256):
        col = {name: part.column(i) for i, name in enumerate(part.schema.names)}
        sizes = [col[x].to_numpy(zero_copy_only=False) for x in ("n_a", "n_b")]
        close = may_link(*sizes, _regs(col["regs_a"]), _regs(col["regs_b"]), percent)
        sets = [col[x].to_pylist() for x in ("set_a", "set_b")]
        keep = pa.array([int(i) for i in np.flatnonzero(close) if similar(
            np.frombuffer(sets[0][i], "<u8"), np.frombuffer(sets[1][i], "<u8"), percent)], pa.int64())
        yield pa.record_batch([col["a"].take(keep), col["b"].take(keep)], names=["a", "b"])


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with different labels within one block or between two; rows come sorted by bucket and pair of blocks.
    A pair is reported in the first band it shares only."""
    held: list[dict] = []
    names = ("band", "key", "low", "high")

    def compare(rows: list[dict]) -> pa.RecordBatch | None:
        band, low, high = rows[0]["band"], rows[0]["low"], rows[0]["high"]
        regs = np.frombuffer(b"".join(r["regs"] for r in rows), "<u2").reshape(len(rows), REGISTERS)
        bands = np.ascontiguousarray(densified(regs)).view("<u8")
        sizes = np.array([r["n"] for r in rows])
        block = np.array([r["block"] for r in rows])
        _, label = np.unique([r["label"] for r in rows], return_inverse=True)
        sets = [np.frombuffer(r["set"], "<u4") for r in rows]
        lost = sizes - np.array([len(x) for x in sets])
        found = []
        for i in range(len(rows) - 1):
            other = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
            if low != high:
                other = other[block[other] != block[i]]
            if band:
                other = other[~(bands[other, :band] == bands[i, :band]).any(1)]
            if not len(other):
                continue
            n = len(other)
            close = may_link(np.full(n, sizes[i]), sizes[other], np.broadcast_to(regs[i], (n, REGISTERS)), regs[other],
                             percent)
            found += [(i, int(j)) for j in other[close] if similar(sets[i], sets[j], percent, int(lost[i] + lost[j]))]
        if not found:
            return None
        return pa.record_batch([pa.array([rows[i]["set_id"] for i, _ in found], pa.binary()),
                                pa.array([rows[j]["set_id"] for _, j in found], pa.binary())], names=["a", "b"])

    for batch in slices(batches):
        for item in batch.to_pylist():
            if held and any(held[0][x] != item[x] for x in names):
                out = compare(held)
                if out is not None:
                    yield out
                held = []
            held.append(item)
    if held:
        out = compare(held)
        if out is not None:
            yield out


# ---- components --------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component of the edges (a, b), by alternating large and
    small stars. Nodes without an edge have no row."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.selectExpr("inline(array(struct(a, b), struct(b AS a, a AS b)))")
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(low, "a")
        far = moved.where("b > a") if large else moved.where("b <> m")
        ends = far.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            ends = ends.unionByName(low.select("a", F.col("m").alias("b")))
        return ends.where("a <> b").distinct()

    def settled(e: DataFrame) -> bool:
        """Whether each node has one edge to a lesser node, or only edges to greater ones: stars around least nodes."""
        ends = e.selectExpr("inline(array(struct(a AS node, 1 AS up, 0 AS down), struct(b AS node, 0 AS up, 1 AS down)))")
        places = ends.groupBy("node").agg((F.sum("up") + F.max("down")).alias("places"))
        return (places.agg(F.max("places")).first()[0] or 0) <= 1

    edges = materialise(few(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), "links")
    while not settled(edges):
        edges = materialise(few(star(star(edges, large=True), large=False)), "stars")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return leaves.unionByName(leaves.select(F.col("label").alias("node"), "label").distinct())


# ---- the operator ------------------------------------------------------------------------------------------


def text_hash() -> Column:
    """With the id the key of a row: rows with both alike are judged alike."""
    return F.xxhash64("text")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, hashed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of ``docs``; with ``hashed`` also hash, its text_hash.

    Words are what white space leaves, A-Z lower-cased; a text with fewer than ``width`` words is one shingle. Rows
    are linked if 100 * common shingles >= ``percent`` * all shingles. A null or wordless text has no shingles, is
    linked with nothing and kept; its component is its own id. Repeated rows are one document. The component is the
    least id reachable; a null id counts as no id. Rows that reach no id have a null component and are kept.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_hash().alias("hash"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    sketches = materialise(rows.mapInArrow(lambda b: _sketch(b, width), f"doc_id {kind}, hash bigint, "
                                           "n_shingles bigint, set_id binary, regs binary"), "sketches")
    with_set = sketches.where("set_id IS NOT NULL")
    # Of each class one row is named by id and hash, or by its hash alone where no row has an id.
    named = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "hash"))).alias("named")
    classes = with_set.groupBy("set_id").agg(named, F.min("hash").alias("least_hash"), F.first("n_shingles").alias("n"),
                                             F.first("regs").alias("regs"))
    classes = materialise(classes.select("set_id", F.col("named.doc_id").alias("rep"), F.coalesce(
        "named.hash", "least_hash").alias("rep_hash"), "n", "regs"), "classes")
    links = _links(rows, classes, width, percent)

    labels = components(links)
    groups = classes.select("set_id", "rep").join(labels.withColumnRenamed("node", "set_id"), "set_id")
    least = groups.groupBy("label").agg(F.min("rep").alias("component_id"))
    linked = groups.join(least, "label").select("set_id", "component_id")
    ids = classes.select("set_id", "rep").join(linked, "set_id", "left").select(
        F.col("set_id").alias("of_set"), F.coalesce("component_id", "rep").alias("component_id"))
    placed = sketches.select("doc_id", "hash", "n_shingles", "set_id").join(ids, F.col("set_id") == F.col("of_set"), "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"), *(["hash"] if hashed else []))


def _links(rows: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes: enough of them to connect whatever is linked."""
    spark = rows.sparkSession
    bands = classes.select("set_id", "regs").mapInArrow(_bands, "band smallint, key bigint, set_id binary")
    crowded = bands.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("set_id").alias("least")).where(
        "size > 1")
    members = materialise(bands.join(crowded, ["band", "key"]), "buckets")

    wanted = classes.join(members.select("set_id").distinct(), "set_id", "left_semi")
    wanted = materialise(wanted.select(F.col("set_id").alias("want"), "rep", "rep_hash"), "wanted")
    reps = small_side(wanted.where("rep IS NOT NULL"), 64)
    with_id = rows.where("text IS NOT NULL").join(
        reps, (F.col("doc_id") == F.col("rep")) & (F.col("hash") == F.col("rep_hash"))).select("want", "text")
    # Rows without an id are named by their text alone, so copies come along; one of them is enough.
    reps = small_side(wanted.where("rep IS NULL"), 64)
    without = rows.where("text IS NOT NULL AND doc_id IS NULL").join(
        reps, F.col("hash") == F.col("rep_hash")).select("want", "text").dropDuplicates(["want"])
    texts = with_id.unionByName(without)
    sets = materialise(texts.mapInArrow(
        lambda b: _full_sets(b, width), "set_id binary, n bigint, regs binary, hashes binary")
        .dropDuplicates(["set_id"]), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        def side(x: str) -> DataFrame:
            return sets.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"),
                               F.col("hashes").alias(f"set_{x}"))

        both = pairs.join(side("b"), "b").join(side("a"), "a")
        return materialise(both.mapInArrow(lambda b: _confirm(b, percent), "a binary, b binary"), "confirmed")

    stars = members.where("set_id <> least").select(F.col("least").alias("a"), F.col("set_id").alias("b")).distinct()
    links = confirmed(stars)

    labels = components(links)
    now = members.select("band", "key", "size", "set_id").join(
        labels, F.col("set_id") == F.col("node"), "left").select(
        "band", "key", "size", "set_id", F.coalesce("label", "set_id").alias("label"))
    mixed = now.groupBy("band", "key").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.max("size").alias(
        "s")).where("l <> h AND s > 2").select("band", "key")
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set_id"), F.col("n_blocks")).cast("int")
    now = now.join(mixed, ["band", "key"], "left_semi").withColumn("n_blocks", n_blocks).withColumn("block", block)
    full = sets.mapInArrow(_short_sets, "of binary, n bigint, regs binary, set binary")
    dealt = now.join(full, F.col("set_id") == F.col("of")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
        "set_id", "label", "n", "regs", "set")
    order = ["band", "key", "low", "high"]
    pairs = dealt.repartition(shuffle_partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(
        lambda b: _block_pairs(b, percent), "a binary, b binary")
    return links.unionByName(confirmed(pairs.distinct()))


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Set, registers and size of the rows whose text has the wanted set."""
    for batch in slices(batches):
        wanted = batch.column(0).to_pylist()
        for rows, block in blocks(batch, "text"):
            n = len(block.texts)
            values, texts, sizes = shingle_sets(block, width)
            ids = set_ids(values, texts, n)
            regs = registers(values, texts, n).astype("<u2")
            first = np.concatenate([[0], np.cumsum(sizes)])
            keep = [i for i in range(n) if ids[i] == wanted[rows.start + i]]
            yield pa.record_batch([
                pa.array([ids[i] for i in keep], pa.binary()), pa.array(sizes[keep], pa.int64()),
                pa.array([regs[i].tobytes() for i in keep], pa.binary()),
                pa.array([values[first[i]: first[i + 1]].astype("<u8").tobytes() for i in keep], pa.binary())],
                names=["set_id", "n", "regs", "hashes"])


def _short_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets in the upper halves of their hashes, which stay sorted."""
    for batch in slices(batches):
        short = [np.unique(np.frombuffer(x, "<u8") >> U64(32)).astype("<u4").tobytes() for x in batch.column(3).to_pylist()]
        yield pa.record_batch([*batch.columns[:3], pa.array(short, pa.binary())], names=["of", "n", "regs", "set"])
