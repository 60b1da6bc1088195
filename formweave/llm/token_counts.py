"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of up to ``chunk_chars`` characters is encoded in one piece. A longer one is cut into chunks that overlap
around each cut, the chunks are dealt over the cluster and encoded with offsets, and at each cut the two encodings
are spliced at a boundary that both have with the same token on either side. That boundary is proven: a token
sequence is the byte-pair encoding of its text exactly if each two neighbours encode to themselves (the first merge
across a boundary would happen in the two neighbours alone as well), and after the splice every two neighbours
stand together in one of the two encodings. The first token of a chunk is left out, as the encoder puts a space
before it. Where no such boundary lies in the overlap, the text is encoded again with an overlap four times as
wide, in the end in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import materialise, ship, shuffle_partitions, slices

CHUNK_CHARS = 32_000
OVERLAP = 256


@cache
def load(model: str):
    """The tokenizer and the ids of its byte tokens, once per Python worker."""
    import sentencepiece

    tokenizer = sentencepiece.SentencePieceProcessor(model_file=model)
    return tokenizer, frozenset(i for i in range(tokenizer.get_piece_size()) if tokenizer.is_byte(i))


def _count(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    tokenizer, _ = load(model)
    for batch in slices(batches):
        texts = [x or "" for x in batch.column(1).to_pylist()]
        n_bytes = [len(x.encode()) for x in texts]
        n_tokens = list(map(len, tokenizer.encode(texts, num_threads=1)))
        yield pa.record_batch([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                              names=["doc_id", "n_bytes", "n_tokens"])


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(number, offset, first cut, last cut) of the chunks: each runs from its offset to ``overlap`` after its last
    cut. A text that is not longer than the overlaps of one chunk stays whole."""
    n = len(text)
    if n <= chunk + 2 * overlap:
        return [(0, 0, 0, n)]
    cuts = [*range(0, n, chunk), n]
    return [(i, max(0, a - overlap), a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for number, offset, first, last in cut(text, chunk, overlap):
                piece = text[offset: min(len(text), last + overlap)]
                yield pa.record_batch([pa.array([digest]), pa.array([number], pa.int32()), pa.array([offset]),
                                       pa.array([first]), pa.array([last]), pa.array([last == len(text)]),
                                       pa.array([piece])],
                                      names=["digest", "number", "offset", "first", "last", "is_last", "piece"])


SIDE = pa.map_(pa.string(), pa.int64())


def boundaries(ids: list[int], spans: list[tuple[int, int]], offset: int, at: int, overlap: int,
               bytes_: frozenset[int]) -> list[tuple[str, int]]:
    """Token boundaries within the overlap around a cut: (place and the two tokens, tokens before it)."""
    out = []
    for i in range(1 if offset == 0 else 2, len(ids)):
        place = offset + spans[i][0]
        if place < at - overlap:
            continue
        if place > at + overlap:
            break
        if ids[i - 1] not in bytes_ and ids[i] not in bytes_ and spans[i - 1][1] == spans[i][0]:
            out.append((f"{place}:{ids[i - 1]}:{ids[i]}", i))
    return out


def _encode(batches: Iterator[pa.RecordBatch], model: str, overlap: int) -> Iterator[pa.RecordBatch]:
    tokenizer, bytes_ = load(model)
    for batch in batches:
        rows = batch.to_pydict()
        heads, tails, counts = [], [], []
        for offset, first, last, is_last, piece in zip(rows["offset"], rows["first"], rows["last"], rows["is_last"],
                                                       rows["piece"]):
            code = tokenizer.encode(piece, num_threads=1, return_type="offset_mapping")
            ids, spans = code["ids"], code["offsets"]
            counts.append(len(ids))
            heads.append([] if first == 0 else boundaries(ids, spans, offset, first, overlap, bytes_))
            tails.append([] if is_last else [
                (k, len(ids) - i) for k, i in boundaries(ids, spans, offset, last, overlap, bytes_)])
        yield pa.record_batch([pa.array(rows["digest"], pa.string()), pa.array(rows["number"], pa.int32()),
                               pa.array(rows["is_last"], pa.bool_()), pa.array(counts, pa.int64()),
                               pa.array(heads, SIDE), pa.array(tails, SIDE)],
                              names=["digest", "number", "is_last", "n_tokens", "head", "tail"])


def spliced(texts: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    """digest, n_tokens of distinct huge texts; n_tokens is null where some cut could not be spliced."""
    pieces = texts.select("digest", "text").mapInArrow(
        lambda b: _chunks(b, chunk, overlap),
        "digest string, number int, offset bigint, first bigint, last bigint, is_last boolean, piece string")
    coded = pieces.repartition(shuffle_partitions(texts.sparkSession), "digest", "number").mapInArrow(
        lambda b: _encode(b, model, overlap),
        "digest string, number int, is_last boolean, n_tokens bigint, head map<string,bigint>, "
        "tail map<string,bigint>")
    # The two sides of a cut meet under its number; the token counts ride with the left side.
    coded = coded.withColumn("sides", F.array(F.lit("head"), F.lit("tail"))).withColumn("side", F.explode("sides"))
    is_head = F.col("side") == "head"
    cuts = coded.groupBy("digest", (F.col("number") + F.when(is_head, 0).otherwise(1)).alias("cut")).agg(
        F.sum(F.when(is_head, F.col("n_tokens")).otherwise(0)).alias("n_tokens"),
        F.first(F.when(is_head, F.col("head")), ignorenulls=True).alias("head"),
        F.first(F.when(~is_head, F.col("tail")), ignorenulls=True).alias("tail"),
        F.max(~is_head & F.col("is_last")).alias("ends"))
    common = F.get(F.array_intersect(F.map_keys("tail"), F.map_keys("head")), F.lit(0))
    double = F.when((F.col("cut") == 0) | F.col("ends"), F.lit(0)).otherwise(
        F.element_at("head", common) + F.element_at("tail", common))
    counted = cuts.select("digest", "n_tokens", double.alias("double"))
    return counted.groupBy("digest").agg(
        F.when(F.count("double") == F.count("*"), F.sum("n_tokens") - F.sum("double")).alias("n_tokens"))


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, chunk_chars: int = CHUNK_CHARS,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of ``docs``; a null or empty text has no bytes and tokens.

    ``model`` is the path of the vocabulary file on every machine. Repeated huge texts are encoded once.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    is_huge = F.coalesce(F.length("text") > chunk_chars, F.lit(False))
    kind = dict(rows.dtypes)["doc_id"]
    plain = rows.where(~is_huge).mapInArrow(lambda b: _count(b, model),
                                            f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    huge = materialise(rows.where(is_huge).withColumn("digest", F.sha2("text", 256)), "huge-texts")
    left, done, width = huge.dropDuplicates(["digest"]), None, overlap
    while not left.isEmpty():
        counted = materialise(spliced(left, model, chunk_chars, width), "huge-counts")
        known = counted.where("n_tokens IS NOT NULL")
        done = known if done is None else done.unionByName(known)
        left = left.join(counted.where("n_tokens IS NULL").select("digest"), "digest", "left_semi")
        width *= 4
    if done is not None:
        plain = plain.unionByName(huge.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
                                  .join(done, "digest").drop("digest"))
    return plain.withColumn("over_limit", F.col("n_tokens") > limit)
