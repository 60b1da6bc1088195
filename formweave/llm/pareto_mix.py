"""Mixing sources to target weights by Pareto order sampling.

A document is to be taken ``expected = min(most, level * weight)`` times on average, where its weight is about the
square root of its size (the power of two below it), so long documents are likelier than short ones, and the level of
its source makes the expected words of the source its target. It is taken ``floor(expected)`` times for certain and
once more with the chance that is left. Who is taken once more is settled by Pareto order sampling: a document's rank
is the odds of its random number over the odds of its chance, and the lowest ranks are taken until the words still
missing are there. The random number is a digest of the id, so reruns agree. The SETTLED documents around that place
are settled together: of all ways to take each of them up to two times more, within ``most``, the one nearest to the
target is taken.

The running sum over ranks is split: ranks fall into a fixed number of bins, bins are summed, and only the few bins
of each source around the place where the sum passes the target are sorted. No source is sorted as a whole, and what
is settled is one place in the ranks and SETTLED documents per source, by which each row is then judged on its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.blocks import SPACE_WORD, materialise

BINS = 4096
SETTLED = 9


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Words wanted of each source: source, source_size, target. One row per source passes through one task.

    Sources in code-point order, null last, take the weights in turn. A source gives at most ``most`` times its
    words, and what it cannot give is shared again by weight: with the sources ordered by the words at which they
    are full per unit of weight, the common level follows from two running sums.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))),
                                                      (turn % len(weights) + 1).cast("int")))
    filled = Window.orderBy(F.col("full"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    levels = (weighted.withColumn("cap", F.col("source_size") * F.lit(float(most)))
              .withColumn("full", F.col("cap") / F.col("weight"))
              .withColumn("level", (F.sum("source_size").over(whole) * F.lit(float(share))
                                    - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    # The first source that its level leaves below its cap sets the level of all; if none is, all are full.
    level = -F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", -F.col("level")))).over(whole)["col2"]
    return levels.select("source", "source_size",
                         F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap")).alias("target"))


def weight_of(size: Column) -> Column:
    """The power of two at or below the square root of a size of 1 or more: at most 32 different weights."""
    bits = F.length(F.bin(size))
    return F.pow(F.lit(2.0), F.floor((bits - 1) / 2).cast("double"))


def chances(sizes: DataFrame, wanted: DataFrame, most: float) -> DataFrame:
    """Per source and weight: source_size, target, whole (copies taken for certain), chance (of one more) and missing
    (words of the source that the chances are to give). Each source passes through one task as up to 32 rows."""
    classes = sizes.where("size > 0").groupBy("source", weight_of(F.col("size")).alias("weight")).agg(
        F.sum("size").alias("words"))
    targets_of = wanted.withColumnRenamed("source", "target_of")
    classes = classes.join(targets_of, F.col("source").eqNullSafe(F.col("target_of"))).drop("target_of")
    source = Window.partitionBy("source")
    heavier = source.orderBy(F.desc("weight")).rowsBetween(Window.unboundedPreceding, -1)
    sums = (classes.withColumn("full", F.coalesce(F.sum("words").over(heavier), F.lit(0)) * F.lit(float(most)))
            .withColumn("rest", F.sum(F.col("words") * F.col("weight")).over(source)
                        - F.coalesce(F.sum(F.col("words") * F.col("weight")).over(heavier), F.lit(0.0)))
            .withColumn("level", (F.col("target") - F.col("full")) / F.col("rest")))
    # The heaviest weight that its level leaves below the most sets the level; if none does, all are taken at most.
    open_level = F.when(F.col("level") * F.col("weight") <= most, F.struct("weight", "level"))
    level = F.max(open_level).over(source)["level"]
    expected = F.coalesce(F.least(F.lit(float(most)), level * F.col("weight")), F.lit(float(most)))
    taken = sums.withColumn("expected", expected).withColumn("whole", F.floor("expected").cast("long"))
    return taken.select(F.col("source").alias("of"), F.col("weight").alias("of_weight"), "whole",
                        (F.col("expected") - F.col("whole")).alias("chance"),
                        (F.col("target") - F.sum(F.col("whole") * F.col("words")).over(source)).alias("missing"))


def nearest_copies(entries: Column, gap: Column) -> Column:
    """For a short array of entries (words, room), how often to take each, from 0 to ``room`` (at most 2) times, so that
    the words come nearest to ``gap``; of equally near ways the first, counted with the first entry as lowest digit."""
    def further(made: Column, entry: Column) -> Column:
        twice = F.when(entry["room"] >= 2, 2 * entry["words"])
        return F.concat(made, F.transform(made, lambda x: x + entry["words"]), F.transform(made, lambda x: x + twice))

    sums = F.aggregate(entries, F.array(F.lit(0).cast("long")), further)
    off = F.transform(sums, lambda x, i: F.struct(F.coalesce(F.abs(gap - x), F.lit(float("inf"))).alias("off"),
                                                  i.alias("way")))
    way = F.array_min(off)["way"]
    return F.transform(entries, lambda _, i: F.floor(way / F.pow(F.lit(3.0), i)).cast("long") % 3)


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: str = "mix", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, size, source_size, target, taken and copies of each row of ``docs``.

    A null text has size 0, and a document of size 0 adds nothing and is not taken; a null source is a source of its
    own. No document is taken more than ``most`` times, rounded up. Ranks that are equal go by id, then by size; rows
    that are equal in source, id and size are taken alike. A very long text is one document like any other: where it holds
    most of its source's words, the source may miss its target by up to half of it.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("long")
    sizes = materialise(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")
    wanted = materialise(targets(sizes, weights, share, most), "mix-targets")
    rates = materialise(chances(sizes, wanted, most), "mix-chances")

    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    random = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))

    def ranked(rows: DataFrame, how: str) -> DataFrame:
        mine = F.col("source").eqNullSafe(F.col("of")) & (weight_of(F.col("size")) == F.col("of_weight"))
        out = rows.join(rates, mine, how).withColumn("random", random)
        out = out.withColumn("rank", F.when((F.col("missing") > 0) & (F.col("chance") > 0), F.col("random") / (
            1 - F.col("random")) / (F.col("chance") / (1 - F.col("chance")))))
        return out.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))

    drawn = ranked(sizes.where("size > 0"), "inner").where("rank IS NOT NULL")
    bins = drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.count("*").alias("n"),
                                              F.first("missing").alias("missing"))
    source = Window.partitionBy("source")
    earlier = source.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (bins.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
            .withColumn("n_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .withColumn("is_edge", (F.col("before") <= F.col("missing"))
                        & (F.col("missing") < F.col("before") + F.col("words")))
            .withColumn("first", F.max(F.when(F.col("is_edge"), F.col("n_before"))).over(source))
            .withColumn("last", F.max(F.when(F.col("is_edge"), F.col("n_before") + F.col("n"))).over(source)))
    around = bins.where((F.col("n_before") + F.col("n") > F.col("first") - SETTLED)
                        & (F.col("n_before") < F.col("last") + SETTLED))
    around = around.select(F.col("source").alias("around"), F.col("bin").alias("around_bin"),
                           F.min("before").over(source).alias("before"))
    around = materialise(around, "mix-bins")

    # Rows that are equal in id and size are one entry.
    entries = drawn.join(around, F.col("source").eqNullSafe(F.col("around")) & (F.col("bin") == F.col("around_bin")))
    entries = entries.groupBy("source", "rank", "doc_id", "size").agg(
        F.sum("size").alias("words"), F.first("missing").alias("missing"), F.first("before").alias("before"),
        (math.ceil(most) - F.first("whole")).alias("room"))
    in_order = source.orderBy("rank", "doc_id", "size")
    entries = (entries.withColumn("so_far", F.col("before") + F.sum("words").over(
                   in_order.rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("nth", F.row_number().over(in_order))
               .withColumn("cut", F.sum((F.col("so_far") <= F.col("missing")).cast("int")).over(source)))
    nearest = source.orderBy(F.abs(F.col("nth") - F.col("cut") - 0.5), "nth")
    entries = entries.withColumn("near", F.row_number().over(nearest)).where(F.col("near") <= SETTLED)
    settled = entries.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("nth", "rank", "doc_id", "size", "words", "so_far", "room"))).alias("e"),
        F.first("missing").alias("missing"))
    settled = settled.withColumn("more", nearest_copies(
        F.col("e"), F.col("missing") - (F.col("e")[0]["so_far"] - F.col("e")[0]["words"])))
    place = F.struct("rank", "doc_id", "size")
    places = F.transform(F.col("e"), lambda x: F.struct(x["rank"].alias("rank"), x["doc_id"].alias("doc_id"),
                                                        x["size"].alias("size")))
    settled = settled.select(F.col("source").alias("settled_of"), places.alias("settled"), "more")
    settled = materialise(settled, "mix-settled")  # its size is known then, and no text is shuffled by source

    narrow = set(carry) <= {"doc_id", "source"}
    rows = sizes if narrow else docs.select(*dict.fromkeys((*carry, "doc_id", "source")), size.alias("size"))
    per_source = wanted.withColumnRenamed("source", "target_of")
    rows = (ranked(rows, "left").join(per_source, F.col("source").eqNullSafe(F.col("target_of")), "left")
            .join(settled, F.col("source").eqNullSafe(F.col("settled_of")), "left"))
    nth = F.array_position("settled", place)  # from 1, 0 if the document is not among them
    more = F.when(nth > 0, F.element_at("more", nth.cast("int"))).when(place < F.col("settled")[0], 1)
    copies = F.coalesce("whole", F.lit(0)) + F.when(F.col("rank").isNotNull(), F.coalesce(more, F.lit(0))).otherwise(0)
    return rows.select(*carry, "size", "source_size", "target",
                       (F.col("size") * copies).alias("taken"), copies.alias("copies"))
