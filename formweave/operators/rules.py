"""De-identification rules: reading, filtering, grouping by form, and applying a CSV of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formweave.functions.text import ci_equals, trim_cell
from formweave.session import fresh_dir, remove_older, shared_dir

# The marker of a switched-off rule and the three techniques.
DELETED = "DELETED"
TECHNIQUES = ("CRYPTOHASHING", "REDACTION", "MASKING")

KEY = ("formName", "fieldName")
RULE = (*KEY, "dlpTechnique")

# Lines per block when a change file is scanned in order.
CHUNK_LINES = 100_000


# ---- the reader's view -------------------------------------------------------------------------------

def is_active_for_reader() -> Column:
    """All four cells present and not marked deleted, in any case. NULL info is off, an empty one is on."""
    return (F.col("formName").isNotNull() & F.col("fieldName").isNotNull() & F.col("dlpTechnique").isNotNull()
            & F.col("addnl_info").isNotNull() & ~ci_equals("addnl_info", F.lit(DELETED)))


def active_rules(rules: DataFrame) -> DataFrame:
    return rules.where(is_active_for_reader())


def is_technique(name: str) -> Column:
    return ci_equals("dlpTechnique", F.lit(name))


def rules_by_form(rules: DataFrame) -> DataFrame:
    """One row per form, ignoring case: the distinct fields of each technique, sorted.

    Duplicates fold away on the map side, so a group's size is its number of distinct fields.
    """
    fields = {t.lower(): F.array_sort(F.collect_set(F.when(is_technique(t), F.col("fieldName")))) for t in TECHNIQUES}
    return (active_rules(rules).groupBy(F.lower("formName").alias("form_key"))
            .agg(*[c.alias(f"{name}_fields") for name, c in fields.items()]))


# ---- the loader's view -------------------------------------------------------------------------------

def is_active_for_loader() -> Column:
    """The loader's lookup is case-sensitive and does not test the technique."""
    return F.col("addnl_info").isNotNull() & (F.col("addnl_info") != DELETED)


def is_valid_row() -> Column:
    """Four cells, the first three not empty. Tested before trimming."""
    return (F.col("_corrupt").isNull() & (F.length("formName") > 0) & (F.length("fieldName") > 0)
            & (F.length("dlpTechnique") > 0))


def csv_changes(rows: DataFrame) -> DataFrame:
    """Valid CSV rows as changes: trimmed cells and `action`, D for a deletion and U for an upsert."""
    action = F.when(ci_equals(trim_cell("addnl_info"), F.lit(DELETED)), F.lit("D")).otherwise(F.lit("U"))
    return rows.where(is_valid_row()).select("pos", *[trim_cell(c).alias(c) for c in RULE], action.alias("action"))


def _chunk() -> Column:
    """Block of lines a change lies in. Blocks are in line order and of bounded size, however hot a key is."""
    return F.struct("pos.file", "pos.block", F.floor(F.col("pos.row") / CHUNK_LINES).alias("part")).alias("chunk")


def nearest_behind(rows: DataFrame, keys: tuple[str, ...], value: str, into: str) -> DataFrame:
    """Add the first non-NULL `value` among the rows of the same keys that lie behind each row.

    A scan in two levels, so that no task holds a whole key: running windows inside blocks of lines, and one
    row per block to carry values over from the blocks behind.
    """
    by_block = rows.withColumn("chunk", _chunk())
    inside = Window.partitionBy(*keys, "chunk").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (by_block.groupBy(*keys, "chunk")
              .agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col("pos"))).alias("front")))
    across = Window.partitionBy(*keys).orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(*keys, "chunk", F.last("front", ignorenulls=True).over(across).alias("carried"))
    return (by_block.withColumn(into, F.last(value, ignorenulls=True).over(inside))
            .join(carried, [*keys, "chunk"])
            .withColumn(into, F.coalesce(into, "carried")).drop("chunk", "carried"))


def _inserting(upserts: DataFrame, deletions: DataFrame) -> DataFrame:
    """The upserts that insert a row, given that nothing is active before the first one of each key.

    An upsert inserts only if no rule of its key is active, so after one inserts, the next that can is the
    first one behind the deletion of that rule. Which upserts lie on the chain of these links that starts at
    each key's first upsert is found by doubling the links: after n rounds the first 2**n insertions of every
    key are known, and the next round adds the 2**n behind them. No key's changes are ever gathered in one value.

    Each round is written and read again as files. A checkpoint would do for the rows, but its plan keeps what is known
    of the columns of all rounds before (their constraints), which multiplies round by round in the driver; and its
    partitions add up. The rows of these files take many times the space of the files, by whose size a join would be
    made a broadcast from the driver: the joins are by merging.
    """
    no_pos = F.lit(None).cast(upserts.schema["pos"].dataType)
    both = upserts.withColumn("removal", no_pos).unionByName(deletions.withColumn("removal", F.col("pos")))
    removed = (nearest_behind(both, RULE, "removal", "gone")
               .where("removal is null and gone is not null").select(*KEY, "pos", "gone"))

    # The first upsert behind each removal: upserts and removal points of a key in one line order.
    marks = (upserts.select(*KEY, "pos", F.col("pos").alias("upsert"))
             .unionByName(removed.select(*KEY, F.col("gone").alias("pos"), no_pos.alias("upsert")).distinct()))
    behind = nearest_behind(marks, KEY, "upsert", "next").where("upsert is null and next is not null")
    links = removed.join(behind.select(*KEY, F.col("pos").alias("gone"), "next"), [*KEY, "gone"])
    links = links.select(*KEY, "pos", "next")

    # One table holds both: known insertions have no `next`, links have one.
    no_next = no_pos.alias("next")
    state = upserts.groupBy(*KEY).agg(F.min("pos").alias("pos")).select(*KEY, "pos", no_next).unionByName(links)
    spark, place, rounds = upserts.sparkSession, fresh_dir(upserts.sparkSession, "insertions"), 0

    def written(rows: DataFrame) -> DataFrame:
        """A round as files; those of the round before go."""
        path = f"round={rounds}"
        rows.write.parquet(f"{place}/{path}")
        remove_older(spark, place, {path}, 0)
        return spark.read.schema(rows.schema).parquet(f"{place}/{path}")

    state = written(state)
    while not state.where("next is not null").isEmpty():
        rounds += 1
        reached, links = state.where("next is null"), state.where("next is not null")
        ahead = reached.drop("next").join(links.hint("merge"), [*KEY, "pos"]).select(*KEY, F.col("next").alias("pos"), no_next)
        beyond = links.select(*KEY, F.col("pos").alias("next"), F.col("next").alias("after"))
        jumps = links.join(beyond.hint("merge"), [*KEY, "next"]).select(*KEY, "pos", F.col("after").alias("next"))
        state = written(reached.unionByName(ahead).unionByName(jumps))
    return state.select(*KEY, "pos")


def apply_changes(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """The rule table after the changes, applied in the order of `pos`.

    A deletion marks every rule of its (form, field, technique). An upsert adds a rule with empty info, if no
    rule of its (form, field) is active at that point.
    """
    # The changes are used in several places; read them, and decide which upserts count, only once.
    shared_dir(changes.sparkSession)
    changes = changes.checkpoint()
    upserts, deletions = changes.where("action = 'U'").drop("action"), changes.where("action = 'D'").drop("action")
    spans = deletions.groupBy(*RULE).agg(F.min("pos").alias("first_del"), F.max("pos").alias("last_del"))

    # Rules already in the table: any deletion of the same rule marks them.
    old = rules.join(spans, list(RULE), "left")
    kept = old.select(*RULE, F.when(F.col("first_del").isNotNull(), F.lit(DELETED))
                      .otherwise(F.col("addnl_info")).alias("addnl_info"))

    # While one of them is active, upserts of the key add nothing.
    blocked = (old.where(is_active_for_loader()).groupBy(*KEY)
               .agg(F.count_if(F.col("first_del").isNull()).alias("never"), F.max("first_del").alias("until")))
    open_upserts = (upserts.join(blocked, list(KEY), "left")
                    .where(F.col("never").isNull() | ((F.col("never") == 0) & (F.col("pos") > F.col("until"))))
                    .select("pos", *RULE).checkpoint())

    inserted = _inserting(open_upserts, deletions)
    added = (open_upserts.join(inserted.hint("merge"), [*KEY, "pos"], "left_semi").join(spans, list(RULE), "left")
             .select(*RULE, F.when(F.col("last_del") > F.col("pos"), F.lit(DELETED))
                     .otherwise(F.lit("")).alias("addnl_info")))
    return kept.unionByName(added)
