"""Flatten nested JSON to one level and turn the paths into column names.

Paths read ``a.b`` and ``a[0].c``; a member whose name holds a dot or a bracket reads ``["k.z"]``. Empty
objects and arrays are leaves. A document is flattened inside its own row, so nothing is exploded, shuffled
or regrouped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions import jsonvals
from formweave.functions.text import column_name
from formweave.operators.parse import FORM_META
from formweave.session import shared_dir, spread_partitions

COLLISION = "COLUMNS: two keys give one column name"
EMPTY_NAME = "COLUMNS: a key gives an empty column name"


def root_entries(doc: str, path: str = "") -> str:
    """SQL text of the entries (path, value) to start from: the whole document in column `doc`."""
    return f"array(named_struct('path', '{path}', 'value', {doc}))"


def next_level(entries: str) -> str:
    """SQL text that replaces every non-empty object or array among `entries` by its members."""
    members, elements = "try_cast(e.value AS map<string,variant>)", "try_cast(e.value AS array<variant>)"
    member_path = """CASE WHEN translate(m.key, '.[]', '') <> m.key THEN concat(e.path, '["', m.key, '"]')
        WHEN e.path = '' THEN m.key ELSE concat(e.path, '.', m.key) END"""
    return f"""flatten(transform({entries}, e -> CASE
        WHEN size({members}) > 0
        THEN transform(map_entries({members}), m -> named_struct('path', {member_path}, 'value', m.value))
        WHEN size({elements}) > 0
        THEN transform({elements}, (x, i) -> named_struct('path', concat(e.path, '[', i, ']'), 'value', x))
        ELSE array(e) END))"""


def entry_texts(entries: Column, mark: str) -> Column:
    """MAP<path, text> of the entries, numbers as they were written."""
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(
        e["path"], F.coalesce(jsonvals.plain(e["value"].try_cast("string"), mark), F.lit("null")))))


def all_levels(entries: str, depth: str) -> str:
    """SQL text that flattens `depth` levels, a number of the row's own: one expression for any depth, and shallow
    documents do not pay for a deep one."""
    return f"aggregate(sequence(1, greatest({depth}, 1)), {entries}, (entries, level) -> {next_level('entries')})"


def flatten_json(df: DataFrame, text: str, into: str = "flat") -> DataFrame:
    """Add `into`, the MAP<path, text> of the JSON documents in column `text`; NULL where malformed. A document of any
    depth is flattened in full, within its row."""
    rows = df.withColumn("_depth", jsonvals.nesting_depth(text)).withColumn("_mark", jsonvals.number_mark(text))
    rows = rows.withColumn("_doc", jsonvals.parse(jsonvals.marked(text, "_mark")))
    entries = F.expr(f"CASE WHEN _doc IS NOT NULL THEN {all_levels(root_entries('_doc'), '_depth')} END")
    return rows.withColumn(into, entry_texts(entries, "_mark")).drop("_doc", "_depth", "_mark")


def odd_metadata() -> Column:
    """Does the metadata hold a nested member or a name that needs quoting? One regular expression each."""
    values = F.rlike(F.array_join(F.map_values("meta"), "\n"), F.lit(r"(^|\n)[{\[]"))
    return values | F.rlike(F.array_join(F.map_keys("meta"), ""), F.lit(r"[.\[\]]"))


def flat_metadata(odd: Column) -> Column:
    """MAP<path, text> of the metadata under its reserved name. Plain metadata skips the nested branch."""
    entries = all_levels(root_entries("meta_doc", FORM_META), "meta_depth")
    plain = F.transform_keys(jsonvals.null_as_text("meta"), lambda k, _: F.concat(F.lit(FORM_META + "."), k))
    return F.when(odd, entry_texts(F.expr(entries), "mark")).otherwise(plain)


def name_error(names: Column) -> Column:
    """Why names cannot be the columns of a row, or NULL. Spark column names ignore case."""
    distinct = F.size(F.array_distinct(F.transform(names, F.lower)))
    return (F.when(F.array_contains(names, ""), F.lit(EMPTY_NAME))
            .when(distinct < F.size(names), F.lit(COLLISION)))


def last_of_each(names: Column, texts: Column) -> Column:
    """MAP<name, text> that keeps the last entry of names that are the same but for case."""
    lowered = F.transform(names, F.lower)

    def is_last(_: Column, i: Column) -> Column:
        return ~F.array_contains(F.slice(lowered, i + 2, F.size(names)), F.get(lowered, i))

    entries = F.zip_with(names, texts, lambda n, t: F.struct(n.alias("key"), t.alias("value")))
    return F.map_from_entries(F.filter(entries, is_last))


def with_columns_map(forms: DataFrame, collision: str = "reject") -> DataFrame:
    """Add `columns` (normalised names to text) and complete `error`. Form values are already text, so only
    the metadata can still be nested. Each step is a projection of its own, so nothing is computed twice.

    Two keys that give one column reject the message; ``collision="last"`` keeps the last one.
    """
    rows = forms.withColumn("odd", odd_metadata())
    rows = rows.withColumn("meta_depth", F.when(F.col("odd"), jsonvals.nesting_depth(F.to_json("meta_doc"))))
    rows = rows.withColumn("flat", F.when(F.col("error").isNull(), flat_metadata(F.col("odd"))))
    paths = F.concat(F.map_keys("values"), F.map_keys("flat"))
    rows = rows.withColumn("names", F.transform(paths, column_name))
    problem = name_error(F.col("names"))
    if collision == "last":
        problem = F.nullif(problem, F.lit(COLLISION))
    rows = rows.withColumn("error", F.coalesce("error", problem))
    texts = F.concat(F.map_values("values"), F.map_values("flat"))
    named = F.map_from_arrays("names", texts) if collision == "reject" else last_of_each(F.col("names"), texts)
    columns = F.when(F.col("error").isNull(), named)
    return rows.withColumn("columns", columns).drop("odd", "meta_depth", "flat", "names", "values", "meta_doc")


def flatten_rows(df: DataFrame, text: str, *keep: str, spread_bytes: int = 1 << 20) -> DataFrame:
    """(`keep` columns, path, value): one row per leaf of the JSON documents in column `text`, as `flatten_json` gives
    them in one map. Objects and arrays of more than `spread_bytes` are exploded level by level, and their members dealt
    over the tasks, so that neither a task nor a value holds all leaves of a huge document. What is smaller is flattened
    within its row. Malformed documents have no rows.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rows = df.select(*keep, F.lit("").alias("path"), F.col(text).alias("_text")).withColumn(
        "_mark", jsonvals.number_mark("_text"))
    rows = rows.withColumn("value", jsonvals.parse(jsonvals.marked("_text", "_mark"))).where("value IS NOT NULL")
    rows, done = rows.drop("_text"), []
    while True:
        sized = rows.withColumn("_json", F.to_json("value"))
        nested = F.coalesce(F.size(F.expr("try_cast(value AS map<string,variant>)")), F.lit(-1)) > 0
        nested |= F.coalesce(F.size(F.expr("try_cast(value AS array<variant>)")), F.lit(-1)) > 0
        sized = sized.withColumn("_wide", nested & (F.octet_length("_json") > spread_bytes))
        small = sized.where("NOT _wide").withColumn("_depth", jsonvals.nesting_depth("_json"))
        entries = F.expr(all_levels("array(named_struct('path', path, 'value', value))", "_depth"))
        leaves = small.select(*keep, "_mark", F.explode(entries).alias("e"))
        done.append(leaves.select(*keep, F.col("e.path").alias("path"), F.coalesce(
            jsonvals.plain(F.col("e.value").try_cast("string"), "_mark"), F.lit("null")).alias("value")))
        wide = sized.where("_wide").select(*keep, "path", "_mark", "value")
        # Each step is kept: the next one must not start at the whole document again.
        step = spark.sql("""SELECT w.* EXCEPT (path, value), CASE WHEN m.key IS NULL THEN concat(w.path, '[', m.pos, ']')
                WHEN translate(m.key, '.[]', '') <> m.key THEN concat(w.path, '["', m.key, '"]')
                WHEN w.path = '' THEN m.key ELSE concat(w.path, '.', m.key) END AS path, m.value
            FROM {wide} AS w, LATERAL variant_explode(w.value) AS m""", wide=wide)
        rows = step.repartition(spread_partitions(spark)).checkpoint()
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done)
