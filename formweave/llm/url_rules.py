"""URL filters by a sort-merge range join.

The labels of a host are reversed (``www.example.com`` becomes ``com.example.www.``), so a rule's host covers one
interval of the sorted keys: itself and all subdomains. Rules and urls are sorted together and swept once; the row
of a rule carries the stack of the rules that are open at its key, that is its own and those of the hosts above it.
The last stack before a url holds every rule whose host covers the url, because whatever sorts between a prefix and
a string with that prefix has the prefix too.

No sweep needs the others: urls are dealt evenly over sweeps by a hash of the row, whatever their host, and each
sweep gets all rules. A host with a third of all urls is therefore spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formweave.llm.blocks import LOWER, UPPER, shuffle_partitions

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str | Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as (host, path, verdict) rows."""
    quoted = [", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in rule) for rule in rules]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({x})" for x in quoted) + " AS r(host, path, verdict)")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key, and the rules open there, the longest first.

    The stack is as deep as the rules of one host and of the hosts above it. Rules without a host are dropped; of
    rules with equal host and path the verdict that sorts last (block) stands.
    """
    one = (rules.where("host <> ''").groupBy(F.translate("host", UPPER, LOWER).alias("host"),
                                            F.coalesce("path", F.lit("")).alias("path"))
           .agg(F.max("verdict").alias("verdict")))
    keyed = one.select(host_key(F.col("host")).alias("key"), "path", "verdict",
                       F.concat("host", "path").alias("rule"))
    hosts = keyed.select("key").distinct()
    labels = F.split("key", "[.]", -1)
    above = hosts.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("host_key"))
    open_rules = above.distinct().join(keyed.withColumnRenamed("key", "host_key"), "host_key")
    entry = F.struct(F.length("rule").alias("size"), F.length("host_key").alias("host_size"), "host_key", "path",
                     "rule", "verdict")
    return open_rules.groupBy("key").agg(F.sort_array(F.collect_list(entry), asc=False).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages``.

    A rule fits if its host is the url's or above it and the url's path starts with its path; the rule with the
    longest text wins, then the one with the longer host. A url that is null or has no ``://`` has an empty host
    and path, fits no rule, and gets the default verdict, as does every url that fits none.
    """
    spark = pages.sparkSession
    sweeps = 3 * shuffle_partitions(spark)
    urls = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"),
                        F.pmod(F.xxhash64("page_id", "url"), F.lit(sweeps)).alias("sweep"))
    urls = urls.withColumn("key", host_key(F.col("host"))).withColumn("is_url", F.lit(1))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(sweeps - 1).cast("bigint")))
    stacks = rule_stacks(rules).select(every.alias("sweep"), "key", "stack", F.lit(0).alias("is_url"))
    sweep = Window.partitionBy("sweep").orderBy("key", "is_url").rowsBetween(Window.unboundedPreceding, 0)
    swept = (urls.unionByName(stacks, allowMissingColumns=True)
             .withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("is_url = 1"))
    fit = F.get(F.filter("open", lambda r: F.col("key").startswith(r["host_key"])
                         & F.col("path").startswith(r["path"])), F.lit(0))
    return swept.select("page_id", "host", "path", fit.alias("fit")).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.lit(default)).alias("verdict"))
