"""Apply a rule CSV to the rule table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from formweave.operators.rules import apply_changes, csv_changes
from formweave.sinks.files import write_rules
from formweave.sources.rules import newest_version, rule_bucket, rule_csv, rules_at


def load_rules(spark: SparkSession, csv_path: str, rules_path: str, multi_line: bool = True) -> int:
    """Write the next version of the rule table and return its number. Only the buckets of forms and fields that the
    file names are read and written. Older versions stay readable. Cells may hold line breaks unless ``multi_line`` is
    off, which lets large files be split."""
    changes = csv_changes(rule_csv(spark, csv_path, multi_line))
    touched = sorted(r.bucket for r in changes.select(rule_bucket()).distinct().collect())
    version = newest_version(spark, rules_path) + 1
    write_rules(apply_changes(rules_at(spark, rules_path, buckets=touched), changes), rules_path, version, touched)
    return version
