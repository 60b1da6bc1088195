"""Publish side: build form records from requests and drop configured fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions import jsonvals
from formweave.functions.text import has_prefix

EMPTY_RECORD = "{}"
HEADERS = ("organization", "team", "version", "formName")


def with_form_fields(requests: DataFrame) -> DataFrame:
    """Add `fields`, the body's members with their JSON types, NULL when the body is not an object, and the `mark` that
    its numbers carry."""
    rows = requests.withColumn("mark", jsonvals.number_mark("body", *HEADERS))
    return rows.withColumn("fields", jsonvals.object_values(jsonvals.parse(jsonvals.marked("body", "mark"))))


def without_prefixes(fields: Column, prefixes: list[str]) -> Column:
    """Members whose name starts with none of the prefixes, ignoring case."""
    if not prefixes:
        return fields
    return F.map_filter(fields, lambda name, _: ~has_prefix(name, prefixes))


def record_json(fields: Column) -> Column:
    record = F.to_json(F.struct(fields.alias("formData"), F.struct(*HEADERS).alias("formMetaData")))
    return jsonvals.plain_json(record, "mark")


def form_records(requests: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """Add `record`: the JSON to publish, ``{}`` for an empty form, NULL for a malformed body."""
    kept = without_prefixes(F.col("fields"), prefixes or [])
    record = F.when(F.size("fields") == 0, F.lit(EMPTY_RECORD)).when(F.col("fields").isNotNull(), record_json(kept))
    return with_form_fields(requests).withColumn("record", record).drop("fields", "mark")
