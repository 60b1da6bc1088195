"""Payloads in the archive, by the URL that an error row or a form row has."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.functions.text import table_name
from formweave.session import small_side

ARCHIVED = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("file_url", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("key_name", T.StringType()),
    T.StructField("formName", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.IntegerType()),
])
# The folders in a URL, before the object's name: month and day.
DATED = r"/(\d{4}-\d{2})/(\d{1,2})/[^/]*\.json$"

# What a URL tells of its payload's place: the form, and the folder.
NEAR = ("form", "month", "day")


def archived(spark: SparkSession, path: str) -> DataFrame:
    """All stored payloads; month and day are partition columns."""
    return spark.read.schema(ARCHIVED).parquet(path)


def url_month(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(url, DATED, 1), F.lit(""))


def url_day(url: Column | str) -> Column:
    return F.regexp_extract(url, DATED, 2).try_cast("int")


def payloads_of(errors: DataFrame, archive: DataFrame) -> DataFrame:
    """The stored payloads of error rows (formName, errorFormData), each once. Folders of days without an error
    are pruned when the query runs, and of the others only payloads of forms with an error that day meet the URLs, so
    that no others are shuffled where there are too many URLs to broadcast. Rows without a URL find nothing."""
    wanted = errors.where(F.length("errorFormData") > 0).select(
        table_name("formName").alias("form"), url_month("errorFormData").alias("month"), url_day("errorFormData").alias("day"),
        F.col("errorFormData").alias("file_url")).distinct()
    near = small_side(wanted.select(*NEAR).distinct(), "error-days")
    return archive.join(near, list(NEAR), "left_semi").join(wanted, [*NEAR, "file_url"], "left_semi")


def payload_at(archive: DataFrame, form_name: str, *urls: str) -> DataFrame:
    """The payloads at some URLs of one form. Days prune folders, form and URLs row groups."""
    dated = [re.search(DATED, url) for url in urls]
    days = sorted({(m[1], int(m[2])) for m in dated if m})
    if not days:
        return archive.where(F.lit(False))
    here = F.col("form") == table_name(F.lit(form_name))
    when = [(F.col("month") == month) & (F.col("day") == day) for month, day in days]
    some = when[0]
    for one in when[1:]:
        some = some | one
    return archive.where(here & some & F.col("file_url").isin(*urls))
