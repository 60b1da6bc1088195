"""Stage 1: open a message, read its form and metadata, and say why it is rejected, if it is.

Every step adds columns to the same rows, so the stage is one scan with no shuffle. Rejection is a column
(`error`), never an exception inside a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions import jsonvals
from formweave.functions.crypto import KEY_NAME, EnvelopeCipher
from formweave.functions.text import is_blank, utf8_text

FORM_META = "formMetaData"
FORM_DATA = "formData"

# Metadata names in the order they are read, and in the order they are validated.
READ_ORDER = ("formName", "organization", "team", "version")
CHECK_ORDER = ("organization", "team", "formName", "version")

# Rejection texts.
BLANK_HEADER = "Empty or Null value for header: "
EMPTY_BODY = "FormData is empty"
NOT_OPENED = "DECRYPT: payload cannot be opened"
NOT_JSON = "PARSE: payload is not a JSON object"
NO_META = "METADATA: formMetaData is not an object"
NO_HEADER = "METADATA: missing "
NO_BODY = "BODY: formData is not an object"


def open_messages(messages: DataFrame, cipher: EnvelopeCipher) -> DataFrame:
    """Add `body`, the clear text of the payload, NULL when it cannot be opened. The key is the one the message names;
    a name the key map does not hold opens nothing."""
    return messages.withColumn("body", utf8_text(cipher.open("payload", key_name(messages))))


def key_name(messages: DataFrame) -> Column | None:
    """Name of the key a message was sealed under, if it may have one: kept in a column or among its attributes."""
    if "key_name" in messages.columns:
        return F.col("key_name")
    return F.col("attributes")[KEY_NAME] if "attributes" in messages.columns else None


def parse_bodies(messages: DataFrame) -> DataFrame:
    """Add `meta` and `form`, the members of the two parts as text, numbers as they were written, and `meta_doc`, the
    metadata as VARIANT, whose numbers carry the `mark`."""
    doc = messages.withColumn("mark", jsonvals.number_mark("body")).withColumn(
        "doc", jsonvals.parse(jsonvals.marked("body", "mark")))
    return doc.select(
        *[c for c in doc.columns if c != "doc"],
        F.col("doc").isNotNull().alias("is_json"),
        F.try_variant_get("doc", f"$.{FORM_META}", "variant").alias("meta_doc"),
        jsonvals.plain_texts(jsonvals.object_texts("doc", f"$.{FORM_META}"), "mark").alias("meta"),
        jsonvals.plain_texts(jsonvals.object_texts("doc", f"$.{FORM_DATA}"), "mark").alias("form"),
    )


def with_metadata(parsed: DataFrame) -> DataFrame:
    """Add formName, organization, team and version."""
    return parsed.withColumns({name: jsonvals.member_text(F.col("meta"), name) for name in READ_ORDER})


def header_error() -> Column:
    """The first blank header, in checking order, or NULL."""
    return F.coalesce(*[F.when(is_blank(name), F.lit(BLANK_HEADER + name)) for name in CHECK_ORDER])


def body_error() -> Column:
    return F.when(F.size("form") == 0, F.lit(EMPTY_BODY))


def message_error() -> Column:
    """Why the message is rejected, or NULL. The order is the order in which parts are read."""
    return F.coalesce(
        F.when(F.col("body").isNull(), F.lit(NOT_OPENED)),
        F.when(~F.col("is_json"), F.lit(NOT_JSON)),
        F.when(F.col("meta").isNull(), F.lit(NO_META)),
        *[F.when(F.col(name).isNull(), F.lit(NO_HEADER + name)) for name in READ_ORDER],
        header_error(),
        F.when(F.col("form").isNull(), F.lit(NO_BODY)),
        body_error(),
    )


def form_values() -> Column:
    """The form's members as text. The reserved key is dropped in any letter case; JSON null reads ``null``."""
    kept = F.map_filter("form", lambda name, _: F.lower(name) != FORM_META.lower())
    return jsonvals.null_as_text(kept)


def read_forms(messages: DataFrame) -> DataFrame:
    """Parse `body` and add `error` and, for accepted rows, `values`."""
    rows = with_metadata(parse_bodies(messages)).withColumn("error", message_error())
    return rows.withColumn("values", F.when(F.col("error").isNull(), form_values())).drop("form", "is_json")
