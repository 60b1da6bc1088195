"""Text and time helpers used by the form jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST_NAME = 120  # of a form name that is used whole in a folder name
# Characters removed from, or replaced in, a flattened key to make a column name.
REPLACED_BY_UNDERSCORE = ".-"
REMOVED_FROM_NAMES = '[]{}" '

# Fixed value: characters at or below the space character count as white space when trimming.
_WHITE_SPACE = "".join(chr(i) for i in range(0x21))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci_equals(a: Column | str, b: Column | str) -> Column:
    return F.lower(_col(a)) == F.lower(_col(b))


def is_blank(c: Column | str) -> Column:
    """NULL or the empty string."""
    c = _col(c)
    return c.isNull() | (c == "")


def trim_cell(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(_WHITE_SPACE))


def prefix_list(text: str) -> list[str]:
    """Split on commas; trailing empty entries vanish, inner ones stay (an empty prefix matches all)."""
    parts = text.split(",")
    if parts == [""]:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def has_prefix(key: Column, prefixes: list[str]) -> Column:
    """Does `key` start with one of `prefixes`, ignoring case?"""
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.startswith(F.lower(key), F.lit(prefix.lower()))
    return hit


def column_name(key: Column | str) -> Column:
    """Column name for a flattened key."""
    kept = "_" * len(REPLACED_BY_UNDERSCORE)
    return F.translate(_col(key), REPLACED_BY_UNDERSCORE + REMOVED_FROM_NAMES, kept)


def table_name(form: Column | str) -> Column:
    """Spark-safe table name of a form, also as a folder name; names that had to change get a hash suffix, so none
    collide. Of a long name the beginning stands, with the whole hash."""
    form = _col(form)
    safe = F.regexp_replace(F.lower(form), "[^a-z0-9_]", "_")
    digest = F.md5(F.encode(form, "UTF-8"))
    fits = F.length(form) <= LONGEST_NAME
    unchanged = (safe == form) & ~F.startswith(form, F.lit("_")) & fits
    return F.when(unchanged, form).when(fits, F.concat(F.lit("form_"), safe, F.lit("_"), F.substring(digest, 1, 8))) \
        .otherwise(F.concat(F.lit("form_"), F.substring(safe, 1, LONGEST_NAME), F.lit("_"), digest))


def archive_folder(time: Column | str) -> Column:
    return F.concat(F.date_format(_col(time), "yyyy-MM/d"), F.lit("/"))


def archive_file(form: Column | str, time: Column | str, message_id: Column | str) -> Column:
    """Object name; its suffix is a hash of the message id, so a replay writes the same name."""
    digest = F.md5(F.encode(_col(message_id), "UTF-8"))
    suffix = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(9999)
    return F.concat(_col(form), F.date_format(_col(time), "H_m_s"), F.lit("_"), suffix.cast("string"))


def archive_url(base: str, bucket: str, form: Column | str, time: Column | str,
                message_id: Column | str) -> Column:
    return F.concat(F.lit(f"{base}{bucket}/"), _col(form), F.lit("/"), archive_folder(time),
                    archive_file(form, time, message_id), F.lit(".json"))


def utf8_bytes(c: Column | str) -> Column:
    return F.encode(_col(c), "UTF-8")


def utf8_text(c: Column | str) -> Column:
    """Bytes to text; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(_col(c).cast("string"))


def base64_text(c: Column | str) -> Column:
    """Base64 on one line (Spark's own encoder wraps long output)."""
    return F.replace(F.base64(_col(c)), F.lit("\r\n"), F.lit(""))


def key_resource(project: Column, location: Column, ring: Column, key: Column) -> Column:
    return F.concat(F.lit("projects/"), project, F.lit("/locations/"), location,
                    F.lit("/keyRings/"), ring, F.lit("/cryptoKeys/"), key)
