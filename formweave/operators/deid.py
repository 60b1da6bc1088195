"""Stage 2: look up the rules of each form and seal the named fields.

All three techniques seal the value; they differ only in which list names the field. A field named in
several lists is sealed once per list. For the first one, a keyed hash can be chosen instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions.crypto import DATA_KEY, HASH_KEY, EnvelopeCipher, Pseudonyms
from formweave.operators.rules import TECHNIQUES
from formweave.session import small_side

FIELD_LISTS = tuple(f"{t.lower()}_fields" for t in TECHNIQUES)
NOT_SEALED = "DEID: a field cannot be sealed"


def with_rules(forms: DataFrame, by_form: DataFrame, key_by: str = "message_id") -> DataFrame:
    """Add the field lists of each row's form, ignoring case; empty lists when it has none.

    The lists are measured, as they take much less than the rules they come from: they are broadcast if they are
    small, so that no message is shuffled to the few keys of its form. Else Spark sorts and merges, where adaptive
    execution splits a form that holds many rows.
    Rows without a form name find no rule; they get keys of their own, which no rule has, so that they spread.
    """
    named = F.concat(F.lit("f"), F.lower("formName"))
    keyed = forms.withColumn("_key", F.coalesce(named, F.concat(F.lit("n"), F.col(key_by).cast("string"))))
    lists = small_side(by_form.withColumn("form_key", F.concat(F.lit("f"), F.col("form_key"))), "field-lists")
    joined = keyed.join(lists, F.col("_key") == F.col("form_key"), "left").drop("form_key", "_key")
    empty = F.array().cast("array<string>")
    return joined.withColumns({name: F.coalesce(name, empty) for name in FIELD_LISTS})


def seal_fields(values: Column, fields: Column) -> Column:
    sealed = F.transform_values(values, lambda name, value: F.when(
        F.array_contains(fields, name), EnvelopeCipher.seal_text(value)).otherwise(value))
    return F.when(F.size(fields) == 0, values).otherwise(sealed)


def replace_fields(values: Column, fields: Column) -> Column:
    replaced = F.transform_values(values, lambda name, value: F.when(
        F.array_contains(fields, name), Pseudonyms.of(value)).otherwise(value))
    return F.when(F.size(fields) == 0, values).otherwise(replaced)


def deidentify(forms: DataFrame, by_form: DataFrame, cipher: EnvelopeCipher, on_error: str = "reject",
               key_by: str = "message_id", cryptohashing: str = "seal") -> DataFrame:
    """Seal the fields of `values` that the rules of the form name. Keys and all other values stay as they are. With
    ``cryptohashing="hmac"`` the fields of that list get a pseudonym instead, by which tables can be joined.

    A value that cannot be sealed rejects its row; ``on_error="pass"`` lets it through in the clear.
    """
    rows = cipher.with_data_key(with_rules(forms, by_form, key_by), key_by)
    rows = cipher.pseudonyms.with_hash_key(rows) if cryptohashing == "hmac" else rows
    rows = rows.withColumn("sealed", F.col("values"))
    for technique, fields in zip(TECHNIQUES, FIELD_LISTS):
        hashed = technique == "CRYPTOHASHING" and cryptohashing == "hmac"
        hide = replace_fields if hashed else seal_fields
        rows = rows.withColumn("sealed", hide(F.col("sealed"), F.col(fields)))
    if on_error == "pass":
        clear = F.map_zip_with("sealed", "values", lambda _, s, v: F.coalesce(s, v))
        rows = rows.withColumn("sealed", clear)
    else:
        failed = F.exists(F.map_values("sealed"), lambda v: v.isNull())
        rows = rows.withColumn("error", F.coalesce("error", F.when(failed, F.lit(NOT_SEALED))))
    return rows.withColumn("values", F.col("sealed")).drop("sealed", DATA_KEY, HASH_KEY, *FIELD_LISTS)
