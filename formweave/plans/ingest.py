"""Messages to staged rows: one narrow plan, plus the rule lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.functions.crypto import EnvelopeCipher
from formweave.functions.text import archive_url, table_name
from formweave.operators.deid import deidentify
from formweave.operators.flatten import with_columns_map
from formweave.operators.parse import key_name, open_messages, read_forms
from formweave.operators.rules import rules_by_form
from formweave.schemas import REJECTED_ROUTE, STAGED


def stage(messages: DataFrame, rules: DataFrame, cipher: EnvelopeCipher, base_url: str, bucket: str,
          on_deid_error: str = "reject", collision: str = "reject", cryptohashing: str = "seal") -> DataFrame:
    """Open, parse, validate, name the archive object, seal protected fields and name the columns.

    Every message comes out once. `file_url` is set once stage 1 accepted it, `error` says why it was
    rejected, `route` is the table its row goes to.
    """
    name = key_name(messages)
    messages = messages.withColumn("key_name", F.lit(None).cast("string") if name is None else name)
    forms = read_forms(open_messages(messages, cipher)).drop("body")
    url = archive_url(base_url, bucket, "formName", "publish_time", "message_id")
    forms = forms.withColumn("file_url", F.when(F.col("error").isNull(), url))
    sealed = deidentify(forms, rules_by_form(rules), cipher, on_deid_error, cryptohashing=cryptohashing)
    rows = with_columns_map(sealed, collision)
    route = F.when(F.col("error").isNull(), table_name("formName")).otherwise(F.lit(REJECTED_ROUTE))
    return rows.withColumns({
        "month": F.date_format("publish_time", "yyyy-MM"), "day": F.dayofmonth("publish_time"), "route": route,
    }).select(*STAGED.names)
