"""Inputs derived from the given tables. Each text is one SELECT that Spark and DuckDB both run as it is.

Every row of the table it reads becomes a row here, so the inputs grow with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.functions.crypto import EnvelopeCipher
from formweave.functions.text import utf8_bytes
from formweave.schemas import MESSAGE
from formweave.session import spread

# Events as form messages: malformed JSON, empty forms, empty headers, awkward names, nested values, JSON
# null, and a field that appears only from 15 January on.
MESSAGES = """
SELECT cast(event_id AS string) AS message_id, ts AS publish_time,
  CASE WHEN event_id % 89 = 3 THEN '{"formData":{"user_id":'
  ELSE concat('{"formData":',
    CASE WHEN event_id % 83 = 7 THEN '{}' ELSE concat(
      '{"user_id":', cast(user_id AS string),
      ',"_sysTrace":"t', cast(event_id AS string), '"',
      ',"full name":"User ', cast(user_id AS string), '"',
      ',"home.city":"c', cast(user_id % 7 AS string), '"',
      ',"props":', props,
      CASE WHEN event_type = 'purchase'
           THEN concat(',"unit-price":', cast(cast(round(value * 100) AS bigint) AS string)) ELSE '' END,
      CASE WHEN event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15 00:00:00'
           THEN ',"coupon":null' ELSE '' END,
      CASE WHEN event_type = 'signup' THEN concat(',"tags":["a",', cast(user_id % 3 AS string), ']') ELSE '' END,
      '}') END,
    ',"formMetaData":{"organization":"', CASE WHEN event_id % 97 = 5 THEN '' ELSE 'org1' END,
    '","team":"team', cast(user_id % 5 AS string),
    '","version":"v', cast(event_id % 2 + 1 AS string),
    '","formName":"', event_type, '"}}') END AS body
FROM events"""

# Events as messages whose form uses the reserved name, and whose metadata lacks, nulls or nests members.
RESERVED = """
SELECT cast(event_id AS string) AS message_id, ts AS publish_time,
  concat('{"formData":{"FORMMETADATA":1,"formMetaData":"mine","formmetadata":{"x":1},"user_id":',
    cast(user_id AS string), '},"formMetaData":{"formName":"', event_type, '"',
    CASE WHEN event_id % 5 = 1 THEN '' WHEN event_id % 5 = 2 THEN ',"organization":null'
         ELSE ',"organization":"org1"' END,
    ',"team":"team1","version":"v1"',
    CASE WHEN event_id % 5 = 3 THEN concat(',"geo":{"k.z":[', cast(event_id AS string), ',{}]}') ELSE '' END,
    '}}') AS body
FROM events"""

# Orders as forms whose numbers must stay as they are written, alone and nested, beside text that looks like a mark.
NUMBER_FORM = """concat('{"long":', repeat('9', 33), lpad(cast(o_orderkey % 100000000 AS string), 8, '1'),
    ',"cents":', cast(o_custkey AS string), '.50,"tiny":0.', repeat('0', 40), cast(o_orderkey AS string),
    ',"huge":1e', cast(400 + o_orderkey % 7 AS string), ',"minus":-0,"deep":{"x":[1.0,', cast(o_custkey AS string), '.00]}',
    CASE WHEN o_orderkey % 3 = 0 THEN concat(',"text":"', chr(92), 'u0001 7.0 and -0"') ELSE '' END, '}')"""
NUMBERS = f"""
SELECT cast(o_orderkey AS string) AS message_id, TIMESTAMP '2024-01-15 00:00:00' AS publish_time,
  concat('{{"formData":', {NUMBER_FORM},
    ',"formMetaData":{{"organization":"org1","team":"t","version":"v1","formName":"order"}}}}') AS body
FROM orders"""
NUMBER_REQUESTS = f"""
SELECT cast(o_orderkey AS string) AS message_id, 'org1' AS organization, 't' AS team, 'order' AS formName, 'v1' AS version,
  {NUMBER_FORM} AS body
FROM orders"""

# Customers as form requests: malformed and empty bodies, fields to drop in two spellings.
REQUESTS = """
SELECT cast(c_custkey AS string) AS message_id, 'org1' AS organization, c_mktsegment AS team,
  'customer' AS formName, 'v1' AS version,
  CASE WHEN c_custkey % 61 = 3 THEN '{"c_name":'
       WHEN c_custkey % 53 = 1 THEN '{}'
       ELSE concat('{"_SYSenv":"x","_sysTrace":"t', cast(c_custkey AS string), '","c_custkey":',
                   cast(c_custkey AS string), ',"c_name":"', c_name, '","home":{"nation":',
                   cast(c_nationkey AS string), '}}') END AS body
FROM customer"""

# Customers as de-identification rules. Three in seven name the same form; no rule names the form "view".
RULES = """
SELECT CASE c_custkey % 7 WHEN 0 THEN 'purchase' WHEN 1 THEN 'PURCHASE' WHEN 2 THEN 'signup' WHEN 3 THEN 'Click'
       WHEN 4 THEN 'error' WHEN 5 THEN 'purchase' END AS formName,
  CASE c_nationkey % 6 WHEN 0 THEN 'full name' WHEN 1 THEN 'user_id' WHEN 2 THEN 'home.city' WHEN 3 THEN 'props'
       WHEN 4 THEN 'Full Name' ELSE 'tags' END AS fieldName,
  CASE (c_nationkey % 6 + c_custkey % 2) % 5 WHEN 0 THEN 'CRYPTOHASHING' WHEN 1 THEN 'redaction'
       WHEN 2 THEN 'MASKING' WHEN 3 THEN 'Masking' ELSE 'hashing' END AS dlpTechnique,
  CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'DELETED' WHEN 2 THEN 'Deleted' WHEN 3 THEN 'keep'
       ELSE '' END AS addnl_info
FROM customer"""

# Orders as the lines of a rule CSV, in order. A third of them name one field of one form.
RULE_CELLS = """
SELECT o_orderkey AS line_no,
  CASE WHEN o_orderkey % 31 = 4 THEN '' WHEN o_orderkey % 3 = 0 THEN 'purchase'
       ELSE concat('form', cast(o_custkey % 40 AS string)) END AS c1,
  CASE WHEN o_orderkey % 3 = 0 THEN 'full name'
       ELSE CASE o_custkey % 4 WHEN 0 THEN ' user_id ' WHEN 1 THEN 'a,b' WHEN 2 THEN 'props' ELSE 'x' END END AS c2,
  CASE (o_orderkey * 7 + o_custkey) % 5 WHEN 0 THEN 'MASKING' WHEN 1 THEN 'MASKING ' WHEN 2 THEN 'REDACTION'
       ELSE 'CRYPTOHASHING' END AS c3,
  CASE (o_orderkey * 13 + o_custkey) % 7 WHEN 0 THEN ' deleted' WHEN 1 THEN 'Deleted' WHEN 2 THEN 'note'
       ELSE '' END AS c4,
  o_orderkey % 29 = 5 AS is_short
FROM orders"""

def _json_text(column: str) -> str:
    """A text column as a JSON string, without its quotes."""
    for code, letter in ((92, chr(92)), (34, '"'), (10, "n"), (13, "r"), (9, "t")):
        shown = "chr(92)" if code == 92 else f"'{letter}'"
        column = f"replace({column}, chr({code}), concat(chr(92), {shown}))"
    return column


# Conversations as nested documents of different depth, with brackets and quotes inside strings, and their whole texts.
DEEP = f"""
SELECT concat(cast(conv_id AS string), '-', cast(turn AS string)) AS id,
  concat('{{"a":{{"b":', cast(conv_id AS string), ',"x":[', cast(turn AS string), ',{{"y":[["', role,
    '"],"]}}"]}}]}},"d":null,"k.z":"q[{{', chr(92), '"","emp":{{}},"ea":[],"n":{{"text":["', {_json_text("coalesce(text, '')")}, '"]}}',
    CASE WHEN turn % 3 = 1 THEN ',"deep":[[[[[[[[[[[[[[[7]]]]]]]]]]]]]]]' ELSE '' END, '}}') AS doc
FROM conversations"""

# Documents as messages of forms that are named by the document's whole text.
HOSTILE = f"""
SELECT cast(doc_id AS string) AS message_id, TIMESTAMP '2024-01-15 00:00:00' AS publish_time,
  concat('{{"formData":{{"n":1}},"formMetaData":{{"organization":"org1","team":"t","version":"v1","formName":"',
    {_json_text("text")}, '"}}}}') AS body
FROM documents"""

# Documents as forms named after their source; the rule table names the text field of every source.
DOCUMENT_RULES = """
SELECT DISTINCT upper(source) AS formName, 'text' AS fieldName, 'masking' AS dlpTechnique, '' AS addnl_info
FROM documents"""

KEK_ID = "projects/local-project/locations/global/keyRings/forms/cryptoKeys/forms-key"
# A key for tests only.
KEY_MAP = {KEK_ID: bytes(range(32))}
PREFIXES = "_sys"
BASE_URL = "https://storage.example.com/"
BUCKET = "forms"


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A fixture in Spark: its one table is read from `sf_dir`. Times are UTC, as in the SQL twins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(re.sub(r"FROM (\w+)$", rf"FROM parquet.`{sf_dir}/\1.parquet`", sql.strip()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cipher(spark: SparkSession, data_keys: int = 64) -> EnvelopeCipher:
    return EnvelopeCipher(spark, KEY_MAP, KEK_ID, data_keys)


def bodies(spark: SparkSession, sf_dir: str, sql: str = MESSAGES, parts: int | None = None) -> DataFrame:
    """Messages in the clear: message_id, publish_time, body. With `parts`, in so many partitions in order of time."""
    rows = run(spark, sf_dir, sql)
    rows = rows.repartitionByRange(parts, "publish_time") if parts else spread(rows)
    return rows.withColumn("publish_time", F.col("publish_time").cast("timestamp"))


def sealed(spark: SparkSession, sf_dir: str, with_cipher: EnvelopeCipher, sql: str = MESSAGES,
           parts: int | None = None) -> DataFrame:
    """Messages as a topic delivers them; they are put in order before they are sealed, as sealed ones take more room."""
    keyed = with_cipher.with_data_key(bodies(spark, sf_dir, sql, parts), "message_id")
    attributes = F.create_map(F.lit("origin"), F.concat(F.lit("m"), F.substring("message_id", -1, 1)))
    return keyed.select("message_id", "publish_time", attributes.alias("attributes"),
                        with_cipher.seal(utf8_bytes("body")).alias("payload")).select(*MESSAGE.names)


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RULES)


def write_rule_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The rule CSV as a folder of files in line order, one header line each."""
    quoted = F.concat(F.lit('"'), F.col("c2"), F.lit('"'))
    line = F.when(F.col("is_short"), F.concat_ws(",", "c1", quoted)).otherwise(
        F.concat_ws(",", "c1", quoted, "c3", "c4"))
    (run(spark, sf_dir, RULE_CELLS).orderBy("line_no")
     .select(line.alias("formName,fieldName,dlpTechnique,addnl_info"))
     .write.option("header", "true").option("sep", "\u0001").option("quote", "\u0002")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
