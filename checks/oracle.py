"""DuckDB twins of the registered queries, over the same tables.

They start from the same input texts (`checks.fixtures`) and say the rest in plain SQL on JSON text.
"""

from __future__ import annotations

import hmac

from checks import fixtures as fx
from formweave.functions.crypto import PSEUDONYMS

EMPTY_HEADER = "Empty or Null value for header: "

# Messages: j is the JSON (NULL if malformed), the headers, and why a message is rejected.
_READ = f"""m AS ({fx.MESSAGES}),
d AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS j FROM m),
h AS (SELECT *, json_extract_string(j, '$.formMetaData.formName') AS formName,
  json_extract_string(j, '$.formMetaData.organization') AS organization,
  json_extract_string(j, '$.formMetaData.team') AS team,
  json_extract_string(j, '$.formMetaData.version') AS version FROM d),
r AS (SELECT *, CASE WHEN j IS NULL THEN 'PARSE: payload is not a JSON object'
  WHEN organization = '' THEN '{EMPTY_HEADER}organization' WHEN team = '' THEN '{EMPTY_HEADER}team'
  WHEN formName = '' THEN '{EMPTY_HEADER}formName' WHEN version = '' THEN '{EMPTY_HEADER}version'
  WHEN cast(json_extract(j, '$.formData') AS VARCHAR) = '{{}}' THEN 'FormData is empty' END AS error FROM h)"""

# One row per form member of the accepted messages.
_FIELDS = f"""{_READ},
k AS (SELECT message_id, publish_time, formName, j, unnest(json_keys(j, '$.formData')) AS key FROM r WHERE error IS NULL),
f AS (SELECT message_id, publish_time, formName, key,
  coalesce(json_extract_string(j, '$.formData."' || key || '"'), 'null') AS value FROM k)"""

# One row per column of the accepted messages, metadata included.
_COLUMNS = f"""{_FIELDS},
c AS (SELECT message_id, publish_time, formName, replace(replace(replace(key, ' ', ''), '.', '_'), '-', '_') AS key, value FROM f
  UNION ALL SELECT message_id, publish_time, formName, 'formMetaData_formName', formName FROM r WHERE error IS NULL
  UNION ALL SELECT message_id, publish_time, formName, 'formMetaData_organization', organization FROM r WHERE error IS NULL
  UNION ALL SELECT message_id, publish_time, formName, 'formMetaData_team', team FROM r WHERE error IS NULL
  UNION ALL SELECT message_id, publish_time, formName, 'formMetaData_version', version FROM r WHERE error IS NULL)"""

_URL = f"""'{fx.BASE_URL}{fx.BUCKET}/' || formName || '/' || strftime(publish_time, '%Y-%m/%-d') || '/' || formName
  || strftime(publish_time, '%-H_%-M_%-S') || '_' ||
  cast(cast('0x' || substr(md5(message_id), 1, 8) AS bigint) % 9999 AS VARCHAR) || '.json'"""

_ACTIVE = """formName IS NOT NULL AND fieldName IS NOT NULL AND dlpTechnique IS NOT NULL
  AND addnl_info IS NOT NULL AND upper(addnl_info) <> 'DELETED'"""

# Reader's rules, one row per (form, field, technique).
_RULES = f"""rl AS ({fx.RULES}),
ar AS (SELECT DISTINCT lower(formName) AS form_key, fieldName AS field, upper(dlpTechnique) AS technique
  FROM rl WHERE {_ACTIVE} AND upper(dlpTechnique) IN ('CRYPTOHASHING', 'REDACTION', 'MASKING'))"""

_LISTS = f"""{_RULES},
ls AS (SELECT form_key,
  coalesce(string_agg(field, '|' ORDER BY field) FILTER (technique = 'CRYPTOHASHING'), '') AS cryptohashing_fields,
  coalesce(string_agg(field, '|' ORDER BY field) FILTER (technique = 'REDACTION'), '') AS redaction_fields,
  coalesce(string_agg(field, '|' ORDER BY field) FILTER (technique = 'MASKING'), '') AS masking_fields
  FROM (SELECT form_key, field, technique FROM ar
        UNION ALL SELECT DISTINCT lower(formName), NULL, NULL FROM rl WHERE {_ACTIVE}) GROUP BY form_key)"""

# The rule CSV's lines, and the valid ones as changes.
_CELLS = f"""cells AS ({fx.RULE_CELLS}),
valid AS (SELECT line_no, trim(c1) AS formName, trim(c2) AS fieldName, trim(c3) AS dlpTechnique, c4,
    c1 AS raw1, c2 AS raw2, c3 AS raw3,
    CASE WHEN lower(trim(c4)) = 'deleted' THEN 'D' ELSE 'U' END AS action
  FROM cells WHERE NOT is_short AND c1 <> '' AND c2 <> '' AND c3 <> '')"""

_RECORDS = f"""q AS ({fx.REQUESTS}),
rec AS (SELECT *, CASE WHEN NOT json_valid(body) THEN NULL WHEN body = '{{}}' THEN '{{}}'
  ELSE '{{"formData":' || body || ',"formMetaData":{{"organization":"' || organization || '","team":"' || team
    || '","version":"' || version || '","formName":"' || formName || '"}}}}' END AS record FROM q),
dropped AS (SELECT message_id, record, regexp_replace(record, '"_SYSenv":"x","_sysTrace":"t[0-9]+",', '') AS kept FROM rec)"""

_RESERVED = f"""m AS ({fx.RESERVED}),
h AS (SELECT message_id, body, json_extract_string(body, '$.formMetaData.formName') AS formName,
  CASE WHEN json_extract(body, '$.formMetaData.organization') IS NOT NULL
       THEN coalesce(json_extract_string(body, '$.formMetaData.organization'), 'null') END AS organization,
  json_extract_string(body, '$.formMetaData.team') AS team,
  json_extract_string(body, '$.formMetaData.version') AS version FROM m)"""

# Opened rows of all form tables.
_ROWS = f"""WITH {_COLUMNS}, t AS (SELECT message_id, formName AS "table", string_agg(key, '|' ORDER BY key) AS names,
  md5(string_agg(key || '=' || value, chr(10) ORDER BY key)) AS row_md5 FROM c GROUP BY message_id, formName)"""
_TABLES = _ROWS + ' SELECT "table", names, row_md5 FROM t'

_FIRST = f"""{_COLUMNS},
found AS (SELECT DISTINCT formName, key AS "column" FROM c),
known AS (SELECT DISTINCT formName, key AS "column" FROM c
  WHERE publish_time < TIMESTAMP '2024-01-15 00:00:00' AND formName <> 'signup'),
added AS (SELECT * FROM found EXCEPT SELECT * FROM known)"""


def _by_technique(name: str) -> str:
    return f"""WITH {_FIELDS}, {_RULES} SELECT message_id, key AS field, value FROM f
JOIN ar ON lower(f.formName) = ar.form_key AND f.key = ar.field WHERE technique = '{name}'"""


_DEEP = f"""WITH m AS ({fx.DEEP})
SELECT id, 'a.b' AS key, json_extract_string(doc, '$.a.b') AS value FROM m
UNION ALL SELECT id, 'a.x[0]', json_extract_string(doc, '$.a.x[0]') FROM m
UNION ALL SELECT id, 'a.x[1].y[0][0]', json_extract_string(doc, '$.a.x[1].y[0][0]') FROM m
UNION ALL SELECT id, 'a.x[1].y[1]', json_extract_string(doc, '$.a.x[1].y[1]') FROM m
UNION ALL SELECT id, 'n.text[0]', json_extract_string(doc, '$.n.text[0]') FROM m
UNION ALL SELECT id, 'd', 'null' FROM m
UNION ALL SELECT id, '["k.z"]', json_extract_string(doc, '$."k.z"') FROM m
UNION ALL SELECT id, 'emp', '{{}}' FROM m
UNION ALL SELECT id, 'ea', '[]' FROM m
UNION ALL SELECT id, 'deep' || repeat('[0]', 15), '7' FROM m WHERE json_extract(doc, '$.deep') IS NOT NULL"""

# A keyed hash (HMAC with SHA-256) of column `value`, from the padded keys.
_KEY = hmac.digest(fx.KEY_MAP[fx.KEK_ID], PSEUDONYMS, "sha256").ljust(64, b"\0")
_INNER, _OUTER = (bytes(k ^ pad for k in _KEY).hex() for pad in (0x36, 0x5C))
_HMAC = f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode(value))))"


ORACLE: dict[str, str] = {
    # sources
    "src_messages": f"""WITH m AS ({fx.MESSAGES}) SELECT message_id, epoch_us(publish_time) AS publish_us,
'm' || right(message_id, 1) AS origin, body FROM m""",
    "src_rules_csv": f"""WITH {_CELLS}
SELECT CASE WHEN NOT is_short THEN c1 END AS formName, CASE WHEN NOT is_short THEN c2 END AS fieldName,
  CASE WHEN NOT is_short THEN c3 END AS dlpTechnique, CASE WHEN NOT is_short THEN c4 END AS addnl_info,
  CASE WHEN is_short THEN c1 || ',"' || c2 || '"' END AS bad_line FROM cells""",
    "src_rules": fx.RULES,
    "rules_before_change": fx.RULES,
    "src_form_schema": f"""WITH {_COLUMNS} SELECT formName, formName AS "table", key AS "column",
cast(CASE WHEN min(publish_time) < TIMESTAMP '2024-01-15 00:00:00' THEN 0 ELSE 1 END AS bigint) AS since
FROM c GROUP BY formName, key""",
    "build_form_records": f"WITH {_RECORDS} SELECT message_id, record FROM rec",
    # sinks
    "publish_messages": f"WITH {_RECORDS} SELECT message_id, kept AS body FROM dropped WHERE record IS NOT NULL",
    "topic_replay": f"""WITH {_RECORDS} SELECT message_id, kept AS body, 1::BIGINT AS deliveries, 1::BIGINT AS places
FROM dropped WHERE record IS NOT NULL""",
    "publish_retry": f"""WITH {_RECORDS} SELECT message_id, kept AS body, 4::INTEGER AS tries, 0.7::DOUBLE AS waited
FROM dropped WHERE record IS NOT NULL""",
    "publish_rejects": f"""WITH {_RECORDS} SELECT message_id, 'PARSE: body is not a JSON object' AS error
FROM rec WHERE record IS NULL""",
    "archive_paths": f"WITH {_READ} SELECT message_id, {_URL} AS file_url FROM r WHERE error IS NULL",
    "archive_objects": f"""WITH {_READ} SELECT message_id, formName, strftime(publish_time, '%Y-%m') AS month,
cast(day(publish_time) AS integer) AS day, {_URL} AS file_url, body FROM r WHERE error IS NULL""",
    "form_table_create": f"""WITH {_COLUMNS}, g AS (SELECT DISTINCT formName, key FROM c
  WHERE publish_time < TIMESTAMP '2024-01-15 00:00:00')
SELECT formName, formName AS "table", key AS "column",
cast(row_number() OVER (PARTITION BY formName ORDER BY key) - 1 AS integer) AS position FROM g""",
    "form_table_evolve": f"""WITH {_COLUMNS}, g AS (SELECT formName, key,
  min(publish_time) >= TIMESTAMP '2024-01-15 00:00:00' AS late FROM c GROUP BY formName, key)
SELECT formName AS "table", key AS "column",
cast(row_number() OVER (PARTITION BY formName ORDER BY late, key) - 1 AS integer) AS position FROM g""",
    "hostile_names": """SELECT cast(doc_id AS VARCHAR) AS message_id, md5(text) AS form_md5, true AS short_folder
FROM documents WHERE text <> ''""",
    "form_table_append": _TABLES,
    "backlog_then_stream": _TABLES,
    "stream_then_backlog": _TABLES,
    "replayed_batches": _TABLES,
    "compacted_tables": _TABLES,
    "repeated_deliveries": _TABLES,
    "committed_reads": _ROWS.replace("GROUP BY", "WHERE publish_time < TIMESTAMP '2024-01-15 00:00:00' GROUP BY")
    + ' SELECT "table", names, row_md5 FROM t',
    "table_counts": f"""WITH {_READ} SELECT formName AS "table",
count(DISTINCT publish_time >= TIMESTAMP '2024-01-15 00:00:00') AS batches, count(*) AS rows
FROM r WHERE error IS NULL GROUP BY formName""",
    "error_rows": f"""WITH {_READ} SELECT coalesce(formName, '') AS formName, '' AS errorFormData,
error AS description, true AS has_time FROM r WHERE error IS NOT NULL""",
    "error_table": f"""WITH {_READ} SELECT coalesce(formName, '') AS formName, '' AS errorFormData,
error AS description, count(*) AS n FROM r WHERE error IS NOT NULL GROUP BY ALL""",
    "archive_lookup": f"""WITH {_READ} SELECT message_id, {_URL} AS file_url, body FROM r
WHERE error IS NULL AND formName = 'purchase'""",
    "dead_letter": f"""WITH {_READ} SELECT message_id, '' AS errorFormData, body FROM r
  WHERE error IS NULL AND formName = 'purchase'
UNION ALL SELECT '', {_URL}, 'Exceeded rate limits: too many table update operations for this table' FROM r
  WHERE error IS NULL AND formName = 'purchase'""",
    # projections, filters and routing
    "drop_prefixed_fields": f"WITH {_RECORDS} SELECT message_id, kept AS record FROM dropped WHERE record IS NOT NULL",
    "publish_empty_guard": f"WITH {_RECORDS} SELECT message_id, record FROM rec WHERE body = '{{}}'",
    "extract_metadata": f"WITH {_RESERVED} SELECT message_id, formName, organization, team, version FROM h",
    "validate_headers": f"""WITH {_READ} SELECT message_id, CASE WHEN organization = '' THEN '{EMPTY_HEADER}organization'
WHEN team = '' THEN '{EMPTY_HEADER}team' WHEN formName = '' THEN '{EMPTY_HEADER}formName'
WHEN version = '' THEN '{EMPTY_HEADER}version' END AS problem FROM r WHERE j IS NOT NULL""",
    "validate_body": f"""WITH {_READ} SELECT message_id,
CASE WHEN json_array_length(to_json(json_keys(j, '$.formData'))) = 0 THEN 'FormData is empty' END AS problem
FROM r WHERE j IS NOT NULL""",
    "merge_metadata": f"""WITH {_RESERVED}, ok AS (SELECT * FROM h WHERE organization IS NOT NULL)
SELECT message_id, 'user_id' AS key, json_extract_string(body, '$.formData.user_id') AS value FROM ok
UNION ALL SELECT message_id, 'formMetaData_formName', formName FROM ok
UNION ALL SELECT message_id, 'formMetaData_organization', organization FROM ok
UNION ALL SELECT message_id, 'formMetaData_team', team FROM ok
UNION ALL SELECT message_id, 'formMetaData_version', version FROM ok
UNION ALL SELECT message_id, 'formMetaData_geok_z0', message_id FROM ok WHERE body LIKE '%"geo"%'
UNION ALL SELECT message_id, 'formMetaData_geok_z1', '{{}}' FROM ok WHERE body LIKE '%"geo"%'""",
    "drop_reserved": f"WITH {_RESERVED} SELECT message_id, 'user_id' AS names FROM h WHERE organization IS NOT NULL",
    "stringify_values": f"WITH {_FIELDS} SELECT message_id, key, value FROM f",
    "exact_numbers": """SELECT cast(o_orderkey AS VARCHAR) AS message_id, unnest(['long', 'cents', 'tiny', 'huge', 'minus', 'deep']) AS key,
  unnest([repeat('9', 33) || lpad(cast(o_orderkey % 100000000 AS VARCHAR), 8, '1'), o_custkey || '.50',
    '0.' || repeat('0', 40) || o_orderkey, '1e' || (400 + o_orderkey % 7), '-0', '{"x":[1.0,' || o_custkey || '.00]}']) AS value
FROM orders UNION ALL
SELECT cast(o_orderkey AS VARCHAR), 'text', chr(1) || ' 7.0 and -0' FROM orders WHERE o_orderkey % 3 = 0""",
    "exact_number_records": """SELECT cast(o_orderkey AS VARCHAR) AS message_id,
  repeat('9', 33) || lpad(cast(o_orderkey % 100000000 AS VARCHAR), 8, '1') AS long, o_custkey || '.50' AS cents,
  '0.' || repeat('0', 40) || o_orderkey AS tiny, '1e' || (400 + o_orderkey % 7) AS huge, '-0' AS minus,
  '{"x":[1.0,' || o_custkey || '.00' AS deep FROM orders""",
    "flatten_live": f"WITH {_COLUMNS} SELECT message_id, formName, key, value FROM c",
    "flatten_deep": _DEEP,
    "flatten_spread": _DEEP,
    "normalise_names": """SELECT doc_id, md5(replace(replace(regexp_replace(text, '[\\[\\]{}" ]', '', 'g'), '.', '_'), '-', '_'))
AS name_md5 FROM documents""",
    "pivot_form_columns": _ROWS + ' SELECT "table", message_id, names, row_md5 FROM t',
    "rules_csv_valid": f"""WITH {_CELLS} SELECT raw1 AS formName, raw2 AS fieldName, raw3 AS dlpTechnique, c4 AS addnl_info,
count(*) AS n FROM valid GROUP BY ALL""",
    "rules_csv_action": f"""WITH {_CELLS} SELECT formName, fieldName, dlpTechnique, action, count(*) AS n
FROM valid GROUP BY ALL""",
    "active_rules": f"""WITH rl AS ({fx.RULES}) SELECT formName, fieldName, dlpTechnique, addnl_info, count(*) AS n
FROM rl WHERE {_ACTIVE} GROUP BY ALL""",
    "rules_active_lookup": f"""WITH rl AS ({fx.RULES}) SELECT formName, fieldName,
count(*) FILTER (addnl_info IS NOT NULL AND addnl_info <> 'DELETED') AS active, count(*) AS rows
FROM rl GROUP BY formName, fieldName""",
    "rules_by_technique": f"""WITH rl AS ({fx.RULES}) SELECT formName,
count(*) FILTER (upper(dlpTechnique) = 'CRYPTOHASHING') AS cryptohashing,
count(*) FILTER (upper(dlpTechnique) = 'REDACTION') AS redaction,
count(*) FILTER (upper(dlpTechnique) = 'MASKING') AS masking FROM rl WHERE {_ACTIVE} GROUP BY formName""",
    "route_good_bad": f"WITH {_READ} SELECT formName, error, count(*) AS n FROM r GROUP BY formName, error",
    "stage_messages": f"""WITH {_COLUMNS},
n AS (SELECT message_id, string_agg(key, '|' ORDER BY key) AS names FROM c GROUP BY message_id)
SELECT message_id, CASE WHEN error IS NULL THEN formName ELSE '_rejected' END AS route, error,
  CASE WHEN error IS NULL THEN {_URL} END AS file_url, names FROM r LEFT JOIN n USING (message_id)""",
    "message_attributes": f"""WITH m AS ({fx.MESSAGES}) SELECT message_id, 'origin' AS key,
'm' || right(message_id, 1) AS value FROM m""",
    "apply_declared_schema": """SELECT o_orderkey AS key, o_totalprice AS price,
cast(cast(o_totalprice AS decimal(20,2)) AS double) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day,
strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS moment,
CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 2 THEN false END AS flag, o_orderpriority AS raw,
o_custkey AS cust, o_orderstatus AS status, o_custkey + 1 AS many_sum, cast(NULL AS VARCHAR) AS absent,
cast(0 AS integer) AS missing FROM orders""",
    # joins
    "join_rules": f"""WITH {_READ}, {_LISTS} SELECT message_id, coalesce(cryptohashing_fields, '') AS cryptohashing_fields,
coalesce(redaction_fields, '') AS redaction_fields, coalesce(masking_fields, '') AS masking_fields
FROM r LEFT JOIN ls ON lower(r.formName) = ls.form_key WHERE error IS NULL""",
    "fields_to_deidentify": f"""WITH {_FIELDS}, {_RULES} SELECT message_id, field, technique FROM f
JOIN ar ON lower(f.formName) = ar.form_key AND f.key = ar.field""",
    "new_columns": f'WITH {_FIRST} SELECT formName, "column" FROM added',
    "forms_to_create": f"""WITH {_FIRST} SELECT DISTINCT formName, formName AS "table" FROM found
WHERE formName NOT IN (SELECT formName FROM known)""",
    "schema_union": f"""WITH {_FIRST}, u AS (SELECT formName, "column", 0 AS late FROM known
  UNION ALL SELECT formName, "column", 1 FROM added)
SELECT formName AS "table", bool_or(late = 1) AS changed, string_agg("column", '|' ORDER BY late, "column") AS columns
FROM u GROUP BY formName""",
    # aggregations
    "rules_by_form": f"WITH {_LISTS} SELECT * FROM ls",
    "ingest_counts": f"""WITH {_COLUMNS}, n AS (SELECT message_id, count(*) AS fields FROM c GROUP BY message_id)
SELECT r.formName, count(*) AS messages, count(error) AS rejected, cast(coalesce(sum(fields), 0) AS bigint) AS fields
FROM r LEFT JOIN n ON r.message_id = n.message_id GROUP BY r.formName""",
    "batch_columns": f'WITH {_COLUMNS} SELECT DISTINCT formName, formName AS "table", key AS "column" FROM c',
    "rules_upsert": f"""WITH RECURSIVE {_CELLS}, base AS ({fx.RULES}),
u AS (SELECT * FROM valid WHERE action = 'U'), x AS (SELECT * FROM valid WHERE action = 'D'),
-- A key is blocked up to the line by which all rules that were active at the start are deleted.
block AS (SELECT b.formName, b.fieldName, max(coalesce(
    (SELECT min(x.line_no) FROM x WHERE x.formName = b.formName AND x.fieldName = b.fieldName
      AND x.dlpTechnique = b.dlpTechnique), 9e18::bigint)) AS until
  FROM (SELECT DISTINCT formName, fieldName, dlpTechnique FROM base
        WHERE addnl_info IS NOT NULL AND addnl_info <> 'DELETED') b GROUP BY b.formName, b.fieldName),
free AS (SELECT u.* FROM u LEFT JOIN block USING (formName, fieldName) WHERE line_no > coalesce(until, -1)),
ends AS (SELECT f.formName, f.fieldName, f.line_no, min(x.line_no) AS gone FROM free f JOIN x
  ON x.formName = f.formName AND x.fieldName = f.fieldName AND x.dlpTechnique = f.dlpTechnique AND x.line_no > f.line_no
  GROUP BY ALL),
hops AS (SELECT e.formName, e.fieldName, e.line_no, min(f.line_no) AS next FROM ends e JOIN free f
  ON f.formName = e.formName AND f.fieldName = e.fieldName AND f.line_no > e.gone GROUP BY ALL),
chain AS (SELECT formName, fieldName, min(line_no) AS line_no FROM free GROUP BY formName, fieldName
  UNION ALL SELECT c.formName, c.fieldName, h.next FROM chain c JOIN hops h
    ON h.formName = c.formName AND h.fieldName = c.fieldName AND h.line_no = c.line_no),
after AS (
  SELECT b.formName, b.fieldName, b.dlpTechnique, CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.formName = b.formName
    AND x.fieldName = b.fieldName AND x.dlpTechnique = b.dlpTechnique) THEN 'DELETED' ELSE b.addnl_info END AS addnl_info
  FROM base b
  UNION ALL
  SELECT f.formName, f.fieldName, f.dlpTechnique, CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.formName = f.formName
    AND x.fieldName = f.fieldName AND x.dlpTechnique = f.dlpTechnique AND x.line_no > f.line_no) THEN 'DELETED' ELSE '' END
  FROM free f JOIN chain c ON c.formName = f.formName AND c.fieldName = f.fieldName AND c.line_no = f.line_no)
SELECT formName, fieldName, dlpTechnique, addnl_info, count(*) AS n FROM after GROUP BY ALL""",
    # scalar functions
    "fn_json_parse": f"WITH m AS ({fx.MESSAGES}) SELECT message_id, json_valid(body) AS is_json FROM m",
    "fn_to_json": """SELECT c_custkey, cast(json_object('name', c_name, 'nation', c_nationkey, 'segment', c_mktsegment)
AS VARCHAR) AS json FROM customer""",
    "fn_json_size": f"""WITH {_READ}, k AS (SELECT message_id, json_keys(j, '$.formData') AS ks FROM r WHERE j IS NOT NULL)
SELECT message_id, cast(len(ks) AS integer) AS members, array_to_string(list_sort(ks), '|') AS names FROM k""",
    "fn_ci_equals": f"""WITH rl AS ({fx.RULES}) SELECT formName, lower(formName) = 'purchase' AS same, count(*) AS n
FROM rl GROUP BY formName""",
    "fn_base64": "SELECT doc_id, md5(base64(encode(text))) AS b64_md5 FROM documents",
    "fn_utf8": """SELECT doc_id, cast(octet_length(encode(text)) AS integer) AS bytes,
cast(length(text) AS integer) AS chars, md5(text) AS raw_md5 FROM documents""",
    "fn_key_name": """SELECT c_custkey, 'projects/p/locations/global/keyRings/' || c_mktsegment || '/cryptoKeys/' || c_name
AS key_name FROM customer""",
    "fn_table_name": """SELECT page_id, 'form_' || regexp_replace(lower(url), '[^a-z0-9_]', '_', 'g') || '_'
|| substr(md5(url), 1, 8) AS "table" FROM pages""",
    "envelope_encrypt": "SELECT doc_id, cast(4 + 60 + 12 + 16 AS integer) AS overhead, md5(text) AS text_md5 FROM documents",
    "keyring_messages": f"""WITH {_READ} SELECT message_id,
CASE WHEN error IS NULL AND opened THEN formName ELSE '_rejected' END AS route,
CASE WHEN opened THEN error ELSE 'DECRYPT: payload cannot be opened' END AS error
FROM (SELECT *, cast(message_id AS bigint) % 4 <> 3 AS opened FROM r)""",
    "envelope_decrypt": f"""WITH m AS ({fx.MESSAGES}) SELECT message_id,
CASE WHEN cast(message_id AS bigint) % 5 NOT IN (1, 2) THEN body END AS body FROM m""",
    # de-identification
    "deid_cryptohash": _by_technique("CRYPTOHASHING"),
    "deid_pseudonyms": _by_technique("CRYPTOHASHING").replace("key AS field, value", f"key AS field, {_HMAC} AS pseudonym"),
    "deid_redact": _by_technique("REDACTION"),
    "deid_mask": _by_technique("MASKING"),
    "deid_chain": f"""WITH {_FIELDS}, {_RULES} SELECT message_id, field, any_value(value) AS value,
cast(count(*) AS integer) AS times FROM f JOIN ar ON lower(f.formName) = ar.form_key AND f.key = ar.field
GROUP BY message_id, field""",
    "deid_none": f"WITH {_FIELDS} SELECT message_id, key, value FROM f WHERE formName = 'view'",
    "deid_invariants": f"""WITH {_FIELDS}, {_RULES}, p AS (SELECT DISTINCT form_key, field FROM ar)
SELECT message_id, string_agg(key, '|' ORDER BY key) AS names,
  coalesce(string_agg(key, '|' ORDER BY key) FILTER (field IS NULL), '') AS untouched
FROM f LEFT JOIN p ON lower(f.formName) = p.form_key AND f.key = p.field GROUP BY message_id""",
    "deid_documents": """SELECT cast(doc_id AS VARCHAR) AS message_id, source AS formName, lang, md5(text) AS text_md5,
false AS in_clear FROM documents""",
    # streaming
    "stream_ingest": _TABLES,
    "stream_schema_drift": f'WITH {_COLUMNS} SELECT DISTINCT formName, key AS "column" FROM c',
    "stream_counts": f"""WITH {_READ} SELECT count(*) AS messages, count(error) AS rejected FROM r""",
}
