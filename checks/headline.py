"""Queries that `bench.py` times: one per kind of work, and the whole jobs."""

HEADLINE = [
    "publish_messages", "src_messages", "stage_messages", "route_good_bad", "flatten_live", "flatten_deep",
    "pivot_form_columns", "batch_columns", "join_rules", "deid_cryptohash", "deid_chain", "deid_documents",
    "rules_by_form",
    "rules_upsert", "apply_declared_schema", "normalise_names", "envelope_encrypt", "envelope_decrypt",
    "archive_objects", "form_table_append", "dead_letter", "stream_ingest",
]
