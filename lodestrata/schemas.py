"""The data model as Spark DDL: entities, edges, evidence, crawl state, review, export runs, messages and events."""

from __future__ import annotations

EVIDENCED = "struct<value:string,evidence:string,confidence:double>"
KEY_PERSON = f"struct<name:{EVIDENCED},role:{EVIDENCED}>"
SOURCE_INFO = "struct<source_url:string,source_name:string,content_hash:string,raw_s3_key:string,fetch_tier:int,fetched_at:timestamp>"

FIELDS = "record_id string, record_type string, field_name string, idx int, value string, evidence string, confidence double"
ENTITIES = (
    f"canonical_id string, record_type string, entity_name string, normalized_name string, content map<string,array<{EVIDENCED}>>, resolution_method string, resolution_confidence double, source_count int, is_seed boolean, "
    "verification_status string, grounding_ratio double, schema_valid boolean, source_url string, content_hash string, raw_s3_key string, created_at timestamp, updated_at timestamp, exported_at timestamp, embedding array<float>"
)
EDGES = "source_id string, target_id string, relation_type string, confidence double, source_url string, source_content_hash string, evidence_text string, collected_at timestamp"
EVIDENCE = (
    "entity_id string, field_name string, extracted_value string, evidence_text string, source_url string, source_content_hash string, raw_s3_key string, verification_status string, fuzzy_score double, correlation_id string, verified_at timestamp"
)
CRAWL_ITEMS = (
    "url string, source_name string, record_type string, processing_state string, content_hash string, raw_s3_key string, fetch_tier int, status_code int, attempt_count int, last_error string, correlation_id string, canonical_id string, "
    "discovered_at timestamp, fetched_at timestamp, extracted_at timestamp, resolved_at timestamp, exported_at timestamp"
)
REVIEW_ITEMS = (
    "id bigint, extracted_name string, candidate_canonical_id string, candidate_name string, record_type string, similarity_score double, resolution_method string, evidence_summary string, source_url string, status string, reviewer string, "
    "decision string, created_at timestamp, resolved_at timestamp"
)
EXPORT_RUNS = "run_id string, started_at timestamp, completed_at timestamp, status string, records_exported int, records_skipped int, records_failed int, error_message string"
MESSAGE = "message_id string, correlation_id string, timestamp_at timestamp, attempt int, max_attempts int, source_worker string"
CRAWL_MESSAGE = f"{MESSAGE}, url string, source_name string, record_type string, listing_page int, fetch_tier int, priority int"
EXTRACTION_MESSAGE = f"{MESSAGE}, url string, source_name string, record_type string, content_hash string, raw_s3_key string, content_length bigint"
RESOLUTION_MESSAGE = f"{MESSAGE}, entity_id string, record_type string, entity_data string, relationship_candidates string"
DEAD_LETTER = f"{MESSAGE}, original_stream string, stage string, error_type string, error_message string, original_data string"
EVENT = "event_id string, event_type string, occurred_at timestamp, correlation_id string, payload map<string,string>"
