"""Row schemas."""

from pyspark.sql import types as T

OUTPUT = "struct<category:string,priority:string,sentiment:string,response:string,next_action:string>"
MESSAGES = "array<struct<role:string,content:string>>"
PROVENANCE = (
    "struct<source:string,created_by:string,license:string,contains_real_customer_data:boolean>"
)
SOURCE = (
    f"id string, messages {MESSAGES}, expected {OUTPUT}, provenance {PROVENANCE}, "
    "pii_placeholders array<string>"
)
PREPARED = (
    f"id string, prompt {MESSAGES}, completion {MESSAGES}, expected {OUTPUT}, "
    f"provenance {PROVENANCE}, pii_placeholders array<string>"
)
PREDICTION = f"id string, expected {OUTPUT}, prediction string, latency_ms double"
GENERATED = (
    f"{PREDICTION}, prompt_tokens int, generated_tokens int, model_name_or_path string, "
    "model_revision string, dataset_manifest_sha256 string, dataset_split_sha256 string, "
    "generation_config_sha256 string, training_manifest_sha256 string, "
    "training_config_sha256 string, training_dataset_sha256 map<string,string>, "
    "qualification_sha256 map<string,string>, adapter_path string, adapter_config_sha256 string, "
    "adapter_weight_sha256 map<string,string>, merged_model_path string, "
    "merge_provenance_sha256 string, merged_artifact_sha256 map<string,string>, "
    "merged_adapter_config_sha256 string, merged_adapter_weight_files array<string>, "
    "merged_adapter_weight_sha256 array<string>"
)
DATASET_MANIFEST = (
    "schema_version string, source_file string, source_sha256 string, seed long, "
    "split_fractions map<string,double>, total_examples long, "
    "labels map<string,map<string,long>>, "
    "splits map<string,struct<file:string,count:long,sha256:string,"
    "labels:map<string,map<string,long>>>>, split_ids map<string,array<string>>"
)
REVIEWER_PACKET = (
    "schema_version string, reviewer_id string, reviewer_kind string, status string, "
    "source_sha256 string, prepared_manifest_sha256 string, holdout_freeze_sha256 string, "
    "review_date date, decisions array<struct<record_id:string,labels:string,response:string,"
    "pii:string,license:string>>"
)
HOLDOUT_FREEZE = (
    "schema_version string, source_sha256 string, prepared_manifest_sha256 string, "
    "held_out_ids array<string>"
)
REVIEW_MANIFEST_11 = (
    "schema_version string, source_sha256 string, record_count long, "
    "independent_reviewer_count long, reviewed_count long, held_out_count long, "
    "held_out_ids array<string>, review_date date, intended_domain string, "
    "consent_or_license_statement string, pii_decision string, "
    "isolated_test_set_statement string, approval_status string"
)
REVIEW_MANIFEST_12 = (
    "schema_version string, source_sha256 string, record_count long, review_date date, "
    "intended_domain string, consent_or_license_statement string, pii_decision string, "
    "isolated_test_set_statement string, prepared_manifest struct<path:string,sha256:string>, "
    "holdout_freeze struct<path:string,sha256:string>, "
    "reviewer_packets array<struct<path:string,sha256:string>>, approval_status string"
)
OUTCOME = "status int, latency_ms double, schema_valid boolean, request_id boolean, error_code string"
SAMPLE = "ts timestamp, series string, value double"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
