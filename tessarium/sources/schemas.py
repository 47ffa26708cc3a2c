"""Schemas of the entities: supersets with nullable columns, always given on read."""

from __future__ import annotations

SEGMENT = (
    "struct<segment_id:string,document_id:string,ordinal:int,text:string,char_start:int,char_end:int,page_start:int,"
    "page_end:int,timestamp_start:double,timestamp_end:double,language:string,attributes:map<string,string>>"
)
EVENT = (
    "struct<event_id:string,event_type:string,entity_id:string,agent:string,input_ids:array<string>,"
    "attributes:map<string,string>,timestamp:string>"
)
CANONICAL_DOCUMENT = (
    "document_id string, source_id string, source_url string, final_url string, artifact_sha256 string, byte_size long, "
    "content_type string, extraction_method string, extraction_warnings array<string>, "
    "metadata struct<title:string,language:string,published_at:string,summary:string,authors:string>, "
    f"text string, segments array<{SEGMENT}>, text_length int, retrieved_at string, http_status int, "
    f"provenance_events array<{EVENT}>, policy_topics array<string>"
)
CORPUS_RECORD = (
    "record_id string, text string, source_id string, document_id string, segment_id string, title string, url string, "
    "language string, stakeholder_groups array<string>, organizations array<string>, topics array<string>, "
    "document_type string, metadata map<string,string>"
)
CANDIDATE = (
    "candidate_id string, candidate_type string, segment_id string, text string, extraction_method string, "
    "human_verified boolean, confidence double, evidence_linked boolean, evidence_confidence double, evidence_required boolean"
)
PERSPECTIVE = (
    "question_id string, stakeholder_group string, position string, arguments array<string>, "
    "evidence_record_ids array<string>, confidence double, attribution string, is_official_position boolean"
)
EVIDENCE = (
    "struct<document_id:string,source_hash:string,source_url:string,quote_or_excerpt:string,explanation:string,relevance:string>"
)
SFT_EXAMPLE = (
    "schema_version string, task_type string, messages array<struct<role:string,content:string>>, "
    "source_document_ids array<string>, source_hashes array<string>, source_urls array<string>, "
    f"evidence array<{EVIDENCE}>, stakeholders_mentioned array<string>, policy_topics array<string>, language string, "
    "example_id string, split string, reasoning string, uncertainty string, analysis map<string,string>, limitations string"
)
