"""Fixed schemas of the paper table, its nested columns, extraction records and cached responses."""

from __future__ import annotations

AUTHORS = "array<struct<last_name:string,first_name:string,initials:string,affiliation:string,is_corresponding:boolean,equal_contribution:boolean>>"
JOURNAL = "struct<title:string,title_abbreviated:string,iso_abbreviation:string,nlm_id:string,issn:string,issn_type:string,issn_linking:string,volume:string,issue:string,pagination:string,cited_medium:string,country:string>"
PUB_TYPES = "array<struct<type:string,ui:string>>"
MESH = "array<struct<descriptor:string,descriptor_ui:string,descriptor_major:boolean,qualifiers:array<struct<name:string,ui:string,major:boolean>>>>"
KEYWORDS = "array<struct<keyword:string,major:boolean,owner:string>>"
GRANTS = "array<struct<id:string,agency:string,country:string,acronym:string>>"
ARTICLE_IDS = "array<struct<id:string,type:string>>"

RAW_COLUMNS = "pmid string, raw_xml string, fetch_date string, fetch_query string, fetch_batch string"
PARSED_COLUMNS = "title string, abstract string, authors string, journal string, year long, month long, doi string, pub_type string, mesh_terms string, keywords string, language string, grants string, publication_status string, article_ids string, is_retracted boolean, retraction_of_pmid string, is_preprint boolean"
EXTRACTIONS = "pmid string, schema_name string, run_id string, raw_response string, extracted_json string, fix_applied string, fix_history string, error_label string, generation_id string, model_used string, provider_used string, cost_usd double, prompt_tokens long, completion_tokens long, reasoning_tokens long, cached_tokens long, latency_ms long, created_at string"
CACHE = "key string, namespace string, value string, created_at double"
