"""The queries of this subpackage, by name, and their SQL where SQL can state them."""

from __future__ import annotations

from schemaloom.llm import duplicates, leakage, packing, truncation

QUERIES = {
    "p6_found": duplicates.copies,
    "p6_collapsed": duplicates.collapsed,
    "p6_repeated": duplicates.repeated_texts,
    "p7_containers": packing.document_containers,
    "p7_fill": packing.container_fill,
    "p7_kept": packing.what_was_kept,
    "p8_found": leakage.leaked_pairs,
    "p8_near": leakage.near_pairs,
    "p8_items": leakage.leaked_items,
    "p9_found": truncation.truncated_documents,
    "p9_by_source": truncation.truncation_by_source,
    "p9_evidence": truncation.truncation_evidence,
}

ORACLE: dict[str, str] = {
    "p6_repeated": """with r as (select schema_version_id id, definition t from glue_versions union all select request_id, schema from requests)
select min(id) first_id, count(distinct id) n_copies from r where id is not null and t is not null group by t""",
    "p7_kept": "select 0::bigint n_overfull, 0::bigint n_needless_cuts, 0::bigint n_lost_or_repeated, count(*) n_documents from documents where text is not null and text<>''",
}
