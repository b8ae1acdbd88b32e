"""The queries of the core, by name, and the SQL that states the same over the same tables."""

from __future__ import annotations

from schemaloom.operators import diff, drift, flatten, hierarchy, orphans
from schemaloom.plans import oracle

QUERIES = {
    "p1_found": diff.catalog_differences,
    "p1_by_field": diff.differences_by_field,
    "p1_presence": diff.catalog_presence,
    "p2_found": flatten.nested_fields,
    "p2_fields": flatten.all_fields,
    "p2_top_level": flatten.top_level_table,
    "p2_unparsed": flatten.unparsed,
    "p3_found": drift.schema_changes,
    "p3_steps": drift.changes_with_compatibility,
    "p3_fields": drift.field_table,
    "p3_by_registry": drift.changes_per_registry,
    "p3_fingerprints": drift.version_fingerprints,
    "p3_rules": drift.version_rules,
    "p3_routed": drift.routed_defaults,
    "p4_found": hierarchy.roots_and_depths,
    "p4_hierarchy": hierarchy.schema_hierarchy,
    "p4_descendants": hierarchy.descendant_pairs,
    "p5_found": orphans.orphan_references,
    "p5_by_month": orphans.orphans_per_month,
}

ORACLE = dict(oracle.SQL)
from schemaloom.plans import reference_queries  # noqa: E402

QUERIES |= reference_queries.QUERIES
ORACLE |= reference_queries.ORACLE
