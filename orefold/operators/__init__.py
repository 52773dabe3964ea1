"""DataFrame to DataFrame steps, made to be chained with `.transform`."""

from .clean import (
    cast_columns,
    count_rejects,
    dedupe,
    dedupe_audit,
    dedupe_by_fingerprint,
    fingerprint,
    normalize_text,
    reject_counters,
    rejected_values,
    sentinel_to_null,
    string_columns,
)
from .enrich import dimension_snapshot, enrich_left, frequent_keys, hot_keys, require_unique
from .ranking import first_rows, global_rank, ordinal, top_k
from .summarize import Measure, all_parts, cut_means, finished, summarize

__all__ = [
    "Measure",
    "all_parts",
    "cast_columns",
    "count_rejects",
    "cut_means",
    "dedupe",
    "dedupe_audit",
    "dedupe_by_fingerprint",
    "dimension_snapshot",
    "enrich_left",
    "fingerprint",
    "finished",
    "first_rows",
    "frequent_keys",
    "global_rank",
    "hot_keys",
    "normalize_text",
    "ordinal",
    "reject_counters",
    "rejected_values",
    "require_unique",
    "sentinel_to_null",
    "string_columns",
    "summarize",
    "top_k",
]
