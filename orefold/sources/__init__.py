"""Readers and the audit columns every layer adds."""

from .audit import (
    BRONZE_AUDIT,
    drop_bronze_audit,
    with_bronze_audit,
    with_gold_audit,
    with_silver_audit,
)
from .readers import (
    count_malformed,
    read_csv_declared,
    read_csv_flagged,
    read_csv_strings,
    read_layer,
    read_table,
)

__all__ = [
    "BRONZE_AUDIT",
    "count_malformed",
    "drop_bronze_audit",
    "read_csv_declared",
    "read_csv_flagged",
    "read_csv_strings",
    "read_layer",
    "read_table",
    "with_bronze_audit",
    "with_gold_audit",
    "with_silver_audit",
]
