"""Change-data-capture on plain Spark: decode, check, and fold change messages into tables."""

from changefold.functions.decode import (
    CLEAN_SCHEMA,
    PRODUCTS_SCHEMA,
    add_message_ids,
    clean_projection,
    decode_messages,
)
from changefold.functions.quality import (
    REPAIRED_RULES,
    STRICT_RULES,
    check_constraints,
    expect_all_or_drop,
    expectation_metrics,
    failing_rows,
)
from changefold.operators.apply_changes import ChangeSpec, apply_changes, rejected_changes
from changefold.operators.delivery import drop_redelivered, triage
from changefold.sources.landing import read_landing, read_quarantine, write_landing
from changefold.sources.tables import read_table_stream
from changefold.sources.topic import read_change_topic
from changefold.streaming.flows import apply_changes_stream, bronze_flow, clean_flow, expectation_counts, read_clean, read_failed
from changefold.streaming.ledger import Ledger, ledger_flow, read_missing, read_repeats, read_seen, unseen
from changefold.streaming.refresh import create_target_views, run_refresh, targets_of
from changefold.streaming.state import read_current, track_current
from changefold.streaming.target import Target, read_rejects, read_target, read_violations

__all__ = [
    "CLEAN_SCHEMA",
    "PRODUCTS_SCHEMA",
    "REPAIRED_RULES",
    "STRICT_RULES",
    "ChangeSpec",
    "Ledger",
    "Target",
    "add_message_ids",
    "apply_changes",
    "apply_changes_stream",
    "bronze_flow",
    "check_constraints",
    "clean_flow",
    "clean_projection",
    "create_target_views",
    "decode_messages",
    "drop_redelivered",
    "expect_all_or_drop",
    "expectation_counts",
    "expectation_metrics",
    "failing_rows",
    "ledger_flow",
    "read_change_topic",
    "read_clean",
    "read_current",
    "read_failed",
    "read_landing",
    "read_missing",
    "read_quarantine",
    "read_rejects",
    "read_repeats",
    "read_seen",
    "read_table_stream",
    "read_target",
    "read_violations",
    "rejected_changes",
    "run_refresh",
    "targets_of",
    "track_current",
    "triage",
    "unseen",
    "write_landing",
]
