"""Sorting out what the topic delivers: broken messages (F9) and repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame

from changefold.functions.decode import decode_messages, with_delivery_id

QUARANTINE_COLUMNS = ["delivery_id", "topic", "partition", "offset", "value", "reason"]


def triage(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (good, quarantine); every message is in exactly one of them."""
    decoded = decode_messages(messages)
    good = decoded.where("reason IS NULL").drop("value", "reason")
    return good, with_delivery_id(decoded.where("reason IS NOT NULL")).select(*QUARANTINE_COLUMNS)


def drop_redelivered(messages: DataFrame) -> DataFrame:
    """One row per delivery identity. Batch only: the streaming folds absorb repeats by themselves."""
    return messages.dropDuplicates(["topic", "partition", "offset"])
