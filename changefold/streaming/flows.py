"""The flows between tables, each one streaming query with its own checkpoint."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from changefold.functions.decode import CLEAN_SCHEMA, LINEAGE_SCHEMA, REPAIRED, STRICT, clean_projection, schema_of
from changefold.functions.quality import REPAIRED_RULES, STRICT_RULES, verdict_counts, with_verdict
from changefold.session import write_unsorted
from changefold.sources.tables import read_table, read_table_stream, start_append
from changefold.streaming.target import Target, check_buckets, declare, merge_batch

KEPT, FAILED = "kept", "failed"
CHECKED_SCHEMA = f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}, failed bigint, verdict string"


def _writer(rows: DataFrame, checkpoint: str, available_now: bool) -> DataStreamWriter:
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer


def bronze_flow(landing: DataFrame, target: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Raw members, unchanged, with their lineage."""
    rows = landing.select("schema", "payload", "topic", "partition", "offset")
    return start_append(_writer(rows, checkpoint, available_now), target)


def rules_of(mode: str) -> Mapping[str, str]:
    return REPAIRED_RULES if mode == REPAIRED else STRICT_RULES


def clean_flow(
    bronze: DataFrame,
    target: str,
    checkpoint: str,
    mode: str = STRICT,
    rules: Mapping[str, str] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Typed changes with their verdict: `failed` has a bit for each rule that a row fails, and rows that fail none are `kept`.

    One sink, partitioned by the verdict, takes both, so each message is parsed once for the clean rows (`read_clean`), the
    dropped ones and the counts per rule (`expectation_counts`), and all of them are exactly once.
    """
    write_unsorted(bronze.sparkSession)
    checked = with_verdict(clean_projection(bronze, mode), rules or rules_of(mode))
    checked = checked.withColumn("verdict", F.when(F.col("failed") == 0, KEPT).otherwise(FAILED))
    return start_append(_writer(checked, checkpoint, available_now).partitionBy("verdict"), target)


def _kept(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("verdict") == KEPT).select(*schema_of(f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}").names)


def read_clean(spark: SparkSession, target: str) -> DataFrame:
    """The rows of `clean_flow` that meet every rule."""
    return _kept(read_table(spark, target, CHECKED_SCHEMA))


def read_clean_stream(spark: SparkSession, target: str, **options: object) -> DataFrame:
    return _kept(read_table_stream(spark, target, CHECKED_SCHEMA, **options))


def read_failed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of `clean_flow` that fail a rule, with `failed`."""
    return read_table(spark, target, CHECKED_SCHEMA).where(F.col("verdict") == FAILED).drop("verdict")


def expectation_counts(spark: SparkSession, target: str, rules: Mapping[str, str]) -> DataFrame:
    """Failures per rule (`rule`, `failed`) of all that `clean_flow` has taken."""
    return verdict_counts(read_failed(spark, target), rules)


def apply_changes_stream(changes: DataFrame, target: Target, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the target in step with a stream of changes, in whatever order they arrive."""
    declare(changes.sparkSession, target)
    check_buckets(changes.sparkSession, target)
    writer = changes.writeStream.foreachBatch(lambda batch, number: merge_batch(batch, number, target))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
