"""Current state in Spark's own state store.

Where a stream of changes never stops, the newest change of each key can live in the state of a streaming aggregation instead of
a table: RocksDB keeps it beside the executors, the checkpoint holds its versions, and nothing is written per micro-batch but
what changed. It is read back by Spark's `statestore` source, as of any batch that the checkpoint keeps.

A key with a third of all rows is reduced before the shuffle, as any aggregation is. State is never dropped: changes may be late
by any time (T3), so there is one row per key, deleted ones included, and one for all truncates, whose key is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefold.operators.apply_changes import ChangeSpec, cut_truncated, mark, present

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROW = "row"


def newest_by_state(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The newest change per key as an aggregation of structs, which is what a stream keeps as its state."""
    marked = mark(changes, spec)
    rest = [c for c in marked.columns if c not in spec.keys]
    order = F.struct(spec.sequence_by, *spec.tie_breaker)
    return marked.groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), order).alias(ROW))


def track_current(changes: DataFrame, spec: ChangeSpec, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the newest change of each key of a stream of changes in the state of a query with this checkpoint."""
    if spec.scd_type != 1:
        raise ValueError("the state store keeps current state; a history is a table")
    spark = changes.sparkSession
    kept = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # a query takes its settings as it starts
    try:
        writer = newest_by_state(changes, spec).writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(PROVIDER, kept)


def read_current(spark: SparkSession, spec: ChangeSpec, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The target that the state stands for after the last batch, or after batch `batch_id`."""
    options = {} if batch_id is None else {"batchId": batch_id}
    state = spark.read.format("statestore").options(**options).load(checkpoint)
    newest = state.schema["value"].dataType.names[0]  # of a change and its order
    rows = state.select("key.*", f"value.{newest}.*")
    return present(cut_truncated(rows, rows, spec), spec)
