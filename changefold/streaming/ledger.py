"""Which offsets of a topic have arrived, which came again, and which were skipped.

A broker numbers the messages of a topic's partition without gaps, so what has arrived is a few ranges of offsets. The ledger is a
table of those ranges, with a partition for each partition of a topic, and a count of deliveries. A micro-batch becomes ranges
within blocks of offsets first, so a hot topic is spread over many groups; its ranges are then merged with those of the
partitions that it touches, and only they are written. Merging a batch twice changes nothing: ranges are a union, and the count
knows which batch it counted last.

Offsets, partitions or topics that are null are no identity and are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Offsets of a block.
BLOCK = 65_536
SOURCE = ["topic", "partition"]
IDENTITY = "topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL"


@dataclass(frozen=True)
class Ledger:
    """A ledger: its name in the catalog and its folder."""

    name: str
    path: str


def declare_ledger(spark: SparkSession, ledger: Ledger) -> None:
    if spark.catalog.tableExists(ledger.name):
        spark.catalog.refreshTable(ledger.name)
        return
    columns = "first bigint, last bigint, delivered bigint, before bigint, batch_id bigint, topic string, partition int"
    spark.sql(
        f"CREATE TABLE {ledger.name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic')"
        f" PARTITIONED BY (topic, partition) LOCATION '{ledger.path}'"
    )
    spark.table(ledger.name).limit(0).write.insertInto(ledger.name)  # makes the folder
    spark.sql(f"ALTER TABLE {ledger.name} RECOVER PARTITIONS")


def ranges_in_blocks(deliveries: DataFrame) -> DataFrame:
    """(topic, partition, first, last, delivered): ranges of offsets without a gap, cut at blocks."""
    offsets = deliveries.where(IDENTITY).groupBy(*SOURCE, "offset").agg(F.count(F.lit(1)).alias("n"))
    in_block = Window.partitionBy(*SOURCE, "_block").orderBy("offset")
    runs = offsets.withColumn("_block", F.expr(f"offset div {BLOCK}")).withColumn("_run", F.col("offset") - F.row_number().over(in_block))
    ends = [F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("n").alias("delivered")]
    return runs.groupBy(*SOURCE, "_block", "_run").agg(*ends).drop("_block", "_run")


def joined_ranges(ranges: DataFrame) -> DataFrame:
    """(topic, partition, first, last) where ranges that overlap or follow on one another are one."""
    before = Window.partitionBy(*SOURCE).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_reach", F.max("last").over(before))
    new = F.when(F.col("first") <= F.col("_reach") + 1, 0).otherwise(1)
    numbered = starts.withColumn("_range", F.sum(new).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*SOURCE, "_range").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_range")


def merge_deliveries(batch: DataFrame, batch_id: int, ledger: Ledger) -> None:
    """Take the (topic, partition, offset) of one micro-batch into the ledger, which has been declared."""
    spark = batch.sparkSession
    arrived = ranges_in_blocks(batch).persist()
    try:
        table = spark.table(ledger.name)
        held = table.join(arrived.select(*SOURCE).distinct(), SOURCE, "left_semi")
        ranges = joined_ranges(held.where("first IS NOT NULL").select(*SOURCE, "first", "last").unionByName(arrived.drop("delivered")))

        counted = arrived.groupBy(*SOURCE).agg(F.sum("delivered").alias("new"))
        tally = held.where("first IS NULL").select(*SOURCE, "delivered", "before", "batch_id")
        again = F.col("batch_id") == batch_id
        before = F.coalesce(F.when(again, F.col("before")).otherwise(F.col("delivered")), F.lit(0))
        tally = counted.join(tally, SOURCE, "left").withColumn("before", before)
        tally = tally.select(*SOURCE, (F.col("before") + F.col("new")).alias("delivered"), "before", F.lit(batch_id).cast("bigint").alias("batch_id"))
        rows = ranges.unionByName(tally, allowMissingColumns=True).select(*table.columns)
        rows.repartition(*SOURCE).write.insertInto(ledger.name, True)
    finally:
        arrived.unpersist()


def ledger_flow(deliveries: DataFrame, ledger: Ledger, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the ledger in step with a stream that has topic, partition and offset."""
    declare_ledger(deliveries.sparkSession, ledger)
    writer = deliveries.select(*SOURCE, "offset").writeStream.foreachBatch(lambda batch, number: merge_deliveries(batch, number, ledger))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_seen(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """(topic, partition, first, last): the ranges of offsets that have arrived."""
    declare_ledger(spark, ledger)
    return spark.table(ledger.name).where("first IS NOT NULL").select(*SOURCE, "first", "last")


def read_missing(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """(topic, partition, first, last): the ranges of offsets between those that have arrived."""
    following = F.lead("first").over(Window.partitionBy(*SOURCE).orderBy("first"))
    gaps = read_seen(spark, ledger).withColumn("_next", following).where("_next IS NOT NULL")
    return gaps.select(*SOURCE, (F.col("last") + 1).alias("first"), (F.col("_next") - 1).alias("last"))


def read_repeats(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """(topic, partition, delivered, repeated): deliveries, and those of an offset that had been delivered before."""
    declare_ledger(spark, ledger)
    covered = F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0))
    sums = spark.table(ledger.name).groupBy(*SOURCE).agg(F.max("delivered").alias("delivered"), covered.alias("covered"))
    return sums.select(*SOURCE, "delivered", (F.col("delivered") - F.col("covered")).alias("repeated"))


def unseen(deliveries: DataFrame, ledger: Ledger) -> DataFrame:
    """One of each of the deliveries whose offset is not in the ledger. Ranges meet rows by block, so no topic is one group."""
    spark = deliveries.sparkSession
    block = F.expr(f"offset div {BLOCK}")
    rows = deliveries.where(IDENTITY).dropDuplicates([*SOURCE, "offset"]).withColumn("_block", block)
    blocks = rows.select(*SOURCE, "_block").distinct()
    seen = read_seen(spark, ledger).join(blocks, SOURCE).where(f"first div {BLOCK} <= _block AND last div {BLOCK} >= _block")
    seen = seen.select(*[F.col(c).alias(f"_{c}") for c in SOURCE], F.col("_block").alias("_in"), "first", "last")
    same = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition")) & (F.col("_block") == F.col("_in"))
    return rows.join(seen, same & F.col("offset").between(F.col("first"), F.col("last")), "left_anti").drop("_block")
