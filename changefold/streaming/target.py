"""The tables behind a target that changes are streamed into.

The state is a Parquet table in buckets of its keys, with a partition for each bucket. A micro-batch is folded, its rows are dealt
like the table, and the buckets that they touch are merged and overwritten; the stored rows are read in place and never
exchanged, and other buckets are not read. Merging twice gives the same rows, so a repeated batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefold.functions.decode import with_delivery_id
from changefold.functions.quality import check_constraints
from changefold.operators.apply_changes import DELETED, TRUNCATED, VALID_TO, ChangeSpec, fold, mark, rejected_changes

ERA, PART = "_era", "_part"


@dataclass(frozen=True)
class Target:
    """A target: `name` of its state in the catalog, folder, meaning and DDL of its changes. The number of buckets holds for
    good; take about 100 MB of state for each."""

    name: str
    path: str
    spec: ChangeSpec
    schema: str
    buckets: int = 16

    @property
    def cluster(self) -> list[str]:
        return [*self.spec.keys, *([ERA] if self.spec.era else [])]

    @property
    def rejects(self) -> str:
        return f"{self.name}_rejects"

    @property
    def upkeep(self) -> str:
        return f"{self.name}_upkeep"


def placed(marked: DataFrame, target: Target) -> DataFrame:
    """Marked changes with the bucket that Spark gives their keys."""
    rows = marked.withColumn(ERA, F.expr(target.spec.era)) if target.spec.era else marked
    return rows.withColumn(PART, F.pmod(F.hash(*target.cluster), F.lit(target.buckets)))


def merged(rows: DataFrame, target: Target) -> DataFrame:
    """The state that rows of whole buckets lead to; a version of a history ends within its era or, so far, not at all."""
    spec = target.spec
    if spec.scd_type == 1:
        return fold(rows, spec)
    versions = Window.partitionBy(*target.cluster, spec.sequence_by).orderBy(*[F.desc(c) for c in spec.tie_breaker])
    newest = rows.withColumn("_rank", F.row_number().over(versions)).where("_rank = 1").drop("_rank")
    in_key = Window.partitionBy(*target.cluster).orderBy(spec.sequence_by)
    return newest.withColumn(VALID_TO, F.lead(spec.sequence_by).over(in_key))


def declare(spark: SparkSession, target: Target) -> None:
    """Make the target's tables known to the catalog, as they lie in its folder."""
    changes = spark.createDataFrame([], target.schema)
    state = merged(placed(mark(changes, target.spec), target), target)
    state = state.select(*[c for c in state.columns if c != PART], PART)
    found = check_constraints(state, [*target.spec.keys, PART], [], target.spec.sequence_by)
    keys = ", ".join(f"`{c}`" for c in target.cluster)
    order = ", ".join(f"`{c}`" for c in dict.fromkeys([*target.cluster, target.spec.sequence_by]))
    clustered = f"CLUSTERED BY ({keys}) SORTED BY ({order}) INTO {target.buckets} BUCKETS"
    _create(spark, target.name, state, PART, f"{target.path}/state", clustered)
    _create(spark, target.upkeep, found.select(*[c for c in found.columns if c != PART], PART), PART, f"{target.path}/upkeep")
    rejects = rejected_changes(changes, target.spec).withColumn("batch_id", F.lit(0).cast("bigint"))
    _create(spark, target.rejects, rejects, "batch_id", f"{target.path}/rejects")


def _create(spark: SparkSession, name: str, rows: DataFrame, partition: str, path: str, clustered: str = "") -> None:
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    options = "OPTIONS (partitionOverwriteMode 'dynamic')"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {options} PARTITIONED BY ({partition}) {clustered} LOCATION '{path}'")
    rows.write.insertInto(name)  # of no rows: makes the folder
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def merge_plan(spark: SparkSession, target: Target, folded: DataFrame, touched: list[int]) -> DataFrame:
    """The touched buckets with the folded rows merged in; only the latter are exchanged."""
    stored = spark.table(target.name).where(F.col(PART).isin(touched))
    rows = folded.repartition(target.buckets, *target.cluster)
    if target.spec.scd_type == 2:
        stored = stored.drop(VALID_TO)
    return merged(stored.unionByName(rows), target).select(*spark.table(target.name).columns)


def merge_batch(batch: DataFrame, batch_id: int, target: Target) -> None:
    """Take one micro-batch into the target, which has been declared."""
    spark, spec = batch.sparkSession, target.spec
    folded = fold(placed(mark(batch, spec), target), spec).persist()
    try:
        rejected_changes(batch, spec).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.insertInto(target.rejects, True)
        touched = sorted(r[0] for r in folded.select(PART).distinct().collect())  # at most the number of buckets
        if touched:
            merge_plan(spark, target, folded, touched).write.insertInto(target.name, True)
            keep_up(spark, target, touched)
    finally:
        folded.unpersist()


def check_buckets(spark: SparkSession, target: Target) -> None:
    """Rows of a bucket never get fewer. Where they have, a driver was lost while Spark swapped folders, and the state has to be
    made anew: remove the target's folder and its checkpoint, and the next run replays the clean table."""
    seen = spark.table(target.upkeep).where("violation IS NULL").select(PART, "n")
    now = spark.table(target.name).groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
    if not seen.join(now, PART, "left").where("coalesce(rows, 0) < n").isEmpty():
        raise ValueError(f"{target.name} has lost rows of a bucket: remove {target.path} and its checkpoint to replay its changes")


def keep_up(spark: SparkSession, target: Target, touched: list[int]) -> None:
    """Count the touched buckets again: their rows, as a row without `violation`, and the violations of current keys."""
    spec = target.spec
    rows = spark.table(target.name).where(F.col(PART).isin(touched))
    counts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    if spec.scd_type == 1:
        live = rows.where(~F.col(DELETED) & ~F.col(TRUNCATED))
        found = check_constraints(live, [*spec.keys, PART], spec.required, spec.sequence_by)
        counts = counts.unionByName(found, allowMissingColumns=True)
    table = spark.table(target.upkeep)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema if f.name not in counts.columns}
    counts.withColumns(missing).select(*table.columns).write.insertInto(target.upkeep, True)


def _cut(target: Target) -> str:
    """The condition that a row is newer than the newest truncate, all of which share the NULL key's bucket."""
    spec = target.spec
    if not spec.truncate_when:
        return "true"
    nulls = ", ".join("NULL" for _ in spec.keys)
    bucket = f"{PART} = pmod(hash({nulls}), {target.buckets})"
    newest = f"SELECT max({spec.sequence_by}) FROM {target.name} WHERE {TRUNCATED} AND {bucket}"
    return f"coalesce({spec.sequence_by} > ({newest}), true)"


def target_sql(spark: SparkSession, target: Target) -> str:
    """The target's own rows and columns as a query over its state, which is what its name stands for."""
    spec, keys = target.spec, list(target.spec.keys)
    hidden = {DELETED, TRUNCATED, VALID_TO, ERA, PART, *keys, *spec.except_columns}
    own = ", ".join([*keys, *[c for c in spark.table(target.name).columns if c not in hidden]])
    live = f"NOT {DELETED} AND NOT {TRUNCATED}"
    if spec.scd_type == 1:
        return f"SELECT {own} FROM {target.name} WHERE {live} AND {_cut(target)}"
    if not spec.era:
        return f"SELECT {own}, {spec.sequence_by} AS valid_from, {VALID_TO} AS valid_to FROM {target.name} WHERE {live}"
    cluster, by = ", ".join(target.cluster), ", ".join(keys)
    starts = f"SELECT {cluster}, min({spec.sequence_by}) AS _start FROM {target.name} GROUP BY {cluster}"
    nexts = f"SELECT {cluster}, lead(_start) OVER (PARTITION BY {by} ORDER BY {ERA}) AS _next FROM ({starts})"
    return f"""SELECT {own}, {spec.sequence_by} AS valid_from, coalesce({VALID_TO}, _next) AS valid_to
        FROM {target.name} LEFT JOIN ({nexts}) USING ({cluster}) WHERE {live}"""


def read_target(spark: SparkSession, target: Target) -> DataFrame:
    """The target as of the last batch."""
    declare(spark, target)
    return spark.sql(target_sql(spark, target))


def read_rejects(spark: SparkSession, target: Target) -> DataFrame:
    """What the stream could not place, with `reason`, and `delivery_id` where the changes have a lineage."""
    declare(spark, target)
    rejects = spark.table(target.rejects).drop("batch_id")
    return with_delivery_id(rejects) if {"topic", "partition", "offset"} <= set(rejects.columns) else rejects


def violations_sql(target: Target) -> str:
    """Violations of the target's key and required columns, as kept up by its batches."""
    return f"SELECT violation, {', '.join(target.spec.keys)}, n FROM {target.upkeep} WHERE violation IS NOT NULL AND {_cut(target)}"


def read_violations(spark: SparkSession, target: Target) -> DataFrame:
    declare(spark, target)
    return spark.sql(violations_sql(target))
