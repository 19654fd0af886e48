"""One query per operator, each over the whole `events` table by way of its change feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.functions.decode import (
    BRONZE_SCHEMA,
    CLEAN_SCHEMA,
    LINEAGE_SCHEMA,
    PRODUCTS_SCHEMA,
    REPAIRED,
    STRICT,
    STRICT_PAYLOAD_SCHEMA,
    add_message_ids,
    evaluate_once,
    schema_of,
)
from changefold.functions.quality import STRICT_RULES, check_constraints, expectation_metrics, failing_rows
from changefold.operators.apply_changes import DELETED, TRUNCATED, ChangeSpec, cut_truncated, fold, mark, present, to_state
from changefold.operators.delivery import drop_redelivered, triage
from changefold.plans.feed import change_feed, clean_rows, product_rows, projected_rows, routed_rows
from changefold.session import work_dir
from changefold.sources.landing import LINES, ONE_PER_FILE, read_landing, write_landing, write_one_per_file
from changefold.sources.tables import read_table, read_table_stream, start_append
from changefold.sources.topic import MESSAGE_SCHEMA
from changefold.streaming.flows import bronze_flow, clean_flow, expectation_counts, read_clean, read_clean_stream
from changefold.streaming.ledger import Ledger, ledger_flow, read_missing, read_repeats, read_seen
from changefold.streaming.refresh import HISTORY, PRODUCTS, PRODUCTS_TABLE, run_refresh, targets_of
from changefold.streaming.state import read_current, track_current
from changefold.streaming.target import read_rejects, read_target, read_violations

Query = Callable[[SparkSession, str], DataFrame]
ROUTE = ("pg", "public", "product")
TWO_KEYS = ("product_id", "partition")


def in_micros(df: DataFrame) -> DataFrame:
    """Timestamps as whole microseconds, so that no engine's session zone matters in a comparison."""
    return df.select(
        *[
            F.unix_micros(c).alias(c.replace("_at", "_us")) if c in ("created_at", "updated_at") else F.col(c)
            for c in df.columns
        ]
    )


def opaque(member: str, path: str) -> Column:
    return F.get_json_object(member, path)


# --- projections ---------------------------------------------------------------------------------


def p1_envelope_fields(spark, sf_dir):
    return routed_rows(spark, sf_dir).select(
        "topic",
        "partition",
        "offset",
        opaque("schema", "$.type").alias("schema_type"),
        opaque("payload", "$.op").alias("op"),
        opaque("payload", "$.source.ts_ms").cast("bigint").alias("ts_ms"),
    )


def p2_routing_fields(spark, sf_dir):
    return routed_rows(spark, sf_dir).select("partition", "offset", "src_catalog", "src_schema", "src_table")


def p3_message_names(spark, sf_dir):
    named = add_message_ids(routed_rows(spark, sf_dir))
    return named.select("message_id", "landing_name", "landing_dir", "delivery_id")


def p4_opaque_members(spark, sf_dir):
    return routed_rows(spark, sf_dir).select(
        "partition",
        "offset",
        F.col("schema").alias("schema_text"),
        opaque("payload", "$.op").alias("payload_op"),
        opaque("payload", "$.before").alias("payload_before"),
    )


def p5_parse_payload(spark, sf_dir):
    parsed = evaluate_once(product_rows(spark, sf_dir), "p", F.from_json("payload", STRICT_PAYLOAD_SCHEMA))
    return parsed.select(
        "partition",
        "offset",
        "p.after.product_id",
        "p.after.product_name",
        "p.op",
        "p.source.ts_ms",
        F.col("p.after.created_at").alias("created_text"),
    )


def p6_clean_projection(spark, sf_dir):
    return in_micros(projected_rows(spark, sf_dir))


def p7_parse_timestamps(spark, sf_dir):
    return in_micros(projected_rows(spark, sf_dir).select("partition", "offset", "created_at", "updated_at"))


def p8_drop_bookkeeping(spark, sf_dir):
    return in_micros(clean_rows(spark, sf_dir).drop(*PRODUCTS.except_columns))


def p9_conform_products(spark, sf_dir):
    products = _target(_clean_table(spark, sf_dir, STRICT), PRODUCTS)
    return in_micros(products.to(schema_of(PRODUCTS_SCHEMA)))


# --- expectations and triage ---------------------------------------------------------------------


def _failing(rule: str, column: str) -> Query:
    def query(spark, sf_dir):
        failing = failing_rows(projected_rows(spark, sf_dir), STRICT_RULES[rule])
        return in_micros(failing.select("partition", "offset", column))

    return query


def _clean(mode: str) -> Query:
    return lambda spark, sf_dir: in_micros(clean_rows(spark, sf_dir, mode))


def f8_expectation_counts(spark, sf_dir):
    return expectation_metrics(projected_rows(spark, sf_dir), STRICT_RULES)


def f9_quarantine(spark, sf_dir):
    _, quarantine = triage(change_feed(spark, sf_dir))
    return quarantine.drop("value")


# --- change application --------------------------------------------------------------------------


def _clean_table(spark, sf_dir, mode: str) -> DataFrame:
    """The folds read their changes more than once, so those are first written, as in a refresh."""
    path = f"{work_dir(spark, 'clean')}/clean"
    clean_rows(spark, sf_dir, mode).write.parquet(path)
    return read_table(spark, path, f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}")


def _target(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    return present(to_state(mark(changes, spec), spec), spec)


def _applied(mode: str, spec: ChangeSpec) -> Query:
    return lambda spark, sf_dir: in_micros(_target(_clean_table(spark, sf_dir, mode), spec))


def _newest(changes: DataFrame) -> DataFrame:
    """The state behind `products`: deletes kept, before the truncate cut."""
    return fold(mark(changes, PRODUCTS), PRODUCTS)


def c2_newest_change(spark, sf_dir):
    newest = _newest(clean_rows(spark, sf_dir, REPAIRED))
    return newest.where(~F.col(TRUNCATED)).select("product_id", "op", "ts_ms", "topic", "partition", "offset")


def c3_deleted_keys(spark, sf_dir):
    return _newest(clean_rows(spark, sf_dir, REPAIRED)).where(DELETED).select("product_id", "ts_ms")


def c4_truncate_cut(spark, sf_dir):
    changes = _clean_table(spark, sf_dir, REPAIRED)
    marked = mark(changes, PRODUCTS)
    kept = cut_truncated(fold(marked, PRODUCTS), marked, PRODUCTS)
    return kept.where(~F.col(TRUNCATED)).select("product_id", "op", "ts_ms")


def c5_nulls_overwrite(spark, sf_dir):
    products = _target(_clean_table(spark, sf_dir, REPAIRED), PRODUCTS)
    return products.where("description IS NULL").select("product_id", "description")


def c8_history_ignores_truncate(spark, sf_dir):
    changes = _clean_table(spark, sf_dir, REPAIRED)
    cut = changes.where(PRODUCTS.truncate_when).agg(F.max("ts_ms")).scalar()
    return _target(changes, HISTORY).where(F.col("valid_from") <= cut).select("product_id", "valid_from")


def c6_timestamp_sequence(spark, sf_dir):
    """History by a timestamp."""
    at = F.timestamp_millis("ts_ms")
    changes = _clean_table(spark, sf_dir, STRICT).withColumn("at", at)
    spec = replace(HISTORY, sequence_by="at", except_columns=(*HISTORY.except_columns, "at"), era=None)
    versions = in_micros(_target(changes, spec))
    bounds = [F.unix_micros(c).alias(f"{c}_us") for c in ("valid_from", "valid_to")]
    return versions.select(*[c for c in versions.columns if not c.startswith("valid_")], *bounds)


def c9_dedup_delivery(spark, sf_dir):
    return drop_redelivered(change_feed(spark, sf_dir)).select("topic", "partition", "offset")


def c10_constraint_violations(spark, sf_dir):
    required = ["product_id", "product_name", "product_type"]
    return check_constraints(projected_rows(spark, sf_dir), ["product_id"], required)


# --- streams -------------------------------------------------------------------------------------


#: Messages of a file of the topic: well below a row group, so that readers share them out evenly whatever the feed's size.
TOPIC_FILE = 50_000


def _append_topic(feed: DataFrame, root: str) -> None:
    feed.write.mode("append").option("maxRecordsPerFile", TOPIC_FILE).parquet(f"{root}/topic")


def _topic_stream(spark, sf_dir, root: str) -> DataFrame:
    """The feed as a stream with the topic source's columns."""
    _append_topic(change_feed(spark, sf_dir), root)
    return spark.readStream.schema(MESSAGE_SCHEMA).parquet(f"{root}/topic")


def _landed(spark, sf_dir, root: str) -> str:
    write_landing(_topic_stream(spark, sf_dir, root), f"{root}/landing", f"{root}/cp/landing").awaitTermination()
    return f"{root}/landing"


def _bronze(spark, sf_dir, root: str) -> str:
    arrivals = read_landing(spark, _landed(spark, sf_dir, root), LINES, ROUTE)
    bronze_flow(arrivals, f"{root}/bronze", f"{root}/cp/bronze").awaitTermination()
    return f"{root}/bronze"


def s2_landing_counts(spark, sf_dir):
    landing = _landed(spark, sf_dir, work_dir(spark, "s2"))
    route = ["status", "src_catalog", "src_schema", "src_table"]
    rows = spark.read.schema(", ".join(f"{c} string" for c in [*route, "reason"])).json(landing)
    return rows.groupBy(*route, "reason").agg(F.count(F.lit(1)).alias("n"))


def s3_bronze_stream(spark, sf_dir):
    bronze = read_table(spark, _bronze(spark, sf_dir, work_dir(spark, "s3")), BRONZE_SCHEMA)
    return bronze.select("topic", "partition", "offset", opaque("payload", "$.op").alias("payload_op"))


def s3_one_per_file(spark, sf_dir):
    """Bronze from one indented document per file."""
    root = work_dir(spark, "s3")
    write_one_per_file(product_rows(spark, sf_dir), f"{root}/files")
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    kept = spark.conf.get(listing)
    spark.conf.set(listing, 4 * spark.sparkContext.defaultParallelism)  # by default each small file is a task
    try:
        arrivals = read_landing(spark, f"{root}/files", ONE_PER_FILE, listing=f"{root}/listing")
        bronze_flow(arrivals, f"{root}/bronze", f"{root}/cp/bronze").awaitTermination()
    finally:
        spark.conf.set(listing, kept)
    bronze = read_table(spark, f"{root}/bronze", BRONZE_SCHEMA)
    return bronze.select("topic", "partition", "offset", opaque("payload", "$.op").alias("payload_op"))


def c9_stream_identity(spark, sf_dir):
    """Repeats are still told from two topics' messages of one partition and offset after landing and bronze."""
    bronze = read_table(spark, _bronze(spark, sf_dir, work_dir(spark, "c9")), BRONZE_SCHEMA)
    return drop_redelivered(bronze).select("topic", "partition", "offset")


def c9_stream_ledger(spark, sf_dir):
    """Ranges of offsets that reached bronze, those that did not, and repeats. The feed gives a partition every fourth number;
    a broker leaves none out, so offsets are numbered that way here."""
    root = work_dir(spark, "ledger")
    bronze = read_table_stream(spark, _bronze(spark, sf_dir, root), BRONZE_SCHEMA, maxFilesPerTrigger=4)
    ledger = Ledger(f"default.ledger_{root.rstrip('/').rsplit('-', 1)[-1].replace('/', '_')}", f"{root}/ledger")
    ledger_flow(bronze.withColumn("offset", F.expr("offset div 4")), ledger, f"{root}/cp/ledger").awaitTermination()
    ranges = [read_seen(spark, ledger).withColumn("kind", F.lit("seen")), read_missing(spark, ledger).withColumn("kind", F.lit("missing"))]
    repeats = read_repeats(spark, ledger).withColumn("kind", F.lit("repeated")).withColumnRenamed("repeated", "n").drop("delivered")
    return ranges[0].unionByName(ranges[1]).unionByName(repeats, allowMissingColumns=True)


def f8_stream_counts(spark, sf_dir):
    """The counts from the verdicts that the stream keeps, over micro-batches of one file each."""
    root = work_dir(spark, "f8")
    bronze = read_table_stream(spark, _bronze(spark, sf_dir, root), BRONZE_SCHEMA, maxFilesPerTrigger=1)
    clean_flow(bronze, f"{root}/checked", f"{root}/cp/checked").awaitTermination()
    return expectation_counts(spark, f"{root}/checked", STRICT_RULES)


def s5_table_stream(spark, sf_dir):
    root = work_dir(spark, "s5")
    rows = read_table_stream(spark, _bronze(spark, sf_dir, root), BRONZE_SCHEMA).select("partition", "offset")
    copying = rows.writeStream.option("checkpointLocation", f"{root}/cp/copy").trigger(availableNow=True)
    start_append(copying, f"{root}/copy").awaitTermination()
    return spark.read.schema("partition int, offset bigint").parquet(f"{root}/copy")


def s6_clean_stream(spark, sf_dir):
    root = work_dir(spark, "s6")
    bronze = read_table_stream(spark, _bronze(spark, sf_dir, root), BRONZE_SCHEMA)
    clean_flow(bronze, f"{root}/checked", f"{root}/cp/checked").awaitTermination()
    return in_micros(read_clean(spark, f"{root}/checked"))


def c1_state_store(spark, sf_dir):
    """Current state from the state of a streaming aggregation, over micro-batches of four files each."""
    root = work_dir(spark, "c1")
    bronze = read_table_stream(spark, _bronze(spark, sf_dir, root), BRONZE_SCHEMA)
    clean_flow(bronze, f"{root}/checked", f"{root}/cp/checked", REPAIRED).awaitTermination()
    changes = read_clean_stream(spark, f"{root}/checked", maxFilesPerTrigger=4)
    track_current(changes, PRODUCTS, f"{root}/cp/state").awaitTermination()
    return in_micros(read_current(spark, PRODUCTS, f"{root}/cp/state"))


def refreshed(spark, sf_dir, waves=((2,), (0, 3), (1,)), database: str | None = None, products=PRODUCTS):
    """Land the topic's partitions in waves, each over the whole time range, with a refresh after each; gives both targets."""
    root = work_dir(spark, "refresh")
    feed = change_feed(spark, sf_dir)
    for wave in waves:
        _append_topic(feed.where(F.col("partition").isin(*wave)), root)
        arrivals = spark.readStream.schema(MESSAGE_SCHEMA).parquet(f"{root}/topic")
        write_landing(arrivals, f"{root}/landing", f"{root}/landing_cp").awaitTermination()
        run_refresh(spark, f"{root}/landing", f"{root}/tables", LINES, ROUTE, REPAIRED, database, products)
    return targets_of(f"{root}/tables", database, products)


def t1_refresh_products(spark, sf_dir):
    return in_micros(read_target(spark, refreshed(spark, sf_dir)[0]))


def t1_refresh_history(spark, sf_dir):
    return in_micros(read_target(spark, refreshed(spark, sf_dir)[1]))


def x8_rejects(spark, sf_dir):
    """What the refreshed products target could not place."""
    rejects = read_rejects(spark, refreshed(spark, sf_dir)[0])
    return rejects.select("delivery_id", "product_id", "op", "topic", "partition", "offset", "reason")


def c10_target_constraints(spark, sf_dir):
    """Violations of the target's key and required columns as each batch keeps them up, with the description required as well."""
    spec = replace(PRODUCTS, required=(*PRODUCTS.required, "description"))
    return read_violations(spark, refreshed(spark, sf_dir, products=spec)[0])


def t4_products_by_name(spark, sf_dir):
    """The target by its name, after three refreshes."""
    root = work_dir(spark, "database")
    database = f"changefold_{root.rstrip('/').rsplit('-', 1)[-1].replace('/', '_')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    refreshed(spark, sf_dir, database=database)
    return in_micros(spark.table(f"{database}.{PRODUCTS_TABLE}"))


QUERIES: dict[str, Query] = {
    "p1_envelope_fields": p1_envelope_fields,
    "p2_routing_fields": p2_routing_fields,
    "p3_message_names": p3_message_names,
    "p4_opaque_members": p4_opaque_members,
    "p5_parse_payload": p5_parse_payload,
    "p6_clean_projection": p6_clean_projection,
    "p7_parse_timestamps": p7_parse_timestamps,
    "p8_drop_bookkeeping": p8_drop_bookkeeping,
    "p9_conform_products": p9_conform_products,
    "f1_valid_product_id": _failing("valid_product_id", "product_id"),
    "f2_valid_product_name": _failing("valid_product_name", "product_name"),
    "f3_valid_product_type": _failing("valid_product_type", "product_type"),
    "f4_valid_created_at": _failing("valid_created_at", "created_at"),
    "f5_valid_updated_at": _failing("valid_updated_at", "updated_at"),
    "f6_valid_op": _failing("valid_op", "op"),
    "f7_expect_all_or_drop": _clean(STRICT),
    "f7_expect_all_or_drop_repaired": _clean(REPAIRED),
    "f8_expectation_counts": f8_expectation_counts,
    "f9_quarantine": f9_quarantine,
    "c1_scd1_strict": _applied(STRICT, PRODUCTS),
    "c1_scd1_repaired": _applied(REPAIRED, PRODUCTS),
    "c2_newest_change": c2_newest_change,
    "c3_deleted_keys": c3_deleted_keys,
    "c4_truncate_cut": c4_truncate_cut,
    "c5_nulls_overwrite": c5_nulls_overwrite,
    "c6_scd2_strict": _applied(STRICT, HISTORY),
    "c7_scd2_repaired": _applied(REPAIRED, HISTORY),
    "c8_history_ignores_truncate": c8_history_ignores_truncate,
    "c9_dedup_delivery": c9_dedup_delivery,
    "c10_constraint_violations": c10_constraint_violations,
    "c11_two_column_key": _applied(STRICT, replace(PRODUCTS, keys=TWO_KEYS)),
    "c11_two_column_history": _applied(STRICT, replace(HISTORY, keys=TWO_KEYS)),
    "s2_landing_counts": s2_landing_counts,
    "s3_bronze_stream": s3_bronze_stream,
    "s3_one_per_file": s3_one_per_file,
    "s5_table_stream": s5_table_stream,
    "s6_clean_stream": s6_clean_stream,
    "c6_timestamp_sequence": c6_timestamp_sequence,
    "c9_stream_identity": c9_stream_identity,
    "c9_stream_ledger": c9_stream_ledger,
    "c10_target_constraints": c10_target_constraints,
    "f8_stream_counts": f8_stream_counts,
    "x8_rejects": x8_rejects,
    "t4_products_by_name": t4_products_by_name,
    "c1_state_store": c1_state_store,
    "t1_refresh_products": t1_refresh_products,
    "t1_refresh_history": t1_refresh_history,
}
