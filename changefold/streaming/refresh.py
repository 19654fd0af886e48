"""One triggered run that brings every table up to date."""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changefold.functions.decode import BRONZE_SCHEMA, CLEAN_SCHEMA, LINEAGE_SCHEMA, STRICT, schema_of
from changefold.operators.apply_changes import ChangeSpec
from changefold.sources.landing import LINES, read_landing
from changefold.sources.tables import read_table_stream
from changefold.streaming.flows import KEPT, apply_changes_stream, bronze_flow, clean_flow, expectation_counts, read_clean_stream, rules_of
from changefold.streaming.target import Target, declare, read_target, target_sql, violations_sql

# What the product feed means.
PRODUCTS = ChangeSpec(
    keys=("product_id",),
    sequence_by="ts_ms",
    tie_breaker=("offset", "partition", "topic"),
    delete_when="op = 'd'",
    truncate_when="op = 't'",
    except_columns=("op", "ts_ms", "topic", "partition", "offset"),
    required=("product_id", "product_name", "product_type"),
)
#: Versions of a product are kept apart by 30 days.
HISTORY = replace(
    PRODUCTS, truncate_when=None, ignore_when="op = 't'", scd_type=2, required=(), era="floor(ts_ms / 2592000000)"
)

BRONZE_TABLE, CHECKED_TABLE, CLEAN_TABLE = "products_cdc_bronze", "products_cdc_checked", "products_cdc_clean"
PRODUCTS_TABLE, HISTORY_TABLE = "products", "products_history"


def table_name(root: str, database: str | None, name: str) -> str:
    """A table of `root`: by path, or by name in a database."""
    return f"{database}.{name}" if database else f"{root}/{name}"


def targets_of(
    root: str, database: str | None = None, products: ChangeSpec = PRODUCTS, history: ChangeSpec = HISTORY, buckets: int = 16
) -> tuple[Target, Target]:
    """Products and history below `root`. Without a database their state has a name in the default one that follows from it."""
    own = f"{database}." if database else f"default.changefold_{hashlib.sha256(root.encode()).hexdigest()[:16]}_"
    schema = f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}"
    return tuple(
        Target(f"{own}{name}_state", f"{root}/{name}", spec, schema, buckets)
        for name, spec in ((PRODUCTS_TABLE, products), (HISTORY_TABLE, history))
    )


def run_refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    layout: str = LINES,
    route: tuple[str, str, str] | None = None,
    mode: str = STRICT,
    database: str | None = None,
    products: ChangeSpec = PRODUCTS,
    history: ChangeSpec = HISTORY,
    buckets: int = 16,
    landing_options: dict | None = None,
    table_options: dict | None = None,
) -> dict[str, int]:
    """Take what is new in `landing` through bronze and clean into products and products_history.

    Everything is kept below `root`; with a `database`, its tables are the catalog's, and products, products_history and
    products_violations are names in it (`publish_targets`). Both targets read the clean rows on their own, at the same
    time. Returns the failures per rule so far; what no fold can place is in `read_rejects` of each target, and violations
    of the products' key and required columns in `read_violations`.
    """

    def checkpoint(name: str) -> str:
        return f"{root}/_checkpoints/{name}"

    bronze, checked = (table_name(root, database, name) for name in (BRONZE_TABLE, CHECKED_TABLE))
    options = table_options or {}
    arrivals = read_landing(spark, landing, layout, route, **(landing_options or {}))
    bronze_flow(arrivals, bronze, checkpoint(BRONZE_TABLE)).awaitTermination()
    raw = read_table_stream(spark, bronze, BRONZE_SCHEMA, **options)
    clean_flow(raw, checked, checkpoint(CHECKED_TABLE), mode).awaitTermination()

    both = targets_of(root, database, products, history, buckets)
    changes = read_clean_stream(spark, checked, **options)
    await_all([apply_changes_stream(changes, t, checkpoint(n)) for t, n in zip(both, (PRODUCTS_TABLE, HISTORY_TABLE))])
    for target in both:
        declare(spark, target)  # this session has seen the files of before
    if database:
        publish_targets(spark, database, both)
    return {row["rule"]: row["failed"] for row in expectation_counts(spark, checked, rules_of(mode)).collect()}


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for queries that run side by side; where one fails, none goes on."""
    try:
        for query in queries:
            query.awaitTermination()
    except BaseException:
        for query in queries:
            query.stop()
        raise


def publish_targets(spark: SparkSession, database: str, targets: tuple[Target, Target]) -> None:
    """Make products, products_history, products_violations and products_cdc_clean names of `database`, for every session.

    The names are views of the state, so nothing is copied and they are as of the last batch. A session that has read a name
    before a refresh says `REFRESH TABLE` for the state, as for any table that another session writes.
    """
    products, history = targets
    clean = f"SELECT {', '.join(schema_of(f'{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}').names)} FROM {database}.{CHECKED_TABLE} WHERE verdict = '{KEPT}'"
    views = {
        PRODUCTS_TABLE: target_sql(spark, products),
        HISTORY_TABLE: target_sql(spark, history),
        f"{PRODUCTS_TABLE}_violations": violations_sql(products),
        CLEAN_TABLE: clean,
    }
    for name, sql in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql}")


def create_target_views(spark: SparkSession, root: str, products: ChangeSpec = PRODUCTS, history: ChangeSpec = HISTORY) -> None:
    """Session views `products` and `products_history` of the targets below `root`, for SQL."""
    for name, target in zip((PRODUCTS_TABLE, HISTORY_TABLE), targets_of(root, None, products, history)):
        read_target(spark, target).createOrReplaceTempView(name)
