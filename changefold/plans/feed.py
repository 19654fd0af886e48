"""A change feed derived from the `events` table: one event is one change message (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefold.functions.decode import REPAIRED, STRICT, clean_projection
from changefold.functions.quality import REPAIRED_RULES, STRICT_RULES, expect_all_or_drop
from changefold.operators.delivery import triage


def spread(table: DataFrame, by: str) -> DataFrame:
    """Give every core an equal share of a table that has less than two splits for each.

    Splits hold whole row groups, so some of a few splits are empty and others hold several. JSON work per row far outweighs
    moving such a table once; a larger one is left as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, by) if table.rdd.getNumPartitions() < 2 * cores else table


# One row image per event, with the faults that the checks are there for.
ROW_IMAGES = [
    "event_id",
    "explode(if(event_id % 71 = 7, array('pg.public.product', 'pg.public.product_b'), array('pg.public.product'))) AS topic",
    "printf('P%06d', user_id) AS product_id",
    "CASE WHEN event_id % 31 <> 0 THEN 'name-' END AS name_start",
    """CASE WHEN event_id % 29 = 0 THEN 'Free' WHEN user_id % 3 = 0 THEN 'Linear' WHEN user_id % 3 = 1 THEN 'SVOD'
       ELSE 'TVOD' END AS product_type""",
    "CASE WHEN event_id % 5 <> 0 THEN props END AS description",
    "if(event_id % 67 = 1, 'nonsense', '2024-01-01T00:00:00.000000Z') AS created_at",
    "concat(translate(CAST(ts AS STRING), ' ', 'T'), 'Z') AS changed_at",
    """CASE WHEN event_id % 4000 = 700 THEN 't' WHEN event_id % 17 = 0 THEN 'r' WHEN event_type = 'signup' THEN 'c'
       WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op""",
]
NAMES = ["*", "concat(name_start, if(topic LIKE '%_b', 'b-', ''), event_id) AS product_name"]
PAYLOAD_PARTS = [
    "event_id",
    "topic",
    "op",
    "CASE event_id % 47 WHEN 5 THEN 'partner' WHEN 6 THEN 'region' ELSE 'product' END AS table",
    "CASE WHEN op = 'd' THEN struct(product_id) END AS before",
    """CASE WHEN op NOT IN ('d', 't') THEN struct(product_id, product_name, product_type, description, created_at,
       CASE WHEN event_id % 37 = 0 THEN 'not-a-time' ELSE changed_at END AS updated_at) END AS after""",
    """CASE WHEN op = 't' THEN 1706616000000 WHEN event_id % 59 = 1 THEN NULL
       WHEN event_id % 9 = 4 THEN unix_millis(to_timestamp(changed_at)) div 86400000 * 86400000
       ELSE unix_millis(to_timestamp(changed_at)) END AS ts_ms""",
]


def envelope(source: str) -> str:
    payload = f"struct(before, after, struct({source}) AS source, op)"
    return f"to_json(struct(struct('struct' AS type) AS schema, {payload} AS payload), map('ignoreNullFields', 'false'))"


ROUTED = envelope("'pg' AS name, 'public' AS schema, table, ts_ms")
MESSAGE = f"""CASE WHEN event_id % 53 = 1 THEN NULL WHEN event_id % 53 = 2 THEN ''
  WHEN event_id % 41 = 40 THEN '{{oops'
  WHEN event_id % 53 = 3 THEN concat({ROUTED}, '] x')
  WHEN event_id % 53 = 4 THEN {envelope("'pg' AS name, 'public' AS schema, 5 AS table, ts_ms")}
  WHEN event_id % 43 = 42 THEN {envelope("'pg' AS name, 'public' AS schema, ts_ms")}
  ELSE {ROUTED} END"""


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages (`topic`, `partition`, `offset`, `value`), each thirteenth delivered twice."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")
    messages = events.selectExpr(*ROW_IMAGES).selectExpr(*NAMES).selectExpr(*PAYLOAD_PARTS).selectExpr(
        "topic",
        "CAST(event_id % 4 AS INT) AS partition",
        "event_id AS offset",
        f"CAST({MESSAGE} AS BINARY) AS value",
        "explode(array_repeat(1, CASE WHEN event_id % 13 = 0 THEN 2 ELSE 1 END)) AS delivery",
    )
    return messages.drop("delivery")


def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed after decoding and routing, repeats included: every later step takes them."""
    good, _ = triage(change_feed(spark, sf_dir))
    return good


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the routed rows, those of the product table, which is what lands in its bronze table."""
    return routed_rows(spark, sf_dir).where("src_catalog = 'pg' AND src_schema = 'public' AND src_table = 'product'")


def projected_rows(spark: SparkSession, sf_dir: str, mode: str = STRICT) -> DataFrame:
    return clean_projection(product_rows(spark, sf_dir), mode)


def clean_rows(spark: SparkSession, sf_dir: str, mode: str = STRICT) -> DataFrame:
    """Batch form of the clean table."""
    rules = REPAIRED_RULES if mode == REPAIRED else STRICT_RULES
    return expect_all_or_drop(projected_rows(spark, sf_dir, mode), rules)
