"""Message bytes -> envelope -> typed change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The message layout, the table layouts and the landing name formats.
ENVELOPE_SCHEMA = "schema string, payload string"
ROUTE_SCHEMA = "array<struct<payload: struct<source: struct<name: variant, schema: variant, table: variant>>>>"
AFTER_FIELDS = "product_id string, product_name string, product_type string, description string, created_at string, updated_at string"
STRICT_PAYLOAD_SCHEMA = f"after struct<{AFTER_FIELDS}>, op string, source struct<ts_ms bigint>"
REPAIRED_PAYLOAD_SCHEMA = f"before struct<product_id string>, {STRICT_PAYLOAD_SCHEMA}"
BRONZE_SCHEMA = "schema string, payload string, topic string, partition int, offset bigint"
CLEAN_SCHEMA = (
    "product_id string, product_name string, product_type string, description string, "
    "created_at timestamp, updated_at timestamp, op string, ts_ms bigint"
)
LINEAGE_SCHEMA = "topic string, partition int, offset bigint"
PRODUCTS_SCHEMA = (
    "product_id string, product_name string, product_type string, description string, "
    "created_at timestamp, updated_at timestamp"
)
MESSAGE_ID_FORMAT = "offset_%d"
LANDING_NAME_FORMAT = "%s_%s_%s_offset_%d.json"
LANDING_DIR_FORMAT = "%s/%s/%s/"

# Triage. A parser stops where the array it reads is closed. If the text in brackets has one element, and the text in brackets
# with an element after it has two, it is our own bracket that closes both: the text is one document with nothing after it.
ROUTED = "src_catalog IS NOT NULL AND src_schema IS NOT NULL AND src_table IS NOT NULL"
NOTHING_AFTER = """coalesce(json_array_length(concat('[', CAST(value AS STRING), ',0]')),
  size(from_json(concat('[', CAST(value AS STRING), ',{}]'), 'array<struct<_: string>>'))) = 2"""
WELL_FORMED = """json_array_length(concat('[', CAST(value AS STRING), ']')) = 1
  AND is_valid_utf8(value) AND try_parse_json(CAST(value AS STRING)) IS NOT NULL"""
REASON = f"""CASE
  WHEN value IS NULL THEN 'null_value'
  WHEN documents = 1 AND {ROUTED} AND is_valid_utf8(value) AND {NOTHING_AFTER} THEN NULL
  WHEN {WELL_FORMED} AND {NOTHING_AFTER} THEN 'missing_key'
  ELSE 'bad_json'
END"""

ROUTE = "get(m.routes, 0).payload.source"
STRICT, REPAIRED = "strict", "repaired"


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add `value` as a column that later filters reuse instead of recomputing.

    Spark pushes a filter below a projection by copying the projected expression into it, so six
    rules on one `from_json` would parse each row seven times. It never pushes below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def decode_messages(messages: DataFrame) -> DataFrame:
    """Parse `value` into opaque members, routing columns and a `reason` that is NULL for good rows.

    A message is one JSON document, so in brackets it is an array of one. That also refuses empty text, which `from_json`
    otherwise lets through. The three parts of a route have to be JSON strings.
    """
    text = F.col("value").cast("string")
    bracketed = F.concat(F.lit("["), text, F.lit("]"))
    strict_json = {"allowSingleQuotes": "false"}
    parsed = evaluate_once(
        messages,
        "m",
        F.struct(
            F.from_json(text, ENVELOPE_SCHEMA, strict_json).alias("envelope"),
            F.from_json(bracketed, ROUTE_SCHEMA, strict_json).alias("routes"),
        ),
    )
    flat = parsed.selectExpr(
        *messages.columns,
        "m.envelope.schema",
        "m.envelope.payload",
        "size(m.routes) AS documents",
        *[
            f"CASE WHEN schema_of_variant({ROUTE}.{part}) = 'STRING' THEN try_variant_get({ROUTE}.{part}, '$', 'string') END AS {name}"
            for part, name in (("name", "src_catalog"), ("schema", "src_schema"), ("table", "src_table"))
        ],
    )
    route = ["src_catalog", "src_schema", "src_table"]
    return flat.selectExpr(*messages.columns, "schema", "payload", *route, f"{REASON} AS reason")


def with_delivery_id(df: DataFrame) -> DataFrame:
    """Add `delivery_id`, which is unique across topics and partitions."""
    return df.withColumn("delivery_id", F.concat_ws("-", "topic", "partition", "offset"))


def add_message_ids(decoded: DataFrame) -> DataFrame:
    """`message_id`, landing file name and folder, and an id that is unique across partitions."""
    route = ["src_catalog", "src_schema", "src_table"]
    named = decoded.select(
        "*",
        F.format_string(MESSAGE_ID_FORMAT, "offset").alias("message_id"),
        F.format_string(LANDING_NAME_FORMAT, *route, "offset").alias("landing_name"),
        F.format_string(LANDING_DIR_FORMAT, *route).alias("landing_dir"),
    )
    return with_delivery_id(named)


def clean_projection(bronze: DataFrame, mode: str = STRICT) -> DataFrame:
    """Payload text -> the clean columns, plus the delivery identity (`topic`, `partition`, `offset`).

    `strict` reads the row image from `after` only. `repaired` also takes the key from `before`,
    where deletes carry it.
    """
    if mode not in (STRICT, REPAIRED):
        raise ValueError(f"mode is {STRICT!r} or {REPAIRED!r}, not {mode!r}")
    schema = REPAIRED_PAYLOAD_SCHEMA if mode == REPAIRED else STRICT_PAYLOAD_SCHEMA
    key = "coalesce(p.after.product_id, p.before.product_id)" if mode == REPAIRED else "p.after.product_id"
    parsed = evaluate_once(bronze, "p", F.from_json("payload", schema))
    return parsed.selectExpr(
        f"{key} AS product_id",
        "p.after.product_name",
        "p.after.product_type",
        "p.after.description",
        "try_to_timestamp(p.after.created_at) AS created_at",
        "try_to_timestamp(p.after.updated_at) AS updated_at",
        "p.op",
        "p.source.ts_ms",
        "topic",
        "partition",
        "offset",
    ).to(schema_of(f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}"))
