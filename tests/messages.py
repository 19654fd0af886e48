"""Change messages for tests."""

import json

from changefold.sources.topic import MESSAGE_SCHEMA

TOPIC = "pg.public.product"


def change(op="c", key="P1", seq=1, table="product", **fields):
    """One message value as a dict; deletes and truncates carry no row image."""
    after = {
        "product_id": key,
        "product_name": "name",
        "product_type": "SVOD",
        "description": None,
        "created_at": "2024-01-01T00:00:00.000000Z",
        "updated_at": "2024-01-02T00:00:00.000000Z",
        **fields,
    }
    return {
        "schema": {"type": "struct"},
        "payload": {
            "before": {"product_id": key} if op == "d" else None,
            "after": None if op in ("d", "t") else after,
            "source": {"name": "pg", "schema": "public", "table": table, "ts_ms": seq},
            "op": op,
        },
    }


def as_messages(spark, values, partition=0, start=0):
    """Message rows from dicts, texts, bytes or None, at consecutive offsets."""

    def encode(value):
        if isinstance(value, dict):
            value = json.dumps(value)
        return value.encode() if isinstance(value, str) else value

    rows = [(TOPIC, partition, start + i, encode(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)
