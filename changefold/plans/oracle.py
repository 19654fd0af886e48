"""The registered queries again, as SQL over `events`, written without the JSON round trip."""

from __future__ import annotations

# The feed of FIXTURES.md: `feed` has one row per message, `delivered` one per delivery. The names, rules and
# faults that the feed has too, stated here a second time on purpose.
_FEED = """
WITH messages AS (
  SELECT *, unnest(CASE WHEN event_id % 71 = 7 THEN ['pg.public.product', 'pg.public.product_b'] ELSE ['pg.public.product'] END) AS topic
  FROM events
),
parts AS (
  SELECT
    topic,
    CAST(event_id % 4 AS INTEGER) AS "partition",
    event_id AS "offset",
    printf('P%06d', user_id) AS pid,
    CASE WHEN event_id % 31 <> 0 THEN 'name-' || CASE WHEN topic = 'pg.public.product_b' THEN 'b-' ELSE '' END || event_id END AS pname,
    CASE WHEN event_id % 29 = 0 THEN 'Free'
         WHEN user_id % 3 = 0 THEN 'Linear' WHEN user_id % 3 = 1 THEN 'SVOD' ELSE 'TVOD' END AS ptype,
    CASE WHEN event_id % 5 <> 0 THEN props END AS pdesc,
    CASE WHEN event_id % 67 <> 1 THEN 1704067200000000 END AS created,
    CASE WHEN event_id % 37 <> 0 THEN epoch_us(ts) END AS updated,
    CASE WHEN event_id % 4000 = 700 THEN 't' WHEN event_id % 17 = 0 THEN 'r'
         WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
    epoch_us(ts) // 1000 AS ms,
    CASE event_id % 47 WHEN 5 THEN 'partner' WHEN 6 THEN 'region' ELSE 'product' END AS src_table,
    CASE WHEN event_id % 53 = 1 THEN 'null_value' WHEN event_id % 53 IN (2, 3) OR event_id % 41 = 40 THEN 'bad_json'
         WHEN event_id % 53 = 4 OR event_id % 43 = 42 THEN 'missing_key' END AS reason
  FROM messages
),
feed AS (
  SELECT *, CASE WHEN op = 't' THEN 1706616000000 WHEN "offset" % 59 = 1 THEN NULL
                 WHEN "offset" % 9 = 4 THEN ms // 86400000 * 86400000 ELSE ms END AS ts_ms
  FROM parts
),
delivered AS (
  SELECT * FROM feed UNION ALL SELECT * FROM feed WHERE "offset" % 13 = 0
),
routed AS (SELECT * FROM delivered WHERE reason IS NULL),
landed AS (SELECT * FROM routed WHERE src_table = 'product'),
projected_strict AS (
  SELECT
    CASE WHEN op NOT IN ('d', 't') THEN pid END AS product_id,
    CASE WHEN op NOT IN ('d', 't') THEN pname END AS product_name,
    CASE WHEN op NOT IN ('d', 't') THEN ptype END AS product_type,
    CASE WHEN op NOT IN ('d', 't') THEN pdesc END AS description,
    CASE WHEN op NOT IN ('d', 't') THEN created END AS created_us,
    CASE WHEN op NOT IN ('d', 't') THEN updated END AS updated_us,
    op, ts_ms, topic, "partition", "offset", pid
  FROM landed
),
projected_repaired AS (
  SELECT * REPLACE (CASE WHEN op <> 't' THEN pid END AS product_id) FROM projected_strict
),
clean_strict AS (
  SELECT * FROM projected_strict
  WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND product_type IN ('SVOD', 'Linear', 'TVOD')
    AND created_us IS NOT NULL AND updated_us IS NOT NULL AND op IN ('c', 'u', 'd', 't')
),
clean_repaired AS (
  SELECT * FROM projected_repaired WHERE op = 't' OR (op = 'd' AND product_id IS NOT NULL)
  UNION ALL
  SELECT * FROM clean_strict
),
newest_strict AS (
  SELECT * FROM clean_strict WHERE ts_ms IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ts_ms DESC, "offset" DESC, topic DESC) = 1
),
newest_repaired AS (
  SELECT * FROM clean_repaired WHERE op <> 't' AND ts_ms IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ts_ms DESC, "offset" DESC, topic DESC) = 1
),
cut AS (SELECT max(ts_ms) AS cut_ms FROM clean_repaired WHERE op = 't'),
current_repaired AS (
  SELECT n.* FROM newest_repaired n, cut WHERE op <> 'd' AND (cut_ms IS NULL OR ts_ms > cut_ms)
),
versions_strict AS (
  SELECT *, lead(ts_ms) OVER (PARTITION BY product_id ORDER BY ts_ms) AS valid_to FROM (
    SELECT * FROM clean_strict WHERE ts_ms IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY product_id, ts_ms ORDER BY "offset" DESC, topic DESC) = 1)
),
versions_repaired AS (
  SELECT *, lead(ts_ms) OVER (PARTITION BY product_id ORDER BY ts_ms) AS valid_to FROM (
    SELECT * FROM clean_repaired WHERE op <> 't' AND ts_ms IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY product_id, ts_ms ORDER BY "offset" DESC, topic DESC) = 1)
)
"""

_COLUMNS = "product_id, product_name, product_type, description, created_us, updated_us"
_CLEAN = f'{_COLUMNS}, op, ts_ms, topic, "partition", "offset"'
_VERSIONS = f"{_COLUMNS}, ts_ms AS valid_from, valid_to"
_HISTORY_REPAIRED = f"SELECT {_VERSIONS} FROM versions_repaired WHERE op <> 'd'"
_DELIVERY = """topic || '-' || "partition" || '-' || "offset" AS delivery_id"""
_PRODUCTS_REPAIRED = f"SELECT {_COLUMNS} FROM current_repaired"


def _failing(rule: str, column: str) -> str:
    return f'SELECT "partition", "offset", {column} FROM projected_strict WHERE NOT coalesce({rule}, false)'


# The rules a clean change has to meet.
_STRICT_CHECKS = {
    "valid_product_id": "product_id IS NOT NULL",
    "valid_product_name": "product_name IS NOT NULL",
    "valid_product_type": "product_type IN ('SVOD', 'Linear', 'TVOD')",
    "valid_created_at": "created_us IS NOT NULL",
    "valid_updated_at": "updated_us IS NOT NULL",
    "valid_op": "op IN ('c', 'u', 'd', 't')",
}

_SELECTS = {
    "p1_envelope_fields": """
        SELECT topic, "partition", "offset", 'struct' AS schema_type, op, ts_ms FROM routed""",
    "p2_routing_fields": """
        SELECT "partition", "offset", 'pg' AS src_catalog, 'public' AS src_schema, src_table FROM routed""",
    "p3_message_names": """
        SELECT 'offset_' || "offset" AS message_id, 'pg_public_' || src_table || '_offset_' || "offset" || '.json' AS landing_name,
          'pg/public/' || src_table || '/' AS landing_dir, topic || '-' || "partition" || '-' || "offset" AS delivery_id FROM routed""",
    "p4_opaque_members": """
        SELECT "partition", "offset", '{"type":"struct"}' AS schema_text, op AS payload_op,
          CASE WHEN op = 'd' THEN '{"product_id":"' || pid || '"}' END AS payload_before FROM routed""",
    "p5_parse_payload": """
        SELECT "partition", "offset", product_id, product_name, op, ts_ms,
          CASE WHEN product_id IS NOT NULL THEN coalesce(strftime(make_timestamp(created_us), '%Y-%m-%dT%H:%M:%S.%fZ'), 'nonsense') END AS created_text
          FROM projected_strict""",
    "p6_clean_projection": f"SELECT {_CLEAN} FROM projected_strict",
    "p7_parse_timestamps": """
        SELECT "partition", "offset", created_us, updated_us FROM projected_strict""",
    "p8_drop_bookkeeping": f"SELECT {_COLUMNS} FROM clean_strict",
    "p9_conform_products": f"SELECT {_COLUMNS} FROM newest_strict",
    "f1_valid_product_id": _failing(_STRICT_CHECKS["valid_product_id"], "product_id"),
    "f2_valid_product_name": _failing(_STRICT_CHECKS["valid_product_name"], "product_name"),
    "f3_valid_product_type": _failing(_STRICT_CHECKS["valid_product_type"], "product_type"),
    "f4_valid_created_at": _failing(_STRICT_CHECKS["valid_created_at"], "created_us"),
    "f5_valid_updated_at": _failing(_STRICT_CHECKS["valid_updated_at"], "updated_us"),
    "f6_valid_op": _failing(_STRICT_CHECKS["valid_op"], "op"),
    "f7_expect_all_or_drop": f"SELECT {_CLEAN} FROM clean_strict",
    "f7_expect_all_or_drop_repaired": f"SELECT {_CLEAN} FROM clean_repaired",
    "f8_expectation_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({check}, false)) AS failed FROM projected_strict"
        for name, check in _STRICT_CHECKS.items()
    ),
    "f9_quarantine": f'SELECT {_DELIVERY}, topic, "partition", "offset", reason FROM delivered WHERE reason IS NOT NULL',
    "c1_scd1_strict": f"SELECT {_COLUMNS} FROM newest_strict",
    "c1_scd1_repaired": _PRODUCTS_REPAIRED,
    "c2_newest_change": 'SELECT product_id, op, ts_ms, topic, "partition", "offset" FROM newest_repaired',
    "c3_deleted_keys": "SELECT product_id, ts_ms FROM newest_repaired WHERE op = 'd'",
    "c4_truncate_cut": """
        SELECT product_id, op, ts_ms FROM newest_repaired, cut WHERE ts_ms > cut_ms""",
    "c5_nulls_overwrite": "SELECT product_id, description FROM current_repaired WHERE description IS NULL",
    "c6_scd2_strict": f"SELECT {_VERSIONS} FROM versions_strict",
    "c7_scd2_repaired": _HISTORY_REPAIRED,
    "c8_history_ignores_truncate": """
        SELECT product_id, ts_ms AS valid_from FROM versions_repaired, cut
        WHERE op <> 'd' AND ts_ms <= cut_ms""",
    "c9_dedup_delivery": 'SELECT topic, "partition", "offset" FROM feed',
    "c10_constraint_violations": """
        SELECT 'primary_key' AS violation, product_id, count(*) AS n FROM projected_strict
          WHERE product_id IS NOT NULL GROUP BY product_id HAVING count(*) > 1
        UNION ALL SELECT 'not_null:product_id', product_id, count(*) FROM projected_strict
          WHERE product_id IS NULL GROUP BY product_id
        UNION ALL SELECT 'not_null:product_name', product_id, count(*) FROM projected_strict
          WHERE product_name IS NULL GROUP BY product_id
        UNION ALL SELECT 'not_null:product_type', product_id, count(*) FROM projected_strict
          WHERE product_type IS NULL GROUP BY product_id""",
    "c11_two_column_key": f"""
        SELECT {_COLUMNS}, "partition" FROM clean_strict WHERE ts_ms IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY product_id, "partition" ORDER BY ts_ms DESC, "offset" DESC, topic DESC) = 1""",
    "c11_two_column_history": f"""
        SELECT {_COLUMNS}, "partition", ts_ms AS valid_from,
          lead(ts_ms) OVER (PARTITION BY product_id, "partition" ORDER BY ts_ms) AS valid_to FROM (
            SELECT * FROM clean_strict WHERE ts_ms IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY product_id, "partition", ts_ms ORDER BY "offset" DESC, topic DESC) = 1)""",
    "s2_landing_counts": """
        SELECT CASE WHEN reason IS NULL THEN 'landed' ELSE 'quarantined' END AS status,
          CASE WHEN reason IS NULL THEN 'pg' END AS src_catalog, CASE WHEN reason IS NULL THEN 'public' END AS src_schema,
          CASE WHEN reason IS NULL THEN src_table END AS src_table, reason, count(*) AS n
        FROM delivered GROUP BY ALL""",
    "s3_bronze_stream": 'SELECT topic, "partition", "offset", op AS payload_op FROM landed',
    "s3_one_per_file": 'SELECT DISTINCT topic, "partition", "offset", op AS payload_op FROM landed',
    "s5_table_stream": 'SELECT "partition", "offset" FROM landed',
    "s6_clean_stream": f"SELECT {_CLEAN} FROM clean_strict",
    "c6_timestamp_sequence": f"""
        SELECT {_COLUMNS}, 1000 * ts_ms AS valid_from_us, 1000 * valid_to AS valid_to_us FROM versions_strict""",
    "c9_stream_identity": 'SELECT DISTINCT topic, "partition", "offset" FROM landed',
    "c9_stream_ledger": """
        SELECT topic, "partition", 'seen' AS kind, min(o) AS first, max(o) AS last, CAST(NULL AS BIGINT) AS n FROM (
          SELECT topic, "partition", o, o - row_number() OVER (PARTITION BY topic, "partition" ORDER BY o) AS run
          FROM (SELECT DISTINCT topic, "partition", "offset" // 4 AS o FROM landed)) GROUP BY topic, "partition", run
        UNION ALL
        SELECT topic, "partition", 'missing', o + 1, following - 1, NULL FROM (
          SELECT topic, "partition", o, lead(o) OVER (PARTITION BY topic, "partition" ORDER BY o) AS following
          FROM (SELECT DISTINCT topic, "partition", "offset" // 4 AS o FROM landed)) WHERE following > o + 1
        UNION ALL
        SELECT topic, "partition", 'repeated', NULL, NULL, count(*) - count(DISTINCT "offset") FROM landed GROUP BY topic, "partition" """,
    "c10_target_constraints": """
        SELECT 'not_null:description' AS violation, product_id, count(*) AS n FROM current_repaired
        WHERE description IS NULL GROUP BY product_id""",
    "f8_stream_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({check}, false)) AS failed FROM projected_strict"
        for name, check in _STRICT_CHECKS.items()
    ),
    "x8_rejects": f"""
        SELECT {_DELIVERY}, product_id, op, topic, "partition", "offset", 'null_sequence' AS reason FROM clean_repaired WHERE ts_ms IS NULL""",
    "t4_products_by_name": _PRODUCTS_REPAIRED,
    "c1_state_store": _PRODUCTS_REPAIRED,
    "t1_refresh_products": _PRODUCTS_REPAIRED,
    "t1_refresh_history": _HISTORY_REPAIRED,
}

ORACLE = {name: f"{_FEED} {select}" for name, select in _SELECTS.items()}
