import json
from datetime import datetime

import pytest
from messages import as_messages, change
from pyspark.sql import functions as F

from changefold import add_message_ids, clean_projection, decode_messages, drop_redelivered, triage
from changefold.functions.decode import BRONZE_SCHEMA


def without(message, *path):
    inner = message
    for step in path[:-1]:
        inner = inner[step]
    del inner[path[-1]]
    return message


REASONS = [
    (change(), None),
    (None, "null_value"),
    ("", "bad_json"),
    ("   ", "bad_json"),
    ("{oops", "bad_json"),
    ('{"a": tru}', "bad_json"),
    ("{'payload': 1}", "bad_json"),
    (b'{"payload": "\xff\xfe"}', "bad_json"),
    ('{"a": 1} x', "bad_json"),
    ('{"a": 1}, {"b": 2}', "bad_json"),
    (json.dumps(change()) + "] x", "bad_json"),
    (json.dumps(change()) + "],[1", "bad_json"),
    ('{"a": 1}, {"b": 2}] x', "bad_json"),
    (json.dumps(change(table=5)), "missing_key"),
    (json.dumps(change(table={"q": 1})), "missing_key"),
    (json.dumps(change(seq=float("nan"))), None),
    ("null", "missing_key"),
    ("[1]", "missing_key"),
    ("5", "missing_key"),
    ('{"payload": "text"}', "missing_key"),
    ('{"payload": "{\\"source\\": {\\"name\\": \\"a\\", \\"schema\\": \\"b\\", \\"table\\": \\"c\\"}}"}', "missing_key"),
    (without(change(), "payload", "source", "table"), "missing_key"),
    (without(change(), "payload", "source"), "missing_key"),
    (without(change(), "payload"), "missing_key"),
    (change(table=None), "missing_key"),
    (without(change(), "schema"), None),
]


def test_f9_every_message_is_good_or_has_a_reason(spark):
    messages = as_messages(spark, [value for value, _ in REASONS])
    found = {r["offset"]: r["reason"] for r in decode_messages(messages).collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(REASONS)}


def test_f9_quarantine_keeps_a_failed_message_whole(spark):
    good, bad = triage(as_messages(spark, ["{oops", change()]))
    assert [r["offset"] for r in good.collect()] == [1]
    assert [(r["offset"], bytes(r["value"]), r["reason"]) for r in bad.collect()] == [(0, b"{oops", "bad_json")]


def test_p1_p4_members_stay_opaque_text(spark):
    text = '{"schema":{"b":1, "a":[1.5,9007199254740993]},"payload":{"source":{"name":"n","schema":"s","table":"t"}}}'
    row = triage(as_messages(spark, [text]))[0].first()
    assert row["schema"] == '{"b":1,"a":[1.5,9007199254740993]}'
    assert row["payload"] == '{"source":{"name":"n","schema":"s","table":"t"}}'
    assert (row["src_catalog"], row["src_schema"], row["src_table"]) == ("n", "s", "t")


def test_p3_x5_names_and_ids(spark):
    both = as_messages(spark, [change()], 0, 7).unionByName(as_messages(spark, [change()], 1, 7))
    rows = add_message_ids(triage(both)[0]).collect()
    assert {r["message_id"] for r in rows} == {"offset_7"}
    assert {r["landing_name"] for r in rows} == {"pg_public_product_offset_7.json"}
    assert {r["landing_dir"] for r in rows} == {"pg/public/product/"}
    assert {r["delivery_id"] for r in rows} == {"pg.public.product-0-7", "pg.public.product-1-7"}


def test_c9_repeats_are_one_delivery(spark):
    messages = as_messages(spark, [change(), change()])
    assert drop_redelivered(messages.unionByName(messages)).count() == 2


def projected(spark, values, mode="strict"):
    return clean_projection(triage(as_messages(spark, values))[0], mode).orderBy("offset").collect()


def test_p5_p6_p7_typed_row(spark):
    row = projected(spark, [change("u", "P9", 5, description="d", unknown="ignored")])[0]
    assert (row["product_id"], row["product_name"], row["product_type"], row["description"]) == ("P9", "name", "SVOD", "d")
    assert (row["op"], row["ts_ms"], row["partition"], row["offset"]) == ("u", 5, 0, 0)
    assert row["created_at"] == datetime.fromtimestamp(1704067200)


def test_x2_malformed_time_is_null(spark):
    row = projected(spark, [change(created_at="nonsense")])[0]
    assert row["created_at"] is None and row["updated_at"] is not None


def test_x3_key_of_a_delete_by_mode(spark):
    assert projected(spark, [change("d", "P9")])[0]["product_id"] is None
    assert projected(spark, [change("d", "P9")], "repaired")[0]["product_id"] == "P9"


def test_x9_payload_as_text_and_malformed_payload(spark):
    bronze = spark.createDataFrame(
        [("s", '{"op":"c","source":{"ts_ms":3}}', "t", 0, 1), ("s", "{oops", "t", 0, 2), ("s", None, "t", 0, 3)],
        BRONZE_SCHEMA,
    )
    rows = clean_projection(bronze).orderBy("offset").collect()
    assert [(r["op"], r["ts_ms"], r["product_id"]) for r in rows] == [("c", 3, None), (None, None, None), (None, None, None)]


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        clean_projection(spark.createDataFrame([("{}",)], "payload string"), "lenient")


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        clean = clean_projection(triage(as_messages(spark, [change()]))[0])
        assert clean.select(F.unix_micros("created_at")).first()[0] == 1704067200000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
