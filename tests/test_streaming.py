import json
import os
import random
import time
from pathlib import Path
from unittest.mock import MagicMock

import pytest
from messages import TOPIC, as_messages, change

from changefold import (
    bronze_flow,
    clean_flow,
    create_target_views,
    read_change_topic,
    read_landing,
    read_quarantine,
    read_table_stream,
    read_target,
    run_refresh,
    triage,
    write_landing,
)
from changefold.functions.decode import BRONZE_SCHEMA, CLEAN_SCHEMA, LINEAGE_SCHEMA, PRODUCTS_SCHEMA, schema_of
from changefold.sources.landing import write_one_per_file
from changefold.sources.topic import MESSAGE_SCHEMA, topic_options
from changefold.functions.quality import STRICT_RULES
from changefold.streaming.flows import apply_changes_stream, expectation_counts, read_clean, read_failed
from changefold.streaming.refresh import PRODUCTS, await_all, targets_of
from changefold.streaming.target import Target, read_rejects

ROUTE = ("pg", "public", "product")


def bronze_of(spark, arrivals, root):
    bronze_flow(arrivals, f"{root}/bronze", f"{root}/cp").awaitTermination()
    return spark.read.schema(BRONZE_SCHEMA).parquet(f"{root}/bronze").collect()


def test_s1_topic_options():
    options = topic_options("broker:9092", "a, b,")
    assert options == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "a,b", "startingOffsets": "earliest"}
    assert topic_options("b:1", ["x", "y"])["subscribe"] == "x,y"
    for topics in ("", " , ", []):
        with pytest.raises(ValueError):
            topic_options("broker:9092", topics)
    with pytest.raises(ValueError):
        topic_options("", "a")
    session = MagicMock()
    read_change_topic(session, "broker:9092", "a", maxOffsetsPerTrigger="1000")
    reader = session.readStream.format
    reader.assert_called_once_with("kafka")
    reader.return_value.options.assert_called_once_with(**topic_options("broker:9092", "a"), maxOffsetsPerTrigger="1000")


@pytest.fixture
def pretty(tmp_path):
    """Three indented files of one message each, named by offset."""
    folder = tmp_path / "pretty"
    folder.mkdir()
    for offset in (41, 42, 43):
        name = f"pg_public_product_offset_{offset}.json"
        (folder / name).write_text(json.dumps(change(key=f"P{offset}", seq=offset), indent=4))
    return str(folder)


@pytest.fixture
def ten_lines(tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    rows = [{"payload": json.dumps(change()["payload"]), "partition": 0, "offset": i} for i in range(10)]
    (folder / "part-0.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


def test_s3_one_message_per_file(spark, pretty, tmp_path):
    rows = bronze_of(spark, read_landing(spark, pretty, "one_per_file"), tmp_path)
    assert sorted(r["offset"] for r in rows) == [41, 42, 43]
    assert all(json.loads(r["payload"])["after"]["product_id"] == f"P{r['offset']}" for r in rows)
    assert all(json.loads(r["schema"]) == {"type": "struct"} for r in rows)


def test_s3_one_document_per_file_as_spark_writes_them(spark, tmp_path):
    messages = as_messages(spark, [change(key="P1"), change(key="é\n", seq=None), change(key="P1")])
    good, _ = triage(messages.unionByName(messages))
    write_one_per_file(good, f"{tmp_path}/files")
    files = list((tmp_path / "files").glob("*.txt"))
    assert len(files) == 3 and all(f.read_text().count("\n") > 5 for f in files)
    rows = bronze_of(spark, read_landing(spark, f"{tmp_path}/files", "one_per_file"), tmp_path)
    assert sorted((r["topic"], r["partition"], r["offset"]) for r in rows) == [(TOPIC, 0, i) for i in range(3)]
    assert {r["offset"]: json.loads(r["payload"])["after"]["product_id"] for r in rows} == {0: "P1", 1: "é\n", 2: "P1"}


def test_s3_files_are_named_by_their_delivery(spark, tmp_path):
    """So a task that runs again makes the same files, and each costs the disk one file."""
    text = '{"a": 1}'
    rows = [(text, text, topic, partition, offset) for topic in ("t/../x", "null", None) for partition in (0, None) for offset in (-1, 7, None)]
    routed = spark.createDataFrame(rows + rows, BRONZE_SCHEMA)
    for folder in ("a b", "again"):
        write_one_per_file(routed, f"{tmp_path}/{folder}")
    names = [sorted(f.name for f in (tmp_path / folder).iterdir() if not f.name.endswith("SUCCESS.crc")) for folder in ("a b", "again")]
    assert names[0] == names[1] and len(names[0]) == len(rows) + 1  # and Spark's mark of a whole write
    read = bronze_of(spark, read_landing(spark, f"{tmp_path}/a b", "one_per_file"), tmp_path)
    assert {(r["topic"], r["partition"], r["offset"]) for r in read} == {row[2:] for row in rows} and len(read) == len(rows)
    with pytest.raises(Exception, match="already exists"):
        write_one_per_file(routed, f"{tmp_path}/again")
    write_one_per_file(routed.limit(0), f"{tmp_path}/none")
    assert bronze_of(spark, read_landing(spark, f"{tmp_path}/none", "one_per_file"), tmp_path / "n") == []


def test_s3_where_tasks_share_no_disk_spark_writes_the_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("changefold.sources.landing._local", lambda path: f"{path}/elsewhere")
    good, _ = triage(as_messages(spark, [change(key="P1"), change(key="P2")]))
    write_one_per_file(good, f"{tmp_path}/files")
    assert len(list((tmp_path / "files").glob("part-*.txt"))) == 2
    rows = bronze_of(spark, read_landing(spark, f"{tmp_path}/files", "one_per_file"), tmp_path)
    assert sorted(r["offset"] for r in rows) == [0, 1]


def entries_of(checkpoint):
    """Files that a stream's driver has taken, by its source's log."""
    logs = [log for log in Path(checkpoint, "sources", "0").iterdir() if log.name.isdigit()]
    return sum(len(log.read_text().splitlines()) - 1 for log in logs)


def test_s3_a_listing_stands_for_many_files(spark, tmp_path, monkeypatch):
    """The driver takes files of names in place of the files, and each message once, however often the folder is read."""
    monkeypatch.setattr("changefold.sources.landing.LISTED", 20)
    values = [change(key=f"P{i}") for i in range(90)]
    good, _ = triage(as_messages(spark, values))
    write_one_per_file(good, f"{tmp_path}/files")
    (tmp_path / "files" / ".begun").write_text("{")

    def read():
        return bronze_of(spark, read_landing(spark, f"{tmp_path}/files", "one_per_file", listing=f"{tmp_path}/listing"), tmp_path)

    rows = read()
    assert sorted(r["offset"] for r in rows) == list(range(90))
    assert all(json.loads(r["payload"])["after"]["product_id"] == f"P{r['offset']}" for r in rows)
    first = entries_of(tmp_path / "cp")
    assert first <= 90 // 20 + 9  # whole ones, the listing's start, and a rest of each of up to eight tasks
    late = tmp_path / "files" / "pg_public_product_offset_100.json"
    late.write_text(json.dumps(change(key="P100"), indent=4))
    os.utime(late, (0, 0))  # however old it is
    assert sorted(r["offset"] for r in read()) == [*range(90), 100]
    assert entries_of(tmp_path / "cp") == first + 1
    assert len(read()) == 91 and entries_of(tmp_path / "cp") == first + 1
    for unfit in ({"layout": "lines"}, {"route": ROUTE}, {"cleanSource": "archive"}):
        with pytest.raises(ValueError):
            read_landing(spark, f"{tmp_path}/files", **{"layout": "one_per_file", "listing": f"{tmp_path}/other", **unfit})


def test_s3_the_query_reads_by_a_listing(spark, tmp_path, monkeypatch):
    from changefold.plans import catalog

    events = [(i, f"2024-01-0{1 + i % 9} 00:00:00", i % 7, "click", 1.0, "{}") for i in range(200)]
    table = spark.createDataFrame(events, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    table.selectExpr("event_id", "to_timestamp_ntz(ts) AS ts", "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "work_dir", lambda spark, label: f"{tmp_path}/{label}")
    rows = catalog.s3_one_per_file(spark, str(tmp_path)).collect()
    files = len(list((tmp_path / "s3" / "files").glob("*.txt")))
    assert len(rows) == len(set(rows)) == files > 100
    assert entries_of(tmp_path / "s3" / "cp" / "bronze") < 20


def test_s3_listed_files_give_the_rows_of_sparks_reader(spark, tmp_path):
    """Members as they are written, bad documents as nulls with the offset of the name, each object of an array, nothing of nothing."""
    documents = [
        b'{\n  "schema" : {"n": 1.10, "x" : 1e3},\n "payload": {"a" :  [1, 2 ,"}"], "b\\"": "x\\\\"} ,"topic":"t","partition":3}',
        b'{"payload": "text \\n {", "schema": null, "offset": 77}', b"", b" \n\t", b"[]", b"[ ] x",
        b'[{"payload": {"a": 1.50}}, {"payload":  [1 , 2]}]', b"{oops", b'{"payload": {"a": 1}', b'{"payload": {"a": 1 }} x {',
        b'{"payload": 5.10, "schema": true, "topic": 12345678901234567890.123456789012}', b'{"payload": {"a": 1 }, "offset": "abc"}',
        b"{'payload': {'a' : 'it\"s'}, \"schema\": 'x'}", b"null", b"5", b'[null, {"payload": {"a": 2 }}]', b'[1, {"payload": 2}]',
        b'\xef\xbb\xbf{"payload": {"a": 3 }}', b'{"payload": {"a": "\xff" }}', b'{"payload": {"a": 1 }}\xff', b"\xff",
        b'{"payload": {"a": 1 }, "payload": {"a" : 2}}', b'{"payload": {"a": 1 }, "payload": "s"}', b'{"payload": {"a" : 2}, "payload": null}',
        b'{"pay\\u006coad": {"a" :  2}, "other": {"payload": {"z" : 1}}}', '{"schema": {"k" : "é😀"}, "payload": {"é" : "日本"}}'.encode(),
        b'{"payload": {"a": 1,}}', b"{}", b'{"Payload": 1, "payload": {}}', b'[{"payload": {"a": 1 }}, {"payload": {"a": 2 }', b'{"payload": 1 2}',
        b'{"payload": , "schema": {"a": 1 }}', b'{"schema": "a", "payload": {"x" : {"payload" : [ ]}}, "partition": "7", "offset": null}',
    ]
    (tmp_path / "files").mkdir()
    names = [f"offset_{i}.json" for i in range(len(documents))]
    others = {"é %20 x.json": b'{"payload": {"a" : 1}}', "_hidden.json": b"{}", ".hidden.json": b"{}", "x._COPYING_": b"{}"}
    for name, document in [*zip(names, documents), *others.items()]:
        (tmp_path / "files" / name).write_bytes(document)
    found = [
        sorted(map(repr, bronze_of(spark, read_landing(spark, f"{tmp_path}/files", "one_per_file", listing=listing), tmp_path / label)))
        for label, listing in (("spark", None), ("listed", f"{tmp_path}/listing"))
    ]
    assert found[0] == found[1] and len(found[0]) == len(documents) - 4 + 1 + 1


def test_s3_one_message_per_line(spark, ten_lines, tmp_path):
    rows = bronze_of(spark, read_landing(spark, ten_lines, "lines"), tmp_path)
    assert sorted(r["offset"] for r in rows) == list(range(10))


def test_x1_the_wrong_layout_shows_in_the_counts(spark, pretty, ten_lines, tmp_path):
    torn = bronze_of(spark, read_landing(spark, pretty, "lines"), tmp_path / "a")
    assert len(torn) > 3 and all(r["payload"] is None for r in torn)
    assert len(bronze_of(spark, read_landing(spark, ten_lines, "one_per_file"), tmp_path / "b")) == 1
    with pytest.raises(ValueError):
        read_landing(spark, pretty, "guess")


def land(spark, messages, root):
    """Append messages to the stand-in topic and move what is new into the landing zone."""
    messages.write.mode("append").parquet(f"{root}/topic")
    arrivals = spark.readStream.schema(MESSAGE_SCHEMA).parquet(f"{root}/topic")
    query = write_landing(arrivals, f"{root}/landing", f"{root}/cp_landing")
    query.awaitTermination()
    return query


def test_s2_landing_does_not_sort_its_messages(spark, tmp_path):
    """A sort holds all messages of a task, so its memory grows with the topic's files."""
    land(spark, as_messages(spark, [change(), change(table="other"), "{oops"]), str(tmp_path))
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", 2)
    try:
        more = [change(table=f"t{i % 7}") for i in range(70)]  # more folders than files may be open
        land(spark, as_messages(spark, more), f"{tmp_path}/many")
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 2
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    landed = spark.read.json(f"{tmp_path}/many/landing").groupBy("src_table").count().collect()
    assert {tuple(r) for r in landed} == {(f"t{i}", 10) for i in range(7)}


def test_s2_f9_x6_landing_by_origin_and_quarantine(spark, tmp_path):
    root = str(tmp_path)
    land(spark, as_messages(spark, ["{oops", change(), change(table="other"), None, change(table=None)]), root)
    table = tmp_path / "landing" / "status=landed" / "src_catalog=pg" / "src_schema=public" / "src_table=product"
    assert sum(len(f.read_text().splitlines()) for f in table.glob("*.json")) == 1
    rows = bronze_of(spark, read_landing(spark, f"{root}/landing", "lines", ROUTE), root)
    assert [r["offset"] for r in rows] == [1]
    aside = {(r["offset"], r["reason"], r["value"] and bytes(r["value"])) for r in read_quarantine(spark, f"{root}/landing").collect()}
    assert {a[:2] for a in aside} == {(0, "bad_json"), (3, "null_value"), (4, "missing_key")}
    assert (0, "bad_json", b"{oops") in aside and (3, "null_value", None) in aside
    assert {r["topic"] for r in read_quarantine(spark, f"{root}/landing").collect()} == {TOPIC}
    assert {r["delivery_id"] for r in read_quarantine(spark, f"{root}/landing").collect()} == {f"{TOPIC}-0-{i}" for i in (0, 3, 4)}


def test_s4_s5_s6_tables_by_name(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS flows_test LOCATION '" + f"{root}/db" + "'")
    land(spark, as_messages(spark, [change(), change(product_type="svod")]), root)
    arrivals = read_landing(spark, f"{root}/landing", "lines", ROUTE)
    bronze_flow(arrivals, "flows_test.bronze", f"{root}/cp_b").awaitTermination()
    bronze = read_table_stream(spark, "flows_test.bronze", BRONZE_SCHEMA)
    clean_flow(bronze, "flows_test.clean", f"{root}/cp_c").awaitTermination()
    assert [r["product_type"] for r in read_clean(spark, "flows_test.clean").collect()] == ["SVOD"]
    assert [(r["product_type"], r["failed"]) for r in read_failed(spark, "flows_test.clean").collect()] == [("svod", 1 << 2)]
    counts = {r["rule"]: r["failed"] for r in expectation_counts(spark, "flows_test.clean", STRICT_RULES).collect()}
    assert counts["valid_product_type"] == 1 and counts["valid_op"] == 0
    spark.sql("DROP DATABASE flows_test CASCADE")


def feed(seed, n=250):
    rnd = random.Random(seed)
    values, events = [], []
    for offset in range(n):
        op, key, seq = rnd.choice("ccuuud" if offset % 80 else "t"), f"P{rnd.randrange(15)}", rnd.randrange(400)
        values.append(change(op, key, seq, description=f"d{offset}"))
        events.append((key, seq, offset, op, f"d{offset}"))
    return values, events


def outputs(spark, root):
    products, history = (read_target(spark, target) for target in targets_of(root))
    return (
        [(r["product_id"], r["description"]) for r in products.collect()],
        [(r["product_id"], r["description"], r["valid_from"], r["valid_to"]) for r in history.collect()],
    )


def test_t1_to_t5_refresh_runs_out_of_order_with_repeats(spark, tmp_path):
    import brute

    values, events = feed(1)
    root = str(tmp_path)
    messages = as_messages(spark, values)
    for wave in (2, 0, 1):
        part = messages.where(f"offset % 3 = {wave}")
        land(spark, part.unionByName(part.where("offset % 5 = 0")), root)
        run_refresh(spark, f"{root}/landing", f"{root}/tables", "lines", ROUTE, "repaired")
    run_refresh(spark, f"{root}/landing", f"{root}/tables", "lines", ROUTE, "repaired")  # nothing new
    products, history = outputs(spark, f"{root}/tables")
    assert len(products) == len(set(products)) and set(products) == brute.current(events)
    assert len(history) == len(set(history)) and set(history) == brute.history(events)


def test_t1_refresh_from_single_message_files_and_metrics(spark, pretty, tmp_path):
    root = str(tmp_path / "tables")
    metrics = run_refresh(spark, pretty, root, "one_per_file", landing_options={"maxFilesPerTrigger": 1})
    products, history = outputs(spark, root)
    assert sorted(k for k, _ in products) == ["P41", "P42", "P43"]
    assert sorted(h[0] for h in history) == ["P41", "P42", "P43"] and all(h[3] is None for h in history)
    assert set(metrics) == set(STRICT_RULES) and set(metrics.values()) == {0}


def test_t5_refresh_into_a_database_and_views_for_sql(spark, pretty, tmp_path):
    root = str(tmp_path / "tables")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS refresh_test LOCATION '{tmp_path}/db'")
    run_refresh(spark, pretty, root, "one_per_file", database="refresh_test")
    assert spark.table("refresh_test.products_cdc_bronze").count() == 3
    assert spark.table("refresh_test.products_cdc_clean").count() == 3
    run_refresh(spark, pretty, f"{root}/again", "one_per_file")
    create_target_views(spark, f"{root}/again")
    joined = spark.sql("SELECT p.product_id FROM products p JOIN products_history h USING (product_id) WHERE h.valid_to IS NULL")
    assert sorted(r[0] for r in joined.collect()) == ["P41", "P42", "P43"]
    spark.sql("DROP DATABASE refresh_test CASCADE")


def test_t2_stop_between_batches_and_go_on(spark, tmp_path):
    import brute

    values, events = feed(2, 120)
    root, path = str(tmp_path), str(tmp_path / "target")
    schema = f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}"
    clean = [
        (key, "n", "SVOD", v, None, None, op, seq, "t", 0, off) if op != "t" else (*[None] * 6, "t", seq, "t", 0, off)
        for key, seq, off, op, v in events
    ]
    for part in range(4):
        spark.createDataFrame(clean[part::4], schema).coalesce(1).write.mode("append").parquet(f"{root}/clean")

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/clean")

    target = Target("default.restart_test", path, PRODUCTS, schema, 4)
    first = apply_changes_stream(stream(), target, f"{root}/cp", available_now=False)
    while not first.lastProgress:
        time.sleep(0.1)
    first.stop()
    apply_changes_stream(stream(), target, f"{root}/cp").awaitTermination()
    before = [tuple(r) for r in read_target(spark, target).collect()]
    assert {(r[0], r[3]) for r in before} == brute.current(events)
    # the last batch again, as after a crash between its write and its commit
    last = max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.with_name(f".{last.name}.crc").rename(tmp_path / "checksum_undone")
    last.rename(tmp_path / "commit_undone")
    apply_changes_stream(stream(), target, f"{root}/cp").awaitTermination()
    assert sorted(map(str, before)) == sorted(str(tuple(r)) for r in read_target(spark, target).collect())


def test_t1_refresh_of_an_empty_landing_zone(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    root = str(tmp_path / "tables")
    for _ in range(2):
        assert set(run_refresh(spark, str(tmp_path / "landing"), root).values()) == {0}
    assert outputs(spark, root) == ([], [])


def test_f8_counts_of_more_batches_than_progress_is_kept_for(spark, tmp_path):
    root = str(tmp_path)
    land(spark, as_messages(spark, [change(key=f"P{i}", op="x") for i in range(8)]).repartition(8), root)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        one = {"maxFilesPerTrigger": 1}
        metrics = run_refresh(spark, f"{root}/landing", f"{root}/tables", "lines", ROUTE, landing_options=one, table_options=one)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert metrics["valid_op"] == 8 and metrics["valid_product_id"] == 0


def test_t3_a_file_of_any_age_is_read(spark, ten_lines, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    source = next(p for p in Path(ten_lines).glob("*.json"))
    (landing / "a.json").write_text(source.read_text())
    run_refresh(spark, str(landing), root, "lines")
    first = spark.read.parquet(f"{root}/products_cdc_bronze").count()
    (landing / "b.json").write_text(source.read_text())
    os.utime(landing / "b.json", (time.time() - 30 * 86_400,) * 2)
    run_refresh(spark, str(landing), root, "lines")
    assert spark.read.parquet(f"{root}/products_cdc_bronze").count() == 2 * first > 0


def test_x8_what_no_fold_can_place_is_kept_beside_the_target(spark, tmp_path):
    root = str(tmp_path)
    land(spark, as_messages(spark, [change(key="P1"), change(key="P2", seq=None), change("t", seq=None)]), root)
    run_refresh(spark, f"{root}/landing", f"{root}/tables", "lines", ROUTE, "repaired")
    for target in targets_of(f"{root}/tables"):
        rows = read_rejects(spark, target).orderBy("offset").collect()
        assert [(r["product_id"], r["op"], r["offset"], r["reason"]) for r in rows] == [
            ("P2", "c", 1, "null_sequence"),
            (None, "t", 2, "null_sequence"),
        ]
        assert [r["delivery_id"] for r in rows] == [f"{TOPIC}-0-1", f"{TOPIC}-0-2"]
    assert read_rejects(spark, targets_of(f"{root}/none")[0]).count() == 0


def test_t4_targets_by_name_in_every_session(spark, tmp_path):
    root = str(tmp_path)
    spark.sql(f"CREATE DATABASE names_test LOCATION '{root}/db'")
    for i in range(4):
        land(spark, as_messages(spark, [change(key=f"P{i}", seq=i)], start=i), root)
        run_refresh(spark, f"{root}/landing", f"{root}/tables", "lines", ROUTE, database="names_test")
        assert spark.table("names_test.products").count() == spark.table("names_test.products_history").count() == i + 1
        other = spark.newSession()
        assert other.table("names_test.products").count() == other.table("names_test.products_history").count() == i + 1
    assert other.table("names_test.products").schema.simpleString() == schema_of(PRODUCTS_SCHEMA).simpleString()
    assert other.table("names_test.products_violations").count() == 0
    spark.sql("DROP DATABASE names_test CASCADE")


def test_s7_where_one_flow_fails_the_other_does_not_go_on(spark, tmp_path):
    land(spark, as_messages(spark, [change()]), str(tmp_path))
    rows = read_landing(spark, f"{tmp_path}/landing", "lines", ROUTE)

    def fail(batch, number):
        raise RuntimeError("stop")

    bad = rows.writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_path}/bad").start()
    going = rows.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/going").start()
    with pytest.raises(Exception, match="stop"):
        await_all([bad, going])
    assert not going.isActive
