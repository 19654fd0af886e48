import random
from collections import Counter

import pytest

from changefold import Ledger, ledger_flow, read_missing, read_repeats, read_seen, unseen
from changefold.streaming.ledger import BLOCK, declare_ledger, merge_deliveries

SCHEMA = "topic string, partition int, offset bigint"


def ranges(offsets):
    out = []
    for offset in sorted(set(offsets)):
        if out and out[-1][1] + 1 == offset:
            out[-1][1] = offset
        else:
            out.append([offset, offset])
    return [tuple(r) for r in out]


def expected(deliveries):
    by_source = {}
    for topic, partition, offset in deliveries:
        by_source.setdefault((topic, partition), []).append(offset)
    seen = {(*s, *r) for s, offsets in by_source.items() for r in ranges(offsets)}
    missing = {(*s, a[1] + 1, b[0] - 1) for s, offsets in by_source.items() for a, b in zip(ranges(offsets), ranges(offsets)[1:])}
    repeats = {(*s, len(o), len(o) - len(set(o))) for s, o in by_source.items()}
    return seen, missing, repeats


def content(spark, ledger):
    return tuple({tuple(r) for r in read(spark, ledger).collect()} for read in (read_seen, read_missing, read_repeats))


@pytest.fixture
def ledger(tmp_path):
    return Ledger(f"default.l_{abs(hash(str(tmp_path))):x}", str(tmp_path / "ledger"))


def deliveries(seed=1):
    rnd = random.Random(seed)
    hot = [("a", 0, o) for o in range(BLOCK - 700, BLOCK + 700) if o % 97]
    rest = [(rnd.choice("ab"), rnd.randrange(3), rnd.randrange(400)) for _ in range(500)]
    return hot + rest + hot[100:200]


def test_c9_batches_in_any_order_with_repeats(spark, ledger):
    rows = deliveries()
    random.Random(2).shuffle(rows)
    declare_ledger(spark, ledger)
    for number in range(4):
        merge_deliveries(spark.createDataFrame(rows[number::4], SCHEMA), number, ledger)
    assert content(spark, ledger) == expected(rows)
    merge_deliveries(spark.createDataFrame(rows[3::4], SCHEMA), 3, ledger)  # the last batch again
    assert content(spark, ledger) == expected(rows)
    spark.sql(f"DROP TABLE {ledger.name}")  # a session that does not know it
    assert content(spark, ledger) == expected(rows)


def test_c9_only_touched_partitions_are_written(spark, ledger, tmp_path):
    declare_ledger(spark, ledger)
    merge_deliveries(spark.createDataFrame([("a", 0, 1), ("a", 1, 1), ("b", 0, 5)], SCHEMA), 0, ledger)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "ledger").rglob("*.parquet")}
    merge_deliveries(spark.createDataFrame([("a", 1, 2)], SCHEMA), 1, ledger)
    after = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "ledger").rglob("*.parquet")}
    assert all("topic=a/partition=1" in f for f in after if before.get(f) != after[f]) and len(after) == len(before)


def test_c9_no_identity_and_an_empty_batch(spark, ledger):
    declare_ledger(spark, ledger)
    merge_deliveries(spark.createDataFrame([], SCHEMA), 0, ledger)
    merge_deliveries(spark.createDataFrame([(None, 0, 1), ("a", None, 1), ("a", 0, None)], SCHEMA), 1, ledger)
    assert content(spark, ledger) == (set(), set(), set())


def test_c9_unseen_deliveries(spark, ledger):
    rows = deliveries(3)
    declare_ledger(spark, ledger)
    merge_deliveries(spark.createDataFrame(rows[:900], SCHEMA), 0, ledger)
    new = [*rows[700:], ("c", 9, 1), ("c", 9, 1), ("a", 0, 10 * BLOCK)]
    frame = spark.createDataFrame([(*r, "x") for r in new], f"{SCHEMA}, payload string")
    got = unseen(frame, ledger)
    assert got.columns == frame.columns
    assert Counter((r["topic"], r["partition"], r["offset"]) for r in got.collect()) == Counter(set(new) - set(rows[:900]))


def test_c9_x6_a_stream_with_skipped_offsets_and_a_restart(spark, ledger, tmp_path):
    rows = [("t", 0, o) for o in (*range(10), *range(14, 20), 3, 3)]
    for part in range(3):
        spark.createDataFrame(rows[part::3], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        ledger_flow(stream, ledger, f"{tmp_path}/cp").awaitTermination()

    run()
    assert content(spark, ledger) == ({("t", 0, 0, 9), ("t", 0, 14, 19)}, {("t", 0, 10, 13)}, {("t", 0, 18, 2)})
    last = max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.with_name(f".{last.name}.crc").rename(tmp_path / "checksum_undone")
    last.rename(tmp_path / "commit_undone")
    run()
    assert content(spark, ledger) == ({("t", 0, 0, 9), ("t", 0, 14, 19)}, {("t", 0, 10, 13)}, {("t", 0, 18, 2)})
    spark.createDataFrame([("t", 0, o) for o in range(10, 14)], SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert content(spark, ledger) == ({("t", 0, 0, 19)}, set(), {("t", 0, 22, 2)})
