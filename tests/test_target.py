import random
from dataclasses import replace
from pathlib import Path

import brute
import pytest
from test_apply import CURRENT, SCHEMA, VERSIONS, random_events

from changefold import Target, read_target, read_violations
from changefold.operators.apply_changes import DELETED
from changefold.streaming.target import PART, check_buckets, declare, merge_batch

ERAS = replace(VERSIONS, era="floor(seq / 7)")
SPECS = {"current": (CURRENT, brute.current), "history": (VERSIONS, brute.history), "eras": (ERAS, brute.history)}


@pytest.fixture
def target(spark, tmp_path, request):
    def make(spec, buckets=4):
        name = f"default.t_{abs(hash(str(tmp_path))):x}_{spec.scd_type}"
        return Target(name, str(tmp_path / "t"), spec, SCHEMA, buckets)

    return make


def apply_batches(spark, target, batches, first=0):
    declare(spark, target)
    for number, events in enumerate(batches, first):
        merge_batch(spark.createDataFrame(events, SCHEMA), number, target)


def content(spark, target):
    rows = [tuple(r) for r in read_target(spark, target).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def in_batches(events, n, seed):
    rnd = random.Random(seed)
    shuffled = events + rnd.sample(events, len(events) // 4)
    rnd.shuffle(shuffled)
    return [part for part in (shuffled[i::n] for i in range(n)) if part]


@pytest.mark.parametrize("name", SPECS)
@pytest.mark.parametrize("buckets", [1, 5])
def test_batches_in_any_order_give_the_batch_result(spark, target, name, buckets):
    spec, expected = SPECS[name]
    events = random_events(buckets, 300, 25, 40, truncates=2)
    made = target(spec, buckets)
    apply_batches(spark, made, in_batches(events, 4, 1))
    assert content(spark, made) == expected(events)


@pytest.mark.parametrize("name", SPECS)
def test_late_changes_of_all_kinds(spark, target, name):
    spec, expected = SPECS[name]
    events = random_events(3, 300, 25, 40, truncates=1)
    late = [("k1", 20, 900, "u", "late"), ("k2", 99, 901, "d", None), ("new", 3, 902, "c", "n"), (None, 15, 903, "t", None)]
    made = target(spec)
    apply_batches(spark, made, [events, late])
    assert content(spark, made) == expected(events + late)


@pytest.mark.parametrize("name", SPECS)
def test_a_repeated_batch_changes_nothing(spark, target, name):
    spec, expected = SPECS[name]
    events = random_events(4, 120, 10, 30, truncates=1)
    made, halves = target(spec), in_batches(events, 2, 2)
    apply_batches(spark, made, halves)
    apply_batches(spark, made, halves, first=0)
    assert content(spark, made) == expected(events)


@pytest.mark.parametrize("name", SPECS)
def test_a_hot_key_and_a_hot_group_of_copies(spark, target, name):
    spec, expected = SPECS[name]
    hot = [("hot", i % 90, i, "u", str(i)) for i in range(400)]
    copies = [("copied", 5, 500, "c", "same")] * 300
    events = hot + copies + random_events(9, 100, 10, 30)
    made = target(spec)
    apply_batches(spark, made, [events[::2], events[1::2]])
    assert content(spark, made) == expected(events)


def files(target, table="state"):
    return {str(f): f.stat().st_mtime_ns for f in Path(target.path, table).rglob("*.parquet")}


def test_a_batch_writes_the_buckets_it_touches_and_one_file_for_each(spark, target):
    made = target(VERSIONS, 16)
    apply_batches(spark, made, [[(f"k{i}", i, i, "c", "x") for i in range(400)]])
    before = files(made)
    assert len(before) == 16
    apply_batches(spark, made, [[("k1", 999, 999, "u", "y")]], first=1)
    after = files(made)
    assert len(after) == 16 and len(set(after.items()) - set(before.items())) == 1
    apply_batches(spark, made, [[]], first=2)
    assert files(made) == after


def test_an_empty_batch_and_an_empty_target(spark, target):
    made = target(VERSIONS)
    assert read_target(spark, made).collect() == []
    apply_batches(spark, made, [[]])
    assert content(spark, made) == set()


@pytest.mark.parametrize("name", SPECS)
def test_a_session_that_does_not_know_the_tables_finds_them_in_their_folder(spark, target, name):
    spec, expected = SPECS[name]
    events = random_events(5, 100, 10, 30)
    made = target(spec)
    apply_batches(spark, made, [events])
    for table in (made.name, made.upkeep, made.rejects):
        spark.sql(f"DROP TABLE {table}")
    assert content(spark, made) == expected(events)
    apply_batches(spark, made, [[("k1", 70, 990, "u", "z")]], first=1)
    assert content(spark, made) == expected([*events, ("k1", 70, 990, "u", "z")])


def test_a_lost_bucket_is_noticed(spark, target):
    made = target(CURRENT)
    apply_batches(spark, made, [[(f"k{i}", i, i, "c", "x") for i in range(50)]])
    check_buckets(spark, made)
    bucket = spark.table(made.name).select(PART).first()[0]
    spark.sql(f"ALTER TABLE {made.name} DROP PARTITION ({PART} = {bucket})")
    with pytest.raises(ValueError, match="lost rows"):
        check_buckets(spark, made)


def test_c10_violations_follow_the_keys_that_a_batch_touches(spark, target):
    made = target(replace(CURRENT, required=("v",)))

    def violations():
        return {tuple(r) for r in read_violations(spark, made).collect()}

    apply_batches(spark, made, [[("a", 1, 1, "c", None), ("b", 1, 2, "c", "x"), ("c", 9, 3, "c", None), ("d", 1, 4, "d", None)]])
    assert violations() == {("not_null:v", "a", 1), ("not_null:v", "c", 1)}
    before = files(made, "upkeep")
    apply_batches(spark, made, [[("a", 2, 5, "u", "mended")]], first=1)
    assert violations() == {("not_null:v", "c", 1)}
    touched = {r[0] for r in spark.table(made.name).where("k = 'a'").select(PART).collect()}
    changed = {f for f, at in files(made, "upkeep").items() if before.get(f) != at}
    assert all(f"{PART}={bucket}/" in f for f in changed for bucket in touched)
    apply_batches(spark, made, [[("b", 3, 6, "u", None)]], first=2)
    assert violations() == {("not_null:v", "c", 1), ("not_null:v", "b", 1)}
    apply_batches(spark, made, [[(None, 5, 7, "t", None)]], first=3)  # cuts b, in whatever bucket it is
    assert violations() == {("not_null:v", "c", 1)}


def test_tombstones_stay_in_the_state(spark, target):
    made = target(CURRENT)
    apply_batches(spark, made, [[("a", 5, 1, "d", None)], [("a", 4, 2, "u", "late")]])
    assert content(spark, made) == set()
    assert spark.table(made.name).where(DELETED).count() == 1
