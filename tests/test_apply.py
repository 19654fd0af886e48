import random
from dataclasses import replace

import brute
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changefold import ChangeSpec, apply_changes, rejected_changes
from changefold.operators.apply_changes import mark, present, to_state
from changefold.streaming.refresh import HISTORY, PRODUCTS

SCHEMA = "k string, seq bigint, off bigint, op string, v string"
CURRENT = ChangeSpec(
    keys=("k",),
    sequence_by="seq",
    tie_breaker=("off",),
    delete_when="op = 'd'",
    truncate_when="op = 't'",
    except_columns=("op", "seq", "off"),
)
VERSIONS = replace(CURRENT, truncate_when=None, ignore_when="op = 't'", scd_type=2)


def run(spark, events, spec):
    frame = spark.createDataFrame(events, SCHEMA)
    return [tuple(r) for r in present(to_state(mark(frame, spec), spec), spec).collect()]


def random_events(seed, n, keys, seqs, truncates=0):
    rnd = random.Random(seed)
    events = [
        (f"k{rnd.randrange(keys)}", rnd.randrange(seqs), i, rnd.choice("ccuuud"), rnd.choice(["a", "b", None]))
        for i in range(n)
    ]
    events += [(None, rnd.randrange(seqs), n + i, "t", None) for i in range(truncates)]
    return events


def case(*rows):
    return [(k, seq, off, op, v) for off, (k, seq, op, v) in enumerate(rows)]


CASES = {
    "upsert": (case(("a", 1, "c", "x"), ("a", 2, "u", "y")), {("a", "y")}, {("a", "x", 1, 2), ("a", "y", 2, None)}),
    "tie": (case(("a", 1, "u", "x"), ("a", 1, "u", "y")), {("a", "y")}, {("a", "y", 1, None)}),
    "late_middle": (
        case(("a", 1, "c", "x"), ("a", 3, "u", "z"), ("a", 2, "u", "y")),
        {("a", "z")},
        {("a", "x", 1, 2), ("a", "y", 2, 3), ("a", "z", 3, None)},
    ),
    "late_truncate": (
        case(("a", 1, "c", "x"), ("b", 5, "c", "y"), (None, 3, "t", None)),
        {("b", "y")},
        {("a", "x", 1, None), ("b", "y", 5, None)},
    ),
    "truncate_at_the_same_sequence": (case(("a", 3, "c", "x"), (None, 3, "t", None)), set(), {("a", "x", 3, None)}),
    "late_change_below_the_cut": (case((None, 9, "t", None), ("a", 4, "c", "x")), set(), {("a", "x", 4, None)}),
    "truncate_with_a_row_image": (
        case(("a", 1, "c", "x"), ("a", 2, "t", "z"), ("b", 3, "c", "y")),
        {("b", "y")},
        {("a", "x", 1, None), ("b", "y", 3, None)},
    ),
    "revive": (
        case(("a", 1, "c", "x"), ("a", 2, "d", None), ("a", 3, "c", "y")),
        {("a", "y")},
        {("a", "x", 1, 2), ("a", "y", 3, None)},
    ),
    "late_upsert_below_a_delete": (
        case(("a", 5, "d", None), ("a", 2, "u", "x")),
        set(),
        {("a", "x", 2, 5)},
    ),
    "null_overwrite": (
        case(("a", 1, "c", "x"), ("a", 2, "u", None)),
        {("a", None)},
        {("a", "x", 1, 2), ("a", None, 2, None)},
    ),
    "unchanged_versions_are_kept": (
        case(("a", 1, "c", "x"), ("a", 2, "u", "x")),
        {("a", "x")},
        {("a", "x", 1, 2), ("a", "x", 2, None)},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_hand_written_cases(spark, name):
    events, products, history = CASES[name]
    assert set(run(spark, events, CURRENT)) == products
    assert set(run(spark, events, VERSIONS)) == history


@pytest.mark.parametrize("seed", range(3))
def test_folds_match_brute_force_in_any_order_and_number(spark, seed):
    events = random_events(seed, 600, 40, 50, truncates=seed)
    shuffled = events + random.Random(seed).sample(events, 200)
    random.Random(seed + 1).shuffle(shuffled)
    for spec, expected in ((CURRENT, brute.current(events)), (VERSIONS, brute.history(events))):
        rows = run(spark, shuffled, spec)
        assert len(rows) == len(expected) and set(rows) == expected


@pytest.fixture
def many_ranges(spark):
    """Ranges stay as they are dealt, so that keys are cut by borders and ranges may be empty."""
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


@pytest.mark.parametrize("ranges", ["1", "2", "13", "60"])
def test_c6_borders_of_ranges_do_not_show(spark, many_ranges, ranges):
    events = random_events(5, 900, 3, 300) + [(f"cold{i}", 10 + i, 5000 + i, "c", "x") for i in range(20)]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        rows = run(spark, events, VERSIONS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    expected = brute.history(events)
    assert len(rows) == len(expected) and set(rows) == expected


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(20,3)", "double"])
def test_c6_takes_any_sequence_that_can_be_sorted(spark, many_ranges, kind):
    """Sequences as text with leading zeros, days, times, decimals or doubles give the bounds that numbers give."""
    events = [("a", seq, i, "u", "x") for i, seq in enumerate(range(30, 90, 3))] + [("b", 7, 99, "d", None), ("b", 2, 98, "c", "y")]
    as_kind = {"string": "lpad(seq, 5, '0')", "date": "date_add(DATE'2024-01-01', CAST(seq AS INT))", "timestamp": "timestamp_millis(seq)"}
    frame = spark.createDataFrame(events, SCHEMA).selectExpr("k", f"CAST({as_kind.get(kind, 'seq')} AS {kind}) AS seq", "off", "op", "v")
    back = {row["seq"]: row["n"] for row in frame.select("seq").distinct().selectExpr("seq", "dense_rank() OVER (ORDER BY seq) AS n").collect()}
    ranks = {seq: n for n, seq in enumerate(sorted({e[1] for e in events}), 1)}
    rows = present(to_state(mark(frame, VERSIONS), VERSIONS), VERSIONS).collect()
    got = {(r["k"], r["v"], back[r["valid_from"]], back.get(r["valid_to"])) for r in rows}
    assert got == {(k, v, ranks[a], ranks.get(b)) for k, v, a, b in brute.history(events)}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 5), st.sampled_from("cudt"), st.sampled_from(["x", "y", None])),
        min_size=1,
        max_size=12,
    )
)
def test_small_feeds(spark, feed):
    events = [(None if op == "t" else k, seq, off, op, v) for off, (k, seq, op, v) in enumerate(feed)]
    assert set(run(spark, events, CURRENT)) == brute.current(events)
    assert set(run(spark, events, VERSIONS)) == brute.history(events)


def test_c11_two_keys(spark):
    frame = spark.createDataFrame(
        [("a", "x", 1, 0, "c", "1"), ("a", "y", 2, 1, "c", "2"), ("a", "x", 3, 2, "u", "3"), ("a", "y", 4, 3, "d", None)],
        "k string, k2 string, seq bigint, off bigint, op string, v string",
    )
    spec = dict(keys=["k", "k2"], sequence_by="seq", tie_breaker=["off"], delete_when="op = 'd'")
    spec["except_columns"] = ["op", "seq", "off"]
    assert {tuple(r) for r in apply_changes(frame, **spec).collect()} == {("a", "x", "3")}
    history = {tuple(r) for r in apply_changes(frame, scd_type=2, **spec).collect()}
    assert history == {("a", "x", "1", 1, 3), ("a", "x", "3", 3, None), ("a", "y", "2", 2, 4)}


def test_x8_changes_without_sequence_or_key_are_rejected(spark):
    events = [("a", None, 0, "c", "x"), ("a", 1, 1, "c", "y"), (None, 2, 2, "c", "z"), (None, None, 3, "t", None)]
    assert run(spark, events, CURRENT) == [("a", "y")]
    assert run(spark, events, VERSIONS) == [("a", "y", 1, None)]
    for spec in (CURRENT, VERSIONS):
        rejects = rejected_changes(spark.createDataFrame(events, SCHEMA), spec).collect()
        assert {(r["off"], r["reason"]) for r in rejects} == {(0, "null_sequence"), (2, "null_key"), (3, "null_sequence")}


def test_history_intervals_do_not_overlap_and_open_ones_equal_current_state(spark):
    events = random_events(9, 500, 30, 1000)
    current = set(run(spark, events, CURRENT))
    history = run(spark, events, VERSIONS)
    assert {(k, v) for k, v, _, end in history if end is None} == current
    by_key = {}
    for k, _, start, end in history:
        by_key.setdefault(k, []).append((start, end))
    for spans in by_key.values():
        spans.sort()
        assert all(end is not None and end <= start for (_, end), (start, _) in zip(spans, spans[1:]))


def test_specs_that_make_no_sense_are_refused():
    for wrong in (dict(scd_type=3), dict(keys=()), dict(tie_breaker=())):
        with pytest.raises(ValueError):
            replace(CURRENT, **wrong)
    with pytest.raises(ValueError):
        replace(HISTORY, truncate_when="op = 't'")
    assert PRODUCTS.scd_type == 1


def test_a_hot_key_and_a_hot_group_of_copies(spark):
    """A third of all rows in one key, a third copies of one change, the rest spread out."""
    hot = [("hot", seq, seq, "u" if seq % 7 else "d", f"v{seq}") for seq in range(300)]
    copied = [("copied", 42, 5000, "c", "same")]
    others = [(f"k{i % 50}", i, 6000 + i, "u", "x") for i in range(300)]
    events = hot + copied + others
    delivered = hot + copied * 300 + others
    random.Random(1).shuffle(delivered)
    history = run(spark, delivered, VERSIONS)
    assert len(history) == len(set(history)) and set(history) == brute.history(events)
    current = run(spark, delivered, CURRENT)
    assert len(current) == len(set(current)) and set(current) == brute.current(events)
