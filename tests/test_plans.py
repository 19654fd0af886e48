"""What the plans have to look like to hold at scale."""

import re

import pytest
from test_target import SPECS, apply_batches, random_events, target  # noqa: F401

from changefold import read_target
from changefold.functions.decode import clean_projection
from changefold.functions.quality import STRICT_RULES, expectation_metrics, verdict_counts, with_verdict
from changefold.operators.apply_changes import fold, mark, present, to_state
from changefold.plans.catalog import _append_topic
from changefold.plans.feed import change_feed, clean_rows, product_rows
from changefold.streaming.refresh import HISTORY, PRODUCTS
from changefold.streaming.target import merge_plan, placed

SF_DIR = "/root/testdata/sf0.001"


def physical(frame, run=False):
    if run:
        frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "clean")
    clean_rows(spark, SF_DIR, "repaired").write.parquet(path)
    return spark.read.parquet(path)


def folded(changes, spec):
    return present(to_state(mark(changes, spec), spec), spec)


@pytest.mark.parametrize("mode", ["strict", "repaired"])
def test_each_json_text_is_parsed_once_per_shape(spark, mode):
    plan = physical(clean_rows(spark, SF_DIR, mode))
    # opaque members, route, payload; two more stand in the check for text after the document, for when its count of elements
    # fails, as it does on numbers outside the standard
    assert plan.count("from_json(") == 5
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_clean_flow_needs_no_shuffle_beyond_spreading_the_small_input(spark):
    plan = physical(clean_rows(spark, SF_DIR))
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM")


def test_current_state_reduces_before_its_one_keyed_shuffle(clean_table):
    plan = physical(folded(clean_table, PRODUCTS))
    before, after = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_history_shuffles_whole_rows_once_by_key_and_sequence(clean_table):
    plan = physical(folded(clean_table, HISTORY), run=True)
    final = plan.split("Initial Plan")[0]
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", final)
    assert len([s for s in scans if "description" in s]) == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", final)
    assert sum("product_id" in e and "ts_ms" in e for e in exchanges) >= 1
    assert not any(re.fullmatch(r"product_id#\d+, \d+", e) for e in exchanges)  # never by key alone


@pytest.mark.parametrize("name", SPECS)
def test_a_merge_does_not_exchange_the_stored_state(spark, target, name):  # noqa: F811
    spec, _ = SPECS[name]
    made = target(spec, 8)
    apply_batches(spark, made, [random_events(1, 200, 50, 20)])
    batch = spark.createDataFrame(random_events(2, 20, 5, 20), "k string, seq bigint, off bigint, op string, v string")
    marked = placed(mark(batch, spec), made)
    buckets = sorted(r[0] for r in marked.select("_part").distinct().collect())
    plan = physical(merge_plan(spark, made, fold(marked, spec), buckets))
    above, scan = plan.split("FileScan parquet", 1)
    assert "Exchange" not in above and "Bucketed: true" in scan
    assert re.search(r"PartitionFilters: \[[^\]]*_part", scan)


@pytest.mark.parametrize("name", SPECS)
def test_a_key_filter_reaches_the_files_of_a_target(spark, target, name):  # noqa: F811
    spec, _ = SPECS[name]
    made = target(spec)
    apply_batches(spark, made, [random_events(1, 50, 5, 20)])
    plan = physical(read_target(spark, made).where("k = 'k1'"))
    assert "EqualTo(k,k1)" in plan
    if name != "eras":
        assert "SelectedBucketsCount: 1 out of 4" in plan or "Bucketed: false" in plan
        assert "Exchange hashpartitioning" not in plan


def test_one_parse_gives_clean_rows_dropped_rows_and_counts(spark, tmp_path):
    """The checked rows hold one parse of bronze, and nothing reads bronze or parses again for the counts."""
    product_rows(spark, SF_DIR).select("payload", "topic", "partition", "offset").write.parquet(f"{tmp_path}/bronze")
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    checked = with_verdict(clean_projection(bronze), STRICT_RULES)
    plan = physical(checked.where("failed = 0"))
    assert plan.count("from_json(") == 1 and "Exchange" not in plan
    checked.write.parquet(f"{tmp_path}/checked")
    counts = verdict_counts(spark.read.parquet(f"{tmp_path}/checked"), STRICT_RULES)
    plan = physical(counts)
    assert "from_json" not in plan and "ReadSchema: struct<failed:bigint>" in plan
    expected = expectation_metrics(clean_projection(bronze), STRICT_RULES).collect()
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in expected}


def test_the_feed_is_dealt_evenly_whatever_its_row_groups(spark, tmp_path):
    """Few files with row groups of their own would keep a core each, and a topic file is not split below its row group."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    events.repartition(cores).write.parquet(f"{tmp_path}/events.parquet")
    feed = change_feed(spark, str(tmp_path))
    assert feed.rdd.getNumPartitions() == cores and "REPARTITION_BY_NUM" in physical(feed)
    sizes = [n for n in feed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert min(sizes) > 0.5 * sum(sizes) / cores
    _append_topic(feed.unionByName(feed), str(tmp_path))
    again = spark.read.parquet(f"{tmp_path}/topic")
    assert again.count() == 2 * sum(sizes)


def test_files_of_the_topic_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("changefold.plans.catalog.TOPIC_FILE", 100)
    feed = change_feed(spark, SF_DIR)
    _append_topic(feed, str(tmp_path))
    topic = spark.read.parquet(f"{tmp_path}/topic")
    assert topic.count() == feed.count()
    assert topic.groupBy("_metadata.file_name").count().agg({"count": "max"}).first()[0] <= 100
