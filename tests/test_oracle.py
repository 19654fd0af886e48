"""Every registered query against its SQL, over the whole of the smallest tables."""

from dataclasses import replace

import __spark_entry__ as contract
import pytest
from changefold.functions import decode, quality
from changefold.operators import apply_changes
from changefold.plans import catalog
from compare import difference, oracle_connection
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_its_sql(spark, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert difference(frame, oracle_connection(SF_DIR), contract.oracle_sql()[name]) == ""


def test_sql_is_of_registered_queries_and_the_entry_runs(spark):
    assert set(contract.queries()) >= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0


BROKEN = {
    "c2_newest_change": lambda m: m.setattr(catalog, "PRODUCTS", replace(catalog.PRODUCTS, tie_breaker=("partition", "offset"))),
    "c4_truncate_cut": lambda m: m.setattr(catalog, "cut_truncated", lambda folded, marked, spec: folded),
    "c1_scd1_repaired": lambda m: m.setattr(apply_changes, "cut_truncated", lambda folded, marked, spec: folded),
    "c8_history_ignores_truncate": lambda m: m.setattr(
        catalog, "_target", lambda changes, spec, real=catalog._target: real(changes.where("ts_ms > 1706616000000"), spec)
    ),
    "c11_two_column_key": lambda m: m.setitem(
        catalog.QUERIES,
        "c11_two_column_key",
        lambda s, d, q=catalog.QUERIES["c11_two_column_key"]: q(s, d).dropDuplicates(["product_id"]),
    ),
    "f4_valid_created_at": lambda m: m.setitem(quality.STRICT_RULES, "valid_created_at", "product_id IS NOT NULL"),
    "f9_quarantine": lambda m: m.setattr(decode, "REASON", decode.REASON.replace(decode.NOTHING_AFTER, "true")),
    "p2_routing_fields": lambda m: m.setattr(
        catalog, "routed_rows", lambda s, d, real=catalog.routed_rows: real(s, d).withColumn("src_table", F.lit("product"))
    ),
}


@pytest.mark.parametrize("name", BROKEN)
def test_a_broken_operator_shows(spark, monkeypatch, name):
    BROKEN[name](monkeypatch)
    sf_dir = "/root/testdata/sf0.01"
    assert difference(catalog.QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), contract.oracle_sql()[name]) != ""
