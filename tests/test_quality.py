import pytest
from messages import as_messages, change
from pyspark.sql import Observation

from changefold import (
    PRODUCTS_SCHEMA,
    REPAIRED_RULES,
    STRICT_RULES,
    check_constraints,
    clean_projection,
    expect_all_or_drop,
    expectation_metrics,
    failing_rows,
    triage,
)
from changefold.functions.decode import schema_of

CASES = [
    (change(), None),
    (change(key=None), "valid_product_id"),
    (change(product_name=None), "valid_product_name"),
    (change(product_type=None), "valid_product_type"),
    (change(product_type="svod"), "valid_product_type"),
    (change(created_at="nonsense"), "valid_created_at"),
    (change(updated_at=None), "valid_updated_at"),
    (change("r"), "valid_op"),
    (change(None), "valid_op"),
    (change(description=None), None),
    (change(product_type="Linear"), None),
    (change(product_type="TVOD"), None),
]


def clean(spark, values, mode="strict"):
    return clean_projection(triage(as_messages(spark, values))[0], mode)


def test_f1_to_f6_each_rule_fails_its_own_rows(spark):
    rows = clean(spark, [value for value, _ in CASES]).cache()
    for name, rule in STRICT_RULES.items():
        failing = {r["offset"] for r in failing_rows(rows, rule).collect()}
        assert failing == {i for i, (_, broken) in enumerate(CASES) if broken == name}, name


@pytest.mark.parametrize("rules", [STRICT_RULES, REPAIRED_RULES], ids=["strict", "repaired"])
def test_f7_drops_rows_that_fail_any_rule(spark, rules):
    kept = expect_all_or_drop(clean(spark, [value for value, _ in CASES]), rules)
    assert {r["offset"] for r in kept.collect()} == {i for i, (_, broken) in enumerate(CASES) if broken is None}


def test_x3_x4_deletes_truncates_and_snapshot_reads(spark):
    values = [change("d", "P1"), change("t"), change("r"), change("d", None)]
    strict = expect_all_or_drop(clean(spark, values), STRICT_RULES)
    repaired = expect_all_or_drop(clean(spark, values, "repaired"), REPAIRED_RULES)
    assert strict.count() == 0
    assert sorted(r["op"] for r in repaired.collect()) == ["d", "t"]


def test_f8_counts_as_rows_and_in_the_filter_pass(spark):
    rows = clean(spark, [value for value, _ in CASES])
    expected = {name: sum(broken == name for _, broken in CASES) for name in STRICT_RULES}
    assert {r["rule"]: r["failed"] for r in expectation_metrics(rows, STRICT_RULES).collect()} == expected
    observation = Observation("rules")
    expect_all_or_drop(rows, STRICT_RULES, observation).collect()
    assert observation.get == {"rows": len(CASES), **expected}


def test_c10_x7_constraints_are_checked_not_enforced(spark):
    target = spark.createDataFrame(
        [("A", "n", "SVOD"), ("A", "n", "SVOD"), ("B", None, "SVOD"), (None, "n", None), (None, "n", None)],
        "product_id string, product_name string, product_type string",
    ).to(schema_of("product_id string, product_name string, product_type string"))
    found = check_constraints(target, ["product_id"], ["product_id", "product_name", "product_type"]).collect()
    assert {(r["violation"], r["product_id"], r["n"]) for r in found} == {
        ("primary_key", "A", 2),
        ("not_null:product_name", "B", 1),
        ("not_null:product_id", None, 2),
        ("not_null:product_type", None, 2),
    }


def test_p9_conform_adds_missing_columns_and_casts(spark):
    conformed = spark.createDataFrame([("A", 1)], "product_id string, product_name int").to(schema_of(PRODUCTS_SCHEMA))
    assert conformed.schema == schema_of(PRODUCTS_SCHEMA)
    assert conformed.first()["product_name"] == "1"
