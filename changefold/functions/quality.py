"""Named expectations and table constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The rules a clean change has to meet.
STRICT_RULES = {
    "valid_product_id": "product_id IS NOT NULL",
    "valid_product_name": "product_name IS NOT NULL",
    "valid_product_type": "product_type IN ('SVOD', 'Linear', 'TVOD')",
    "valid_created_at": "created_at IS NOT NULL",
    "valid_updated_at": "updated_at IS NOT NULL",
    "valid_op": "op IN ('c', 'u', 'd', 't')",
}

# Deletes carry a key and no row image, truncates carry neither; the other ops meet the strict rules.
REPAIRED_RULES = {
    name: f"op = 't' OR ({rule})" if name == "valid_product_id" else f"op IN ('d', 't') OR ({rule})"
    for name, rule in STRICT_RULES.items()
}


def fails(rule: str) -> str:
    """True where the rule is not; an unknown result counts as a failure, as it does in a filter."""
    return f"NOT coalesce({rule}, false)"


def failing_rows(df: DataFrame, rule: str) -> DataFrame:
    return df.where(fails(rule))


def violation_counts(rules: Mapping[str, str]) -> list[Column]:
    return [F.expr(f"count_if({fails(rule)})").alias(name) for name, rule in rules.items()]


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str], observation: str | Observation | None = None) -> DataFrame:
    """Drop each row that fails any rule.

    With `observation`, count the failures per rule in the same pass: an `Observation` for batch
    frames, a name for streams (then read `recentProgress[i].observedMetrics`).
    """
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *violation_counts(rules))
    return df.where(" AND ".join(f"({rule})" for rule in rules.values()))


def with_verdict(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Every row with `failed`, a bit for each rule in the order of `rules`, set where the row fails it."""
    if len(rules) > 63:
        raise ValueError("a verdict has room for 63 rules")
    bits = [f"if({fails(rule)}, {1 << i}L, 0L)" for i, rule in enumerate(rules.values())]
    return df.withColumn("failed", F.expr(" | ".join(bits)))


def verdict_counts(checked: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Failures per rule, as rows (`rule`, `failed`), from the verdicts alone: one row per verdict, then its bits."""
    masks = checked.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    counts = [F.coalesce(F.sum(F.when(F.getbit("failed", F.lit(i)) == 1, F.col("n"))), F.lit(0)).alias(rule) for i, rule in enumerate(rules)]
    return masks.agg(*counts).unpivot([], list(rules), "rule", "failed")


def expectation_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Failures per rule, as rows (`rule`, `failed`), from one aggregation."""
    counts = df.agg(*violation_counts(rules))
    return counts.unpivot([], list(rules), "rule", "failed")


def check_constraints(df: DataFrame, keys: Sequence[str], not_null: Sequence[str], latest: str | None = None) -> DataFrame:
    """Rows (`violation`, *keys, `n`): keys held by several rows, and NULLs in required columns; with `latest`, also the greatest
    value of that column among the rows of the key."""
    kept = [F.max(latest).alias(latest)] if latest else []
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("primary_key"),
        *[F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null],
        *kept,
    )
    whole_key = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    checked = counted.withColumn("primary_key", F.when(whole_key & (F.col("primary_key") > 1), F.col("primary_key")).otherwise(0))
    ids = [*keys, *([latest] if latest else [])]
    names = [c for c in checked.columns if c not in ids]
    return checked.unpivot(ids, names, "violation", "n").where("n > 0").select("violation", *ids, "n")
