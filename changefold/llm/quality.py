"""Quality rules as a bitmask ledger.

`measure` reads each text once and stores its measurements; `ledger` evaluates every rule once on them and stores the
failures as bits; policies are versioned masks over those bits, and ablations are bitwise aggregations of the ledger, with
no text read again. Nothing is shuffled but the few distinct bit patterns of an ablation.

Defined cases: a null or empty text has no words, lines or symbols, and fails `few_words`; a null id stays null; repeated
rows are judged each; an empty table gives an empty ledger; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import space_words, table

WINDOW = 8
#: Rules by bit, from 0: name and the condition under which a text fails, in whole numbers over the measurements.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "10 * n_symbols > word_chars"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
]
#: Policies by version: the rules that reject a text.
POLICIES = {
    1: ["few_words", "repeated_windows"],
    2: ["few_words", "repeated_windows", "many_symbols", "short_words", "long_words", "repeated_lines"],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a run of `window` words (a power of two) which the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids, width = np.fromiter(map(number.__getitem__, words), np.int64, len(words)), 1
    while width < window:  # numbers of runs of 2, 4, 8 words, each from two of half the length
        pairs = ids[:-width] * (ids.max() + 1) + ids[width:]
        ids, width = np.unique(pairs, return_inverse=True)[1], width * 2
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def measures(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = space_words(text)
    lines = [x for x in raw.split(b"\n") if x.split()]
    return (
        len(words),
        len(text or "") - sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))),
        len(raw) - len(raw.translate(None, b"#*$%&|<>")),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements...) of each row of (doc_id, text)."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [measures(x.as_py()) for x in batch.column(1)]
            columns = zip(*found) if found else [[]] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *MEASURES]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(measured: DataFrame) -> DataFrame:
    """The measurements with `failed_bits`: bit i is set where rule i fails."""
    bits = " | ".join(f"if({rule}, {1 << i}L, 0L)" for i, (_, rule) in enumerate(RULES))
    return measured.withColumn("failed_bits", F.expr(bits))


def policy_mask(version: int) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in POLICIES[version])


def ablations(entries: DataFrame, version: int) -> DataFrame:
    """Per rule of a policy: texts that fail it, that fail nothing else of the policy, and that are kept without it."""
    mask, names = policy_mask(version), [name for name, _ in RULES]
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(mask).alias("bits")).agg(F.count("*").alias("n"))
    cases = [(name, 1 << names.index(name)) for name in POLICIES[version]]
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in cases)))
    spread = patterns.withColumn("case", each).select("bits", "n", "case.rule", "case.bit")

    def total(condition):
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0))

    return spread.groupBy("rule").agg(
        total("bits & bit != 0").alias("n_failed"),
        total("bits = bit").alias("n_failed_alone"),
        total(f"bits & ({mask} & ~bit) = 0").alias("n_kept_without"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements and verdicts under policy 2, with its failure bits."""
    entries = ledger(measure(table(spark, sf_dir, "documents")))

    def fails(version):
        return F.col("failed_bits").bitwiseAND(policy_mask(version)) != 0

    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        fails(1).alias("base_failed"),
        (~fails(2)).alias("kept"),
        "n_lines",
        "failed_bits",
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines
  FROM d
), g AS (
  SELECT doc_id, i, w[i:i + 7] AS g FROM d, unnest(range(1, len(w) - 6)) AS r(i)
), twice AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) AS s(k) GROUP BY doc_id
), a AS (
  SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, CAST(if(n_words < 20, 1, 0) + if(100 * n_repeat_words > 30 * n_words, 2, 0)
    + if(10 * n_symbols > word_chars, 4, 0) + if(word_chars < 2 * n_words, 8, 0)
    + if(word_chars > 20 * n_words, 16, 0) + if(2 * n_dup_lines > n_lines, 32, 0) AS BIGINT) AS failed_bits
  FROM a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, n_lines, failed_bits
FROM b
"""
