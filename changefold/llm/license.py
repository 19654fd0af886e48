"""License scans by exact set-similarity join, in DataFrame operations throughout.

A block is a line of a text, or a window of consecutive words wherever its lines break, so that wrapped wording is compared
whole; a template is a set of words with a label. A template's windows are half as long again as its wording, which leaves
room for comment marks that are words. Every block is found that contains at least THRESHOLD of a template's words. Words are ordered by how many texts hold them, rarest first; a block can only reach the
threshold if it shares a word with the first `n - need + 1` of the template's (prefix filter), has at least `need` template
words (length filter), and if the places of the first shared word leave room for `need` in both (positional filter).
What is left is verified by intersection. Windows are taken around the words of the prefix only, as others cannot match.

Only blocks' words that any template has are kept, since no others count towards containment; texts are read once, and what
is stored of them is small. Templates are a fixed list, so their table and the order of their words are broadcast safely;
nothing else is, and no group of rows is gathered: matches are reduced to labels per text before and after the shuffle.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows and ids are told apart by a number of
their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import stored, table

THRESHOLD = 0.9
#: Phrases whose places are counted, with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Templates: label and wording, compared as sets of words.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("proprietary", "all rights reserved"),
]
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _small(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _SMALL)


def scan(docs: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """One row per row of (doc_id, text) with a number `rid`: its words, phrase places, the template words by line, and those
    of a text of several lines with their places."""
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    phrase = "(?<= )(?:" + "|".join(p for p, _ in PHRASES) + ")(?= )"
    label = F.create_map(*(F.lit(x) for pair in PHRASES for x in pair))
    size = F.create_map(*(F.lit(x) for p, _ in PHRASES for x in (p, len(p.split()))))

    def n_words(spaced):  # of words with one space before and after each
        return F.length(spaced) - F.length(F.replace(spaced, F.lit(" "))) - 1

    lines = F.filter(
        F.transform(
            F.split("small", "\n"),
            lambda line: F.array_intersect(F.split(line, _BREAK), F.array(*map(F.lit, vocabulary))),
        ),
        lambda words: F.size(words) > 0,
    )
    placed = F.filter(
        F.transform(F.split("spaced", " "), lambda w, i: F.struct(i.cast("int").alias("at"), w.alias("word"))),
        lambda x: x["word"].isin(vocabulary),
    )
    found = F.size("matches") > 0
    return (
        docs.select("doc_id", _small(F.col("text")).alias("small"))
        .select("doc_id", "small", lines.alias("blocks"), F.regexp_replace(F.concat(F.lit(" "), "small", F.lit(" ")), _BREAK, " ").alias("spaced"))
        .withColumn("some", F.contains("spaced", F.lit(" license ")))
        .withColumn("matches", F.when(F.col("some"), F.regexp_extract_all("spaced", F.lit(phrase), F.lit(0))).otherwise(F.array().cast("array<string>")))
        .withColumn("gaps", F.when(found, F.split("spaced", phrase, -1)))
        .select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            F.when(F.length("spaced") > 1, n_words(F.col("spaced"))).otherwise(F.lit(0)).cast("long").alias("n_words"),
            F.size("matches").cast("long").alias("n_base"),
            F.when(found, n_words(F.element_at("gaps", 1))).cast("long").alias("first_word"),
            F.when(
                found,
                n_words(F.col("spaced")) - n_words(F.element_at("gaps", -1)) - F.element_at(size, F.element_at("matches", -1)),
            )
            .cast("long")
            .alias("last_word"),
            F.array_sort(F.array_distinct(F.transform("matches", lambda m: F.element_at(label, m)))).alias("phrases"),
            "blocks",
            F.when(F.contains("small", F.lit("\n")), placed).otherwise(F.array().cast("array<struct<at:int,word:string>>")).alias("placed"),
        )
    )


def word_order(scanned: DataFrame) -> list[str]:
    """Template words by the number of texts that hold them, rarest first; counted over all texts."""
    words = scanned.select(F.explode(F.array_distinct(F.flatten("blocks"))).alias("word"))
    return [r["word"] for r in words.groupBy("word").agg(F.count("*").alias("n")).orderBy("n", "word").collect()]


def containments(scanned: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """(rid, label, containment) of the lines and windows that contain at least `threshold` of a template."""
    counted = word_order(scanned)
    absent = sorted({w for _, text in templates for w in text.split()}.difference(counted))
    rank = {w: i for i, w in enumerate(absent + counted)}
    rows = []
    for number, (label, text) in enumerate(templates):
        words = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        rows += [(words[i], number, label, i, len(words), need, words, window(text)) for i in range(len(words) - need + 1)]
    spark = scanned.sparkSession
    prefixes = spark.createDataFrame(
        rows, "word string, template int, label string, at int, n int, need int, words array<string>, width int"
    )
    least = min(need for *_, need, _, _ in rows)
    order = F.create_map(*(F.lit(x) for pair in rank.items() for x in pair))
    ranked = F.transform("block", lambda w: F.struct(F.element_at(order, w).alias("rank"), w.alias("word")))
    blocks = (
        scanned.select("rid", F.posexplode(F.filter("blocks", lambda b: F.size(b) >= least)).alias("line", "block"))
        .withColumn("block", F.transform(F.array_sort(ranked), lambda x: x["word"]))
        .withColumn("size", F.size("block"))
    )
    tokens = blocks.select("rid", "line", "size", "block", F.posexplode("block").alias("place", "word"))
    candidates = tokens.filter(f"place <= size - {least}").join(F.broadcast(prefixes), "word").filter(
        "size >= need AND place <= size - need AND least(n - at, size - place) >= need"
    )
    overlap = F.size(F.array_intersect("block", "words"))
    windows = near_windows(scanned, sorted({row[0] for row in rows}), max(row[-1] for row in rows)).join(F.broadcast(prefixes), "word")
    return (
        candidates.withColumn("overlap", overlap)
        .select("rid", "label", "n", "need", "overlap")
        .unionAll(windows.select("rid", "label", "n", "need", most_in_a_window().alias("overlap")))
        .filter("overlap >= need")
        .groupBy("rid", "label")
        .agg(F.max(F.col("overlap") / F.col("n")).alias("containment"))
    )


def window(text: str) -> int:
    """The number of consecutive words of a text that are compared with a template."""
    return len(text.split()) * 3 // 2


def near_windows(scanned: DataFrame, words: list[str], width: int) -> DataFrame:
    """(rid, here, word, near) of every place of one of `words`, `near` being the template words of all windows around it."""
    around = F.transform(
        "placed",
        lambda x, i: F.when(
            x["word"].isin(words), F.struct(x["at"].alias("at"), x["word"].alias("word"), F.slice("placed", F.greatest(i - width + 2, F.lit(1)), 2 * width - 1).alias("near"))
        ),
    )
    places = scanned.filter(F.size("placed") > 0).select("rid", F.explode(F.filter(around, lambda x: x.isNotNull())).alias("x"))
    return places.select("rid", F.col("x.at").alias("here"), "x.word", "x.near")


def most_in_a_window() -> Column:
    """The largest overlap of `words` with a window of `width` words that holds the place `here`; 0 where all windows together
    fall short of `need`."""
    held = F.filter("near", lambda x: (F.abs(x["at"] - F.col("here")) < F.col("width")) & F.array_contains("words", x["word"]))

    def overlap(start):
        inside = F.filter(held, lambda y: (y["at"] >= start["at"]) & (y["at"] < start["at"] + F.col("width")))
        return F.size(F.array_distinct(F.transform(inside, lambda y: y["word"])))

    starts = F.filter(held, lambda x: x["at"] <= F.col("here"))
    enough = F.size(F.array_distinct(F.transform(held, lambda x: x["word"]))) >= F.col("need")
    return F.when(enough, F.array_max(F.transform(starts, overlap))).otherwise(F.lit(0))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Base places and labels of every text, and the labels of templates its lines or windows contain. A phrase is a template that is
    contained in full, so its score is 1."""
    scanned = stored(scan(docs, templates), "licenses")
    matched = (
        containments(scanned, templates, threshold)
        .groupBy("rid")
        .agg(F.collect_set("label").alias("matched"), F.max("containment").alias("containment"))
    )
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("phrases", F.coalesce("matched", none)))
    return scanned.drop("blocks", "placed").join(matched, "rid", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("phrases", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every document for license wording."""
    return scan_licenses(table(spark, sf_dir, "documents"))


OP6_SQL = (
    r"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM d
), p AS (
  SELECT doc_id, i - 1 AS pos,
         CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit'
              WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
              WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END AS label
  FROM w, unnest(range(1, len(w) + 1)) AS r(i)
), b AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS base
  FROM p WHERE label IS NOT NULL GROUP BY doc_id
), l AS (
  SELECT doc_id, list_distinct(regexp_split_to_array(x.line, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS words
  FROM d, unnest(string_split(t, chr(10))) AS x(line)
), t AS (SELECT column0 AS label, list_distinct(string_split(column1, ' ')) AS words FROM (VALUES """
    + ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES)
    + r""") AS v(column0, column1)
), m AS (
  SELECT doc_id, list(DISTINCT label) AS matched,
         max(len(list_intersect(l.words, t.words)) / len(t.words)) AS containment
  FROM l, t WHERE 10 * len(list_intersect(l.words, t.words)) >= 9 * len(t.words) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(matched, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)
"""
)
