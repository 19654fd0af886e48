"""Benchmark decontamination with a distributed positional inverted index.

The index is sharded by document: a shard holds the postings of some SHARD_WORDS words of whole documents, a row for each of
its terms. A hot term's list is thus split over all shards, and no list is ever longer than a shard. Positions count through
the shard with GAP unused positions between documents, so neither a phrase nor a proximity match can run from one into the
next. The index is a stored table and can be searched for any number of item sets.

A search takes the items in blocks of about BLOCK_WORDS words, which bounds what is sent to tasks. Each window of an item is
looked up from its rarest term on, by frequency over the whole corpus: its list, shifted by the term's offset in the window,
is intersected with the next rarest one's, and so on, until it is empty or all terms agree. Only lists of terms that the
items have are shuffled, to bring a shard's lists together.

A proximity match asks less: every other term of the window lies within `slop` words of the rarest one, in any order.

Defined cases: a null or empty text has no words and is clean; an item without words is no window; null item ids count as
the id ''; rows with equal ids are judged each (documents) or together (items); empty tables give no matches or no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import Numbers, alnum_words, give_back, lean, stored, table

WINDOW = 10
SLOP = 20
GAP = 64
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 200_000


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index of (doc_id, text): for each term of a shard (term, n, positions), for each document a row without a
    term (doc_id, doc_no, base, n, digest), `digest` being that of the text."""

    @lean
    def shards(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        numbers, words, held = Numbers(), [], 0
        docs_held: list[tuple] = []

        def emit():
            shard = task << 32 | number
            ids, bases, sizes, digests = zip(*docs_held)
            count = len(ids)
            yield rows(
                [shard] * count, pa.nulls(count, pa.string()), sizes, pa.nulls(count, pa.binary()), range(count), bases, digests, ids
            )
            if not held:
                return
            terms, term = [*numbers], np.concatenate(words)
            place = np.concatenate([np.arange(b, b + n, dtype=np.int32) for b, n in zip(bases, sizes)])
            order = np.argsort((term & 0xFFFF).astype(np.uint16), kind="stable")  # in two steps, which numpy sorts by radix
            order = order[np.argsort((term >> 16).astype(np.uint16)[order], kind="stable")]
            ends = np.cumsum(np.bincount(term, minlength=len(terms)))
            place = place[order]
            steps = np.diff(place, prepend=np.int32(0))
            starts = ends[:-1]
            steps[starts] = place[starts]  # each list starts anew
            for at in range(0, len(terms), 20_000):
                part = ends[at : at + 20_000]
                low = ends[at - 1] if at else 0
                offsets = np.concatenate(([0], part - low)).astype(np.int32) * 4
                data = steps[low : part[-1]].astype("<i4").tobytes()
                lists = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
                none = pa.nulls(len(part), pa.int64())
                sizes_here = np.diff(part, prepend=low)
                yield rows(
                    [shard] * len(part),
                    pa.array([t.decode() for t in terms[at : at + 20_000]], pa.string()),
                    sizes_here,
                    lists,
                    none,
                    none,
                    pa.nulls(len(part), pa.string()),
                    pa.nulls(len(part), id_type[0]),
                )

        def rows(shard, term, n, positions, doc_no, base, digest, ids):
            cast = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), id_type[0]]
            given = [shard, term, n, positions, doc_no, base, digest, ids]
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(given, cast)], names)

        id_type, base = [None], 0
        for batch in batches:
            id_type[0] = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                own = alnum_words(text)
                digest = hashlib.sha256((text or "").encode()).hexdigest()
                docs_held.append((doc.as_py(), base, len(own), digest))
                base += len(own) + GAP
                words.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
                held += len(own)
                if held >= shard_words or len(docs_held) >= shard_words:
                    yield from emit()
                    number, base, numbers, words, held, docs_held = number + 1, 0, Numbers(), [], 0, []
                    give_back()
        if docs_held:
            yield from emit()

    names = ["shard", "term", "n", "positions", "doc_no", "base", "digest", "doc_id"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard long, term string, n long, positions binary, doc_no long, base long, digest string, doc_id {kind}"
    return stored(docs.select("doc_id", "text").mapInArrow(shards, schema), "positional-index")


def windows(items: list[tuple[str, str | None]], window: int = WINDOW) -> dict[tuple[bytes, ...], list[str]]:
    """The windows of items, each with the ids that have it; an item shorter than a window is one by itself."""
    found: dict[tuple[bytes, ...], list[str]] = {}
    for item, text in items:
        words = alnum_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            ids = found.setdefault(tuple(words[i : i + size]), [])
            if not ids or ids[-1] != item:
                ids.append(item)
    return found


def phrase_starts(lists: dict[bytes, np.ndarray], terms: tuple[bytes, ...], order: list[int]) -> np.ndarray:
    """Where `terms` stand consecutively; `order` has their offsets, the rarest first."""
    starts = None
    for offset in order:
        held = lists.get(terms[offset])
        if held is None:
            return np.empty(0, np.int64)
        if starts is None:
            starts = held - offset
        else:
            at = np.searchsorted(held, starts + offset)
            at[at == len(held)] = 0
            starts = starts[held[at] == starts + offset]
        if not len(starts):
            break
    return starts


def near_places(lists: dict[bytes, np.ndarray], terms: tuple[bytes, ...], order: list[int], slop: int) -> np.ndarray:
    """Places of the rarest term that have every other term within `slop` words."""
    places = lists.get(terms[order[0]], np.empty(0, np.int64))
    for offset in order[1:]:
        held = lists.get(terms[offset])
        if held is None or not len(places):
            return places[:0]
        at = np.searchsorted(held, places - slop)
        places = places[(at < len(held)) & (held[np.minimum(at, len(held) - 1)] <= places + slop)]
    return places


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(shard, doc_no, item, near, spans) for each document and item (item_id, text) that match: spans are runs [start, end)
    of words in windows that occur, in words of the document; near is true if a window's terms are close together."""
    if slop > GAP:
        raise ValueError(f"slop is at most {GAP}")
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    size = named.agg(F.sum(F.length("text")), F.count("*")).first()
    blocks = max(1, math.ceil((size[0] or 0) / 5 / block_words), math.ceil(size[1] / block_words))
    found = None
    for block in range(blocks):
        chosen = named.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        part = _search_block(index, sorted((r["item"], r["text"] or "") for r in chosen.collect()), window, slop)
        found = part if found is None else found.unionAll(part)
    return found


def _search_block(index: DataFrame, items: list[tuple[str, str]], window: int, slop: int) -> DataFrame:
    spark, wanted = index.sparkSession, windows(items, window)
    terms = sorted({w for key in wanted for w in key})
    vocabulary = stored(spark.createDataFrame([(t.decode(),) for t in terms], "term string"), "vocabulary")
    lists = index.select("shard", "term", "n", "positions", "doc_no", "base").join(vocabulary, "term", "left_semi")
    frequency = {r["term"].encode(): r["n"] for r in lists.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    looked_up = [
        (terms, sorted(range(len(terms)), key=lambda i: (frequency.get(terms[i], 0), terms[i], i)), ids) for terms, ids in wanted.items()
    ]
    documents = index.filter("term is null").select("shard", "term", "n", "positions", "doc_no", "base")

    def matches(key, rows):
        import pandas as pd

        docs = rows[rows["term"].isna()].sort_values("doc_no")
        bases = docs["base"].to_numpy(np.int64)
        lists = {
            t.encode(): np.cumsum(np.frombuffer(p, "<i4"), dtype=np.int64)
            for t, p in zip(rows["term"], rows["positions"])
            if isinstance(t, str)
        }

        def doc_of(places):
            return np.searchsorted(bases, places, "right") - 1

        hits: dict[tuple[int, str], list[np.ndarray]] = {}
        near: set[tuple[int, str]] = set()
        for terms, order, ids in looked_up:
            if terms[order[0]] not in lists:
                continue
            starts = phrase_starts(lists, terms, order)
            for doc in np.unique(doc_of(starts)):
                own = starts[doc_of(starts) == doc] - bases[doc]
                for item in ids:
                    hits.setdefault((int(doc), item), []).append(np.stack([own, own + len(terms)], 1))
            for doc in np.unique(doc_of(near_places(lists, terms, order, slop))):
                near.update((int(doc), item) for item in ids)
        out = [(key[0], doc, item, (doc, item) in near, joined(hits.get((doc, item), []))) for doc, item in sorted(near | set(hits))]
        return pd.DataFrame(out, columns=["shard", "doc_no", "item", "near", "spans"])

    schema = "shard long, doc_no long, item string, near boolean, spans array<struct<start:long,end:long>>"
    return lists.select(documents.columns).unionAll(documents).groupBy("shard").applyInPandas(matches, schema)


def joined(parts: list[np.ndarray]) -> list[tuple[int, int]]:
    """The union of runs, as runs that do not touch."""
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, np.concatenate(parts))) if parts else []:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(end))
        else:
            out.append([int(start), int(end)])
    return [tuple(x) for x in out]


def contamination(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """One row per document of the index: its words, the words that a window of an item covers, and the items; `n_near`
    counts the items with a proximity match."""
    found = stored(search(index, items, window, slop), "matches")
    covered = F.expr("""
      aggregate(array_sort(flatten(all_spans)), struct(0L as upto, 0L as n),
        (acc, s) -> struct(greatest(acc.upto, s.end) as upto,
          acc.n + greatest(0L, s.end - greatest(acc.upto, s.start)) as n), acc -> acc.n)""")
    exact = F.when(F.size("spans") > 0, F.col("item"))
    by_doc = (
        found.groupBy("shard", "doc_no")
        .agg(
            F.collect_list("spans").alias("all_spans"),
            F.collect_set(exact).alias("items"),
            F.collect_set(F.when(F.col("near"), F.col("item"))).alias("close"),
        )
        .select("shard", "doc_no", covered.alias("n_hit"), F.array_sort("items").alias("items"), F.size("close").cast("long").alias("n_near"))
    )
    docs = index.filter("term is null").select("shard", "doc_no", "doc_id", "digest", F.col("n").alias("n_words"))
    return docs.join(by_doc, ["shard", "doc_no"], "left").select(
        "doc_id",
        "digest",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that no window of an item occurs in. Rows are told apart by id and text, so ids need not be unique."""
    hit = contamination(build_index(docs), items).filter("n_hit > 0").select("doc_id", "digest").distinct()
    hit = stored(hit.withColumnsRenamed({"doc_id": "hit_id", "digest": "hit_digest"}), "contaminated")
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (digest == hit["hit_digest"]), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match every document with every benchmark item."""
    found = contamination(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )
