"""Source divergence audit: how far the term frequencies of each source of a language are from those of every other source.

A term's smoothed frequency in a group (a language and a source) depends on its count there alone, so the divergence of two
groups is a sum over their joint cells (count here, count there) of terms in the cell times a function of the two counts. Terms
get numbers, frequent ones first, and CHUNK consecutive ones a chunk. For each group, chunk and count there is a bitset of the
terms with that count; a pair's cell is the popcount of two bitsets' AND, and cells with a zero are complements: what a count's
bitset has beyond its cells. Counts that fewer than FEW terms of a chunk have keep the terms' numbers in place of a bitset, and
are looked up in the other group's bitsets.

Every pair of sources of a language is asked for, so the work is split by pairs: sources in tiles of about TILE by a hash, and a
task has one chunk of two tiles. A chunk holds a term once per group, so a task is bounded whatever the corpus. Texts become
counts per task before anything is exchanged, so a hot source or a common term is one row per task.

All arithmetic is in integers. Defined cases: null text, language and source are empty text. Groups without terms, and languages
that keep no term, still have their pairs, with value 0 in the latter. Rows that repeat are documents of their own; no id is
read. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefold.llm.common import stored, table
from changefold.llm.exchange import packed, unpacked

MIN_DOCUMENTS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
#: Terms of a chunk; a power of two.
CHUNK = 4096
#: Terms of a count and chunk from which on they are a bitset.
FEW = 16
TILE = 64
#: Distinct counted terms that a task holds before it hands them on, and bytes of a text cut into words at a time.
HELD_TERMS, PIECE_BYTES = 400_000, 1 << 22
#: Bytes that are letters, small ones for capitals; every other byte ends a term.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
GROUP = ["lang", "source"]


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms `[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+` of a text, A-Z lower-cased, in lists of bounded size."""
    letters, at = text.translate(_LETTERS), 0
    while at < len(letters):
        end = letters.find(b" ", at + PIECE_BYTES) if len(letters) - at > PIECE_BYTES else -1
        end = len(letters) if end < 0 else end
        yield letters[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group of (text, lang, source), and a row
    without a term for each group."""

    def counted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(groups):
            for (lang, source), (counts, docs) in groups.items():
                terms = list(counts)
                columns = [
                    pa.array([lang] * (len(terms) + 1), pa.string()),
                    pa.array([source] * (len(terms) + 1), pa.string()),
                    pa.array([*terms, None], pa.binary()),
                    pa.array([*counts.values(), 0], pa.int64()),
                    pa.array([*map(docs.__getitem__, terms), 0], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        groups, held = {}, 0
        for batch in batches:
            for text, lang, source in zip(*(batch.column(i) for i in range(3))):
                counts, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                before, seen = len(counts), set()
                for terms in terms_of(text.as_py()):
                    counts.update(terms)
                    seen.update(terms)
                docs.update(seen)
                held += len(counts) - before
                if held >= HELD_TERMS:
                    yield from emit(groups)
                    groups, held = {}, 0
        yield from emit(groups)

    texts = docs.select(
        F.coalesce("text", F.lit("")).cast("binary"), *[F.coalesce(c, F.lit("")).alias(c) for c in GROUP]
    )
    rows = texts.mapInArrow(counted, "lang string, source string, term binary, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def number_terms(counts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, lang_n, chunk, slot): the terms in enough documents of their language, frequent ones first."""
    of_lang = counts.where("term IS NOT NULL").groupBy("lang", "term")
    kept = of_lang.agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_documents)
    order = ["lang", F.desc("lang_n"), "term"]
    sorted_terms = kept.repartitionByRange(1 + counts.count() // 1_000_000, *order).sortWithinPartitions(*order)
    number = sorted_terms.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("number"))
    shift = CHUNK.bit_length() - 1
    return stored(
        number.select(
            "lang",
            "term",
            "lang_n",
            F.shiftright("number", shift).alias("chunk"),
            F.col("number").bitwiseAND(CHUNK - 1).cast("int").alias("slot"),
        ),
        "terms",
    )


def group_totals(counts: DataFrame, entries: DataFrame, terms: DataFrame, tile: int = TILE) -> DataFrame:
    """(lang, source, total, kept, lang_total, tile): of each group its kept occurrences, of each language its kept terms and
    their occurrences."""
    totals = entries.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = counts.select(*GROUP).distinct()
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    whole = groups.join(totals, GROUP, "left").join(of_lang, "lang", "left").join(tiles, "lang").na.fill(0)
    return stored(whole.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")).drop("tiles"), "groups")


def build_bitsets(entries: DataFrame) -> DataFrame:
    """Stored (lang, chunk, source, counts, bitsets, few_counts, few_slots): the counts with bitsets, one of CHUNK bits for each,
    then a count and a slot for each term of the others; all packed. A group has at most CHUNK terms in a chunk."""

    def built(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            columns = [[], [], [], []]
            for row in batch.column(3):
                pairs = row.values
                n, slot = (pairs.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                levels, level, sizes = np.unique(n, return_inverse=True, return_counts=True)
                dense = sizes >= FEW
                bits = np.zeros((int(dense.sum()), CHUNK), np.uint8)
                at = dense[level]
                bits[(np.cumsum(dense) - 1)[level[at]], slot[at]] = 1
                for column, value in zip(columns, (levels[dense], np.packbits(bits, axis=1, bitorder="little"), n[~at], slot[~at])):
                    column.append(packed(value))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *(pa.array(c, pa.binary()) for c in columns)],
                ["lang", "chunk", "source", "counts", "bitsets", "few_counts", "few_slots"],
            )

    grouped = entries.groupBy("lang", "chunk", "source").agg(F.collect_list(F.struct("n", "slot")).alias("pairs"))
    schema = "lang string, chunk long, source string, counts binary, bitsets binary, few_counts binary, few_slots binary"
    return stored(grouped.mapInArrow(built, schema), "bitsets")


def smoothed(count: int, total: int, kept: int) -> int:
    return 1 + SCALE * (count + 1) // (total + kept) if total + kept else 1


def deviation(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Levels:
    """One group's terms of a chunk by their counts, with the smoothed frequency of each count."""

    def __init__(self, row: dict, total: int, kept: int):
        counts, self.few_slots = unpacked(row["counts"], np.int64), unpacked(row["few_slots"], np.int32)
        self.bitsets = unpacked(row["bitsets"], np.uint64).reshape(len(counts), CHUNK // 64)
        few, self.few_level = np.unique(unpacked(row["few_counts"], np.int64), return_inverse=True)
        self.few_level = self.few_level + len(counts)
        self.p = np.array([smoothed(int(c), total, kept) for c in (*counts, *few)], np.int64)
        self.sizes = np.concatenate([np.bitwise_count(self.bitsets).sum(1, dtype=np.int64), np.bincount(self.few_level)[len(counts) :]])
        self.slot_of = np.full(CHUNK, -1, np.int32)
        self.slot_of[self.few_slots] = np.arange(len(self.few_slots))

    def holding(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bitset (first array) has which of `slots` (numbers in the second)."""
        found = self.bitsets[:, slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1)
        return np.nonzero(found)


def joint_cells(a: Levels, b: Levels) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level of a, level of b, terms) of the cells in which both counts are positive; a cell may come in parts."""
    at, bt, n = [], [], []
    step = max(1, (1 << 20) // max(1, b.bitsets.size))
    for start in range(0, len(a.bitsets), step):
        both = np.bitwise_count(a.bitsets[start : start + step, None, :] & b.bitsets[None, :, :]).sum(2, dtype=np.int64)
        i, j = np.nonzero(both)
        at.append(i + start)
        bt.append(j)
        n.append(both[i, j])
    level, k = b.holding(a.few_slots)
    at.append(a.few_level[k])
    bt.append(level)
    level, k = a.holding(b.few_slots)
    at.append(level)
    bt.append(b.few_level[k])
    shared = b.slot_of[a.few_slots]
    at.append(a.few_level[shared >= 0])
    bt.append(b.few_level[shared[shared >= 0]])
    at, bt = np.concatenate(at), np.concatenate(bt)
    n = np.concatenate([*n, np.ones(len(at) - sum(map(len, n)), np.int64)])
    return at, bt, n


def pair_values(a: Levels | None, b: Levels | None, a0: int, b0: int) -> tuple[int, int]:
    """What a chunk adds to the values of (a, b) and (b, a) beyond all its terms being in neither; a0 and b0 are the smoothed
    frequencies of a count of zero, and None is a group without terms in the chunk."""
    zero = np.array([a0, b0])
    base = deviation(zero, zero[::-1])
    out = np.zeros(2, np.int64)

    def add(p, q, n):
        out[0] += (n * (deviation(p, q) - base[0])).sum()
        out[1] += (n * (deviation(q, p) - base[1])).sum()

    left_a, left_b = (None if x is None else x.sizes.copy() for x in (a, b))
    if a is not None and b is not None:
        at, bt, n = joint_cells(a, b)
        add(a.p[at], b.p[bt], n)
        np.subtract.at(left_a, at, n)
        np.subtract.at(left_b, bt, n)
    if a is not None:
        add(a.p, zero[1], left_a)
    if b is not None:
        add(zero[0], b.p, left_b)
    return int(out[0]), int(out[1])


def tile_pairs(groups: DataFrame) -> DataFrame:
    """(lang, kept, t, u, left, right) for every two tiles of a language, t <= u; the members of a tile are (source, total)."""
    members = F.sort_array(F.collect_list(F.struct("source", "total")))
    tiles = groups.groupBy("lang", "kept", "tile").agg(members.alias("members"))
    left = tiles.select("lang", "kept", F.col("tile").alias("t"), F.col("members").alias("left"))
    right = tiles.select("lang", F.col("tile").alias("u"), F.col("members").alias("right"))
    return left.join(right, "lang").where("t <= u")


def source_pairs(bitsets: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language."""
    schema = "lang string, source string, item string, value long"
    tiles = tile_pairs(groups)

    def of_none(batches: Iterator) -> Iterator:
        """Every pair as if no term were in either."""
        for batch in batches:
            for row in batch.to_pylist():
                yield as_batch([(row["lang"], *pair) for pair in pairs(row)])

    def pairs(row):
        zero = {m["source"]: smoothed(0, m["total"], row["kept"]) for m in (*row["left"], *row["right"])}
        for a in row["left"]:
            for b in row["right"]:
                if row["t"] < row["u"] or a["source"] != b["source"]:
                    x, y = a["source"], b["source"]
                    yield x, y, row["kept"] * int(deviation(zero[x], zero[y]))
                    if row["t"] < row["u"]:
                        yield y, x, row["kept"] * int(deviation(zero[y], zero[x]))

    def as_batch(rows):
        import pyarrow as pa

        kinds = [pa.string()] * 3 + [pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "item", "value"])

    def of_chunk(key, rows):
        import pyarrow as pa

        rows = rows.to_pylist()
        first = rows[0]
        kept = first["kept"]
        totals = [{m["source"]: m["total"] for m in first[side]} for side in ("left", "right")]
        levels = {r["source"]: Levels(r, totals[r["side"]][r["source"]], kept) for r in rows}
        zero = {source: smoothed(0, total, kept) for side in totals for source, total in side.items()}
        out = []
        for a in totals[0]:
            for b in totals[1]:
                if (first["t"] < first["u"] or a < b) and (a in levels or b in levels):
                    ab, ba = pair_values(levels.get(a), levels.get(b), zero[a], zero[b])
                    out += [(first["lang"], a, b, ab), (first["lang"], b, a, ba)]
        return pa.Table.from_batches([as_batch(out)])

    with_tile = bitsets.join(groups.select("lang", "source", "tile"), GROUP)
    sides = [
        with_tile.withColumnRenamed("tile", tile).join(tiles if tile == "t" else tiles.where("t < u"), ["lang", tile]).withColumn("side", F.lit(side))
        for side, tile in enumerate(("t", "u"))
    ]
    routed = sides[0].unionByName(sides[1])
    parts = routed.groupBy("lang", "chunk", "t", "u").applyInArrow(of_chunk, schema)
    every = tiles.mapInArrow(of_none, schema).unionByName(parts)
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def excess_terms(entries: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group has more often than its language, by their deviation."""
    with_totals = entries.join(groups.select("lang", "source", "total", "kept", "lang_total"), GROUP)

    def p(count, total):
        return f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0)) div CAST({total} + kept AS DECIMAL(20,0))"

    more = with_totals.selectExpr("lang", "source", "term", f"{p('n', 'total')} AS p", f"{p('lang_n', 'lang_total')} AS q")
    valued = more.where("p > q").selectExpr("lang", "source", "term", "(p - q) * (p - q) div q AS value")
    ranked = valued.withColumn("rank", F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "term")))
    return ranked.where(F.col("rank") <= top).select(*GROUP, F.col("term").cast("string").alias("item"), "value", "rank")


def audit_sources(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of (text, lang, source)."""
    counts = stored(count_terms(docs), "term-counts")
    terms = number_terms(counts, min_documents)
    entries = counts.drop("docs").where("term IS NOT NULL").join(terms, ["lang", "term"])
    entries = stored(entries, "group-terms")
    groups = group_totals(counts, entries, terms, tile)
    values = source_pairs(build_bitsets(entries), groups)
    by_value = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = values.withColumn("rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionByName(excess_terms(entries, groups, top).withColumn("part", F.lit("term")).select(*columns))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language and source of the documents table."""
    return audit_sources(table(spark, sf_dir, "documents"))


_SMOOTHED = "CAST(1 + CAST(1000000000 AS HUGEINT) * ({} + 1) // ({} + v) AS HUGEINT)"
OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= {MIN_DOCUMENTS}
), langs AS (
  SELECT l.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k USING (lang) GROUP BY l.lang
), counted AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL
), pairs AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counted c USING (lang, source) GROUP BY ALL
), spelled AS (
  SELECT p.lang, p.source, k.term, coalesce(c.n, 0) AS n, {_SMOOTHED.format("coalesce(c.n, 0)", "p.total")} AS p,
         {_SMOOTHED.format("k.n", "l.total")} AS q
  FROM pairs p JOIN langs l USING (lang) JOIN kept k ON k.lang = p.lang
  LEFT JOIN counted c ON c.lang = p.lang AND c.source = p.source AND c.term = k.term
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM spelled a JOIN spelled b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM spelled WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM valued QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
