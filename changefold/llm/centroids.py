"""Centroid clustering of integer vectors whose dimension blocks are dictionary-encoded.

Vectors are kept in segments of SEGMENT, as columnar files keep row groups. In a segment each block of WIDTH dimensions is a
dictionary of its distinct subvectors and a code for each vector, without loss. A round computes the exact distances of each
distinct subvector to each centroid's part once per segment and sums them by code, so the work on components follows the
dictionaries and not the vectors, and copies cost a look-up. A task sends one row of sums per cluster; what reaches the driver
is one number per cluster and dimension. Nothing is exchanged between vectors, so neither hot vectors nor hot clusters matter,
and a segment bounds the memory of a task.

Defined cases: vectors of another length, with null, or with non-finite components are left out, and so is a null vector.
Components beyond LIMIT in size after scaling are held at it, so that every distance fits in 64 bits. A null id sorts after all
others when the first centroids are chosen, repeated ids by their vectors; rows are never merged. With fewer vectors than
clusters there are as many clusters as vectors, and none without vectors. Sums over distances beyond 64 bits are held at the
largest. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import stored, table
from changefold.llm.exchange import packed, unpacked

#: Vectors of a segment; codes are 16 bits, so at most 65,536.
SEGMENT = 16_384
#: Dimensions of a block.
WIDTH = 2
#: Distances of so many vectors and centroids are held at a time.
HELD = 1 << 21
LIMIT = 1 << 27
LARGEST = (1 << 63) - 1

CLUSTERS, ROUNDS, SCALE, DIMENSIONS = 16, 3, 64, 64


def integer_vectors(vectors: DataFrame, scale: int = SCALE, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, vector): the usable rows of (vec_id, embedding), each component floor(scale * x)."""
    parts = F.col("embedding").cast("array<double>")
    odd = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.where(F.coalesce((F.size("embedding") == dimensions) & ~odd, F.lit(False)))
    held = F.transform(
        parts, lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int")
    )
    return usable.select("vec_id", held.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 1) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of seed and id, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    return [list(row["vector"]) for row in rows]


def encode_segments(vectors: DataFrame, width: int = WIDTH, segment: int = SEGMENT) -> DataFrame:
    """Stored segments of (vec_id, vector): (vec_ids, sizes, subvectors, codes). `sizes` are those of the dictionaries, block
    after block; `subvectors` has their entries and `codes` an entry's number for each block and vector, both packed."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def segments(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def emit(ids, rows):
            found = [distinct(rows[:, at : at + width]) for at in range(0, rows.shape[1], width)]
            columns = [
                pa.array([ids], pa.list_(ids.type)),
                pa.array([[len(entries) for entries, _ in found]], pa.list_(pa.int32())),
                pa.array([packed(np.concatenate([entries.ravel() for entries, _ in found]))], pa.binary()),
                pa.array([packed(np.concatenate([codes for _, codes in found]))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["vec_ids", "sizes", "subvectors", "codes"])

        ids, rows, held = [], [], 0
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at in range(0, batch.num_rows, segment):
                ids.append(batch.column(0)[at : at + segment])
                rows.append(values[at : at + segment])
                held += len(rows[-1])
                if held >= segment:
                    ready_ids, ready = pa.concat_arrays(ids), np.concatenate(rows)
                    yield emit(ready_ids[:segment], ready[:segment])
                    ids, rows, held = [ready_ids[segment:]], [ready[segment:]], held - segment
        if held:
            yield emit(pa.concat_arrays(ids), np.concatenate(rows))

    schema = f"vec_ids array<{kind}>, sizes array<int>, subvectors binary, codes binary"
    return stored(vectors.mapInArrow(segments, schema), "segments")


def distinct(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of an int32 block, and the number of each row among them."""
    rows = np.ascontiguousarray(block, np.int32)
    width = rows.shape[1]
    whole = np.dtype(f"i{4 * width}") if width <= 2 else np.dtype((np.void, 4 * width))
    entries, codes = np.unique(rows.view(whole).ravel(), return_inverse=True)
    return entries.view(np.int32).reshape(-1, width), codes.astype(np.uint16)


class Segment:
    """A stored segment, decoded to dictionaries and codes."""

    def __init__(self, sizes: list[int], subvectors: bytes, codes: bytes, dimensions: int, width: int):
        values, at = unpacked(subvectors, np.int32).astype(np.int64), 0
        self.codes = unpacked(codes, np.uint16).reshape(len(sizes), -1)
        self.width, self.dictionaries = width, []
        for block, size in enumerate(sizes):
            wide = min(width, dimensions - block * width)
            self.dictionaries.append(values[at : at + size * wide].reshape(size, wide))
            at += size * wide

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, the first of equals, and its squared distance."""
        tables = [
            sum((entries[:, i, None] - centroids[None, :, at + i]) ** 2 for i in range(entries.shape[1]))
            for entries, at in zip(self.dictionaries, range(0, centroids.shape[1], self.width))
        ]
        n, step = self.codes.shape[1], max(1, HELD // len(centroids))
        cluster, distance = np.empty(n, np.int64), np.empty(n, np.int64)
        for start in range(0, n, step):
            part = slice(start, start + step)
            total = np.zeros((len(self.codes[0, part]), len(centroids)), np.int64)
            for sums, codes in zip(tables, self.codes):
                total += sums[codes[part]]
            cluster[part] = total.argmin(1)
            distance[part] = total.min(1)
        return cluster, distance

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Componentwise sums by cluster. A segment's sums stay below 2^53, so that those of doubles are exact."""
        columns = [
            np.bincount(cluster, entries[codes, i], clusters)
            for entries, codes in zip(self.dictionaries, self.codes)
            for i in range(entries.shape[1])
        ]
        return np.stack(columns, 1).astype(np.int64)


def measured(segments: DataFrame, centroids: list[list[int]], width: int = WIDTH) -> dict[int, list[int]]:
    """Of each cluster with vectors: their number, the sum of their distances, and their componentwise sums."""
    held = np.array(centroids, np.int64)

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        clusters, dimensions = held.shape
        counts, sums, inertia = np.zeros(clusters, np.int64), np.zeros(held.shape, np.int64), [0] * clusters
        for batch in batches:
            for row in batch.to_pylist():
                found = Segment(row["sizes"], row["subvectors"], row["codes"], dimensions, width)
                cluster, distance = found.nearest(held)
                counts += np.bincount(cluster, minlength=clusters)
                sums += found.sums(cluster, clusters)
                for half, unit in ((distance >> 31, 1 << 31), (distance & 0x7FFFFFFF, 1)):
                    for c, part in enumerate(np.bincount(cluster, half, clusters)):
                        inertia[c] += int(part) * unit
        used = [int(c) for c in np.flatnonzero(counts)]
        rows = [[Decimal(int(x)) for x in (counts[c], inertia[c], *sums[c])] for c in used]
        columns = [pa.array(used, pa.int32()), pa.array(rows, pa.list_(pa.decimal128(38, 0)))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "measures"])

    tasks = segments.select("sizes", "subvectors", "codes").mapInArrow(partial, "cluster int, measures array<decimal(38,0)>")
    totals = tasks.select("cluster", F.posexplode("measures").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("x"))
    out: dict[int, list[int]] = {}
    for row in totals.orderBy("cluster", "at").collect():  # clusters times dimensions
        out.setdefault(row["cluster"], []).append(int(row["x"]))
    return out


def moved(centroids: list[list[int]], measures: dict[int, list[int]]) -> list[list[int]]:
    """Each centroid with vectors goes to the componentwise floor of their mean."""
    return [[s // measures[c][0] for s in measures[c][2:]] if c in measures else old for c, old in enumerate(centroids)]


def fit(segments: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS, width: int = WIDTH) -> list[list[int]]:
    """The centroids after so many rounds."""
    for _ in range(rounds):
        centroids = moved(centroids, measured(segments, centroids, width))
    return centroids


def assign(segments: DataFrame, centroids: list[list[int]], width: int = WIDTH) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    kind = segments.schema["vec_ids"].dataType.elementType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    measures = measured(segments, centroids, width) if centroids else {}
    every = [measures[c][1] if c in measures else 0 for c in range(len(centroids))]
    whole = min(sum(every), LARGEST)
    own = np.array([min(x, LARGEST) for x in every], np.int64)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    held = np.array(centroids, np.int64)

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = pa.array(digests, pa.string())
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column(0)[at].values
                stored_row = [batch.column(i)[at].as_py() for i in (1, 2, 3)]
                cluster, distance = Segment(*stored_row, held.shape[1], width).nearest(held)
                columns = [
                    ids,
                    pa.array(cluster, pa.int32()),
                    pa.array(distance, pa.int64()),
                    pa.array(own[cluster], pa.int64()),
                    pa.array(np.full(len(cluster), whole, np.int64)),
                    names.take(pa.array(cluster)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return segments.select("vec_ids", "sizes", "subvectors", "codes").mapInArrow(rows, schema)


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all embeddings after three rounds."""
    segments = encode_segments(integer_vectors(table(spark, sf_dir, "embeddings")))
    centroids = first_centroids(integer_vectors(table(spark, sf_dir, "embeddings")))
    return assign(segments, fit(segments, centroids) if centroids else [])


def _rounds_sql(rounds: int) -> str:
    parts = []
    for r in range(rounds + 1):
        distance = "list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))"
        parts.append(f"""
d{r} AS (SELECT k.rid, k.vec_id, k.v, c.c, {distance} AS d FROM kept k, c{r} c),
a{r} AS (SELECT * FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY c, i),
m{r} AS (SELECT c, list(CAST(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY c),
c{r + 1} AS (SELECT c{r}.c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))""")
    return ",".join(parts)


OP13_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= 16
), {_rounds_sql(ROUNDS).lstrip()}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (c)
"""
