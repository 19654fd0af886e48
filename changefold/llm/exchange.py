"""Exchange between blocks of documents and shards of keys, in arrays rather than rows.

A block holds the words of some BLOCK_WORDS words of whole documents, read once and stored. Each step of an operator turns a
block into requests: per shard of the key space one row with the block's distinct keys, so whatever a block repeats is
reduced before the shuffle and a key that a third of all documents share is one entry per block. A shard answers with one
array per request, in the order of its keys, and the answers meet their block again. Rows are few and large, keys are shuffled
as packed arrays, and both blocks and shards are bounded, whatever the data: their number grows instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.common import Numbers, lean, stored

BLOCK_WORDS = 1_000_000
#: Words of the corpus for each shard of keys.
SHARD_WORDS = 2_000_000


def packed(array: np.ndarray) -> bytes:
    """An array as compressed bytes, to be read with `unpacked` by the same type."""
    import pyarrow as pa

    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind) -> np.ndarray:
    import pyarrow as pa

    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), kind)


def by_place(array: np.ndarray) -> bytes:
    """An array of numbers as compressed bytes, those of one place in the numbers together, as the high ones hardly vary."""
    return packed(np.ascontiguousarray(array).view(np.uint8).reshape(-1, array.itemsize).T)


def placed(data: bytes, kind) -> np.ndarray:
    """What `by_place` packed."""
    return np.ascontiguousarray(unpacked(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def firsts_marked(numbers: np.ndarray) -> bytes:
    """Numbers of words, given in the order in which words are first met, as compressed bytes. A first one follows from the
    place, so it is a 0, and all others are raised by 1."""
    top, first = np.maximum.accumulate(numbers), np.ones(len(numbers), bool)
    first[1:] = top[1:] > top[:-1]
    return by_place(np.where(first, np.uint32(0), numbers + np.uint32(1)))


def numbers_of(data: bytes) -> np.ndarray:
    """The numbers that `firsts_marked` packed."""
    marked = placed(data, np.uint32)
    first = np.flatnonzero(marked == 0)
    numbers = marked - np.uint32(1)
    numbers[first] = np.arange(len(first), dtype=np.uint32)
    return numbers


def text_blocks(docs: DataFrame, words_of, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Stored blocks of (doc_id, text): (block, doc_ids, n_words, lengths, distinct, words), the last three packed. Ids are text, as
    a list of whole numbers with a null is one of doubles to pandas.

    `words_of` gives a text's words as bytes without white space; `distinct` joins those of all documents by spaces, each once,
    and `words` has their numbers there, one for each word of the texts."""

    @lean
    def blocks(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, texts, numbers, held = [], [], Numbers(), 0

        def emit():
            lengths = np.array([len(x) for x in texts], np.int64)
            columns = [
                pa.array([task << 32 | number], pa.int64()),
                pa.array([ids], pa.list_(pa.string())),
                pa.array([int(lengths.sum())], pa.int64()),
                pa.array([packed(lengths)], pa.binary()),
                pa.array([packed(np.frombuffer(b" ".join(numbers), np.uint8))], pa.binary()),
                pa.array([firsts_marked(np.concatenate(texts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["block", "doc_ids", "n_words", "lengths", "distinct", "words"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                own = words_of(text.as_py())
                ids.append(doc.as_py())
                texts.append(np.fromiter(map(numbers.__getitem__, own), np.uint32, len(own)))
                held += len(own) + 1
                if held >= block_words:
                    yield emit()
                    number, ids, texts, numbers, held = number + 1, [], [], Numbers(), 0
        if ids:
            yield emit()

    schema = "block long, doc_ids array<string>, n_words long, lengths binary, distinct binary, words binary"
    return stored(docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(blocks, schema), "blocks")


def block_of(row) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The numbers of words of a block's documents, its distinct words, and the number of each word among those."""
    return unpacked(row["lengths"], np.int64), unpacked(row["distinct"], np.uint8).tobytes().split(), numbers_of(row["words"])


def shard_count(blocks: DataFrame, shard_words: int = SHARD_WORDS) -> int:
    """How many shards of keys a corpus gets: in proportion to its words."""
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    return max(16, -(-total // shard_words))


def requests(block: int, keys: np.ndarray, shards: int, *values: np.ndarray) -> list[tuple]:
    """Rows (block, shard, keys, values...) of sorted distinct uint64 keys, packed, one for each shard that any key is of."""
    order, bounds = shard_order(keys, shards)
    rows = []
    for shard in np.flatnonzero(np.diff(bounds)):
        at = order[bounds[shard] : bounds[shard + 1]]
        rows.append((block, int(shard), *(packed(x[at]) for x in (keys, *values))))
    return rows


def shard_order(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted keys by shard, then key, and the bounds of the shards in it."""
    shard = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def answered(keys: np.ndarray, shards: int, answers: dict[int, bytes], kind) -> np.ndarray:
    """The answers to the requests of `keys`, by key."""
    order, bounds = shard_order(keys, shards)
    out = np.empty(len(keys), kind)
    for shard, data in answers.items():
        out[order[bounds[shard] : bounds[shard + 1]]] = unpacked(data, kind)
    return out
