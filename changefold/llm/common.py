"""What the operators share: reading tables, stored intermediate results, words and hashes of texts."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from changefold.session import work_dir

#: Bytes that end a word where words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z; capitals become small.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write `frame` below the shared folder of `spark.checkpoint.dir` and read it back: cuts lineage, survives executors."""
    path = work_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files of frames that `stored` gave, once what was made from them is stored itself."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def give_back() -> None:
    """Return what is freed to the system. A Python worker lives on through later stages, and would keep what its largest task took."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def lean(rows):
    """`rows`, a function for mapInArrow or mapInPandas, that gives memory back once a task is through."""

    @functools.wraps(rows)
    def through(batches: Iterator) -> Iterator:
        yield from rows(batches)
        give_back()

    return through


class Numbers(dict):
    """Numbers of words, given in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def space_words(text: str | None) -> list[bytes]:
    """Words `[^\x20\x09-\x0D]+`, which is how bytes.split() cuts; None has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`; None has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_ALNUM).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer over uint64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes:
    """64-bit hashes of words with a cache that is emptied once it holds `limit` words, so memory stays bounded."""

    def __init__(self, seed: int = 0, limit: int = 300_000):
        self.known, self.seed, self.limit = {}, seed, limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w, self.seed)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One uint64 for each run of `n` consecutive hashes; equal runs get equal values. Runs of 2, 4, 8... are hashed from two
    halves, and a run of n from the two longest such runs that cover it."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    width, held = 1, hashes
    while 2 * width <= n:
        held, width = paired(held[:-width], held[width:]), 2 * width
    return held if width == n else paired(held[: len(hashes) - n + 1], held[n - width :])


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A uint64 for each ordered pair of uint64."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + mixed(b ^ np.uint64(0xA0761D6478BD642F)))


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of `n` values."""
    width, held = 1, values
    while 2 * width <= n:
        held, width = np.minimum(held[:-width], held[width:]), 2 * width
    return held if width == n else np.minimum(held[: len(values) - n + 1], held[n - width :])
