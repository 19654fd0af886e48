"""Removal of repeated passages by relative Lempel-Ziv parsing.

A document is parsed against the documents with smaller ids: a factor is a run of words that one of them holds, all else is
literal. Factors of WINDOW words or more are duplicate spans. The reference is indexed in blocks, the shards of its windows
of WINDOW words, with the smallest id that holds each. A factor of at least WINDOW words is a run of windows in the index, so
the greedy parse extends a factor as long as the next window is there too. Where a factor ends and the next begins, the windows
across that boundary have been looked up like any other, so a passage that the greedy parse would cut in two is still found.

Looking up every window of every document would shuffle the whole corpus many times over. A window's anchor is the least hash
among its runs of ANCHOR words. Equal windows have equal anchors, so a window whose anchor only one document has cannot
repeat in another. The first exchange finds the shared anchors, the second looks up the windows they stand for. Both are
reduced within a block of documents first: a passage that a third of all documents hold is one entry per block.

Windows are compared by 96 bits of two independent hashes.

Defined cases: a null or empty text has no words; a null id counts as larger than all others; rows with equal ids do not remove
words from each other; an empty table gives no rows; other columns are ignored. Ids are whole numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import mixed, run_hashes, sliding_min, space_words, stored, table
from changefold.llm.exchange import answered, block_of, packed, requests, shard_count, text_blocks, unpacked

WINDOW = 50
ANCHOR = 20
ANSWER = "block long, shard long, step int, answer binary"
_LAST = np.iinfo(np.int64).max


class Windows:
    """The windows of a block: their starts among its words, documents and anchors."""

    def __init__(self, row):
        import xxhash

        self.lengths, self.distinct, self.words = block_of(row)
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct), np.uint64, len(self.distinct))[self.words]
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.ids = np.array([_LAST if x is None else int(x) for x in row["doc_ids"]], np.int64)
        if len(self.words) < WINDOW:
            self.start, self.anchor = np.empty(0, np.int64), np.empty(0, np.uint64)
            return
        inside = self.doc[: len(self.words) - WINDOW + 1] == self.doc[WINDOW - 1 :]
        self.start = np.flatnonzero(inside)
        self.anchor = sliding_min(run_hashes(self.hashes, ANCHOR), WINDOW - ANCHOR + 1)[self.start]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchors, and whether more than one id of the block has them."""
        ids = self.ids[self.doc[self.start]]
        change = np.ones(len(self.anchor), bool)  # neighbours mostly share their anchor
        change[1:] = (self.anchor[1:] != self.anchor[:-1]) | (ids[1:] != ids[:-1])
        return least_and_several(self.anchor[change], ids[change])[::2]

    def shared(self, keys: np.ndarray, bits: np.ndarray) -> None:
        """Keep only windows whose anchor is shared."""
        self.start = self.start[bits[np.searchsorted(keys, self.anchor)]]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the kept windows: distinct hashes, the first window of each, the smallest id, and each window's place among them."""
        full = run_hashes(self.hashes, WINDOW)[self.start] if len(self.start) else np.empty(0, np.uint64)
        keys, first, place = np.unique(full, return_index=True, return_inverse=True)
        least = np.full(len(keys), _LAST, np.int64)
        np.minimum.at(least, place, self.ids[self.doc[self.start]])
        return keys, first, least, place

    def second(self, windows: np.ndarray) -> np.ndarray:
        """The second hash of some of the kept windows."""
        if not len(windows):
            return np.empty(0, np.uint32)
        second = run_hashes(mixed(self.hashes ^ np.uint64(0x5851F42D4C957F2D)), WINDOW)
        return (second[self.start[windows]] >> np.uint64(32)).astype(np.uint32)


def least_and_several(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest id, and whether they have more than one id."""
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    if not len(starts):
        return keys, ids, np.empty(0, bool)
    least, most = np.minimum.reduceat(ids, starts), np.maximum.reduceat(ids, starts)
    return keys[starts], least, least != most


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns)


def shared_anchors(blocks: DataFrame, shards: int) -> DataFrame:
    """Answers by block: for each anchor, whether documents of different ids have it."""

    def ask(frames):
        for frame in frames:
            for row in frame.to_dict("records"):
                keys, several = Windows(row).anchors()
                yield _frame(requests(row["block"], keys, shards, several), ["block", "shard", "keys", "several"])

    def answer(key, frame):
        keys = [unpacked(x, np.uint64) for x in frame["keys"]]
        every, counts = np.unique(np.concatenate(keys), return_counts=True)
        good = counts > 1
        for own, several in zip(keys, frame["several"]):
            good[np.searchsorted(every, own[unpacked(several, bool)])] = True
        bits = [packed(good[np.searchsorted(every, own)]) for own in keys]
        return _frame([(b, key[0], 1, x) for b, x in zip(frame["block"], bits)], ["block", "shard", "step", "answer"])

    asked = blocks.mapInPandas(ask, "block long, shard long, keys binary, several binary")
    return stored(asked.groupBy("shard").applyInPandas(answer, ANSWER), "anchors")


def repeated_windows(blocks: DataFrame, anchors: DataFrame, shards: int) -> DataFrame:
    """Answers by block: for each window with a shared anchor, whether a smaller id than any of the block has it."""

    def ask(frame, answers):
        rows = []
        for row in frame.to_dict("records"):
            windows = Windows(row)
            keys, _ = windows.anchors()
            windows.shared(keys, answered(keys, shards, dict(zip(answers["shard"], answers["answer"])), bool))
            full, first, least, _ = windows.entries()
            rows += requests(row["block"], full, shards, windows.second(first), least)
        return _frame(rows, ["block", "shard", "keys", "second", "least"])

    def answer(key, frame):
        keys, second, least = (
            [unpacked(x, kind) for x in frame[name]] for name, kind in (("keys", np.uint64), ("second", np.uint32), ("least", np.int64))
        )
        all_keys, all_second, all_least = map(np.concatenate, (keys, second, least))
        order = np.lexsort((all_least, all_second, all_keys))
        k, s = all_keys[order], all_second[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        first = all_least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        found = np.empty(len(k), bool)
        found[order] = first < all_least[order]
        bits = np.split(found, np.cumsum([len(x) for x in keys])[:-1])
        return _frame([(b, key[0], 2, packed(x)) for b, x in zip(frame["block"], bits)], ["block", "shard", "step", "answer"])

    asked = blocks.groupBy("block").cogroup(anchors.groupBy("block"))
    asked = asked.applyInPandas(ask, "block long, shard long, keys binary, second binary, least binary")
    return stored(asked.groupBy("shard").applyInPandas(answer, ANSWER), "windows")


def factors(starts: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """The factors (start, end) of a document from the sorted starts of its windows that the reference holds: a factor is
    extended while the next window is there; one that begins before the last has ended overlaps it."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(part[0]), int(part[-1]) + window) for part in np.split(starts, cut)]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, n_factors, kept) of (doc_id, text), `kept` being the words that stay, joined by spaces."""
    blocks = text_blocks(docs, space_words)
    shards = shard_count(blocks)
    anchors = shared_anchors(blocks, shards)
    answers = anchors.unionAll(repeated_windows(blocks, anchors, shards))

    def parse(frame, answers):
        out = []
        for row in frame.to_dict("records"):
            windows = Windows(row)
            keys, _ = windows.anchors()
            by_step = [dict(zip(a["shard"], a["answer"])) for a in (answers[answers["step"] == n] for n in (1, 2))]
            windows.shared(keys, answered(keys, shards, by_step[0], bool))
            full, _, least, place = windows.entries()
            ids = windows.ids[windows.doc[windows.start]]
            found = windows.start[answered(full, shards, by_step[1], bool)[place] | (least[place] < ids)]
            ends = np.cumsum(windows.lengths)
            word_of = windows.distinct.__getitem__
            for doc, size, end in zip(row["doc_ids"], windows.lengths, ends):
                begin = end - size
                low, high = np.searchsorted(found, (begin, end))
                spans, kept, at = factors(found[low:high] - begin), [], 0
                for start, stop in spans:
                    kept += map(word_of, windows.words[begin + at : begin + max(at, start)].tolist())
                    at = max(at, stop)
                kept += map(word_of, windows.words[begin + at : end].tolist())
                out.append((doc, int(size), int(size) - len(kept), len(spans), b" ".join(kept).decode()))
        return _frame(out, ["doc_id", "n_words", "n_removed", "n_factors", "kept"])

    parsed = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    kept = parsed.applyInPandas(parse, "doc_id string, n_words long, n_removed long, n_factors long, kept string")
    return kept.withColumn("doc_id", F.col("doc_id").cast("long"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove from every document the passages that documents with smaller ids hold."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "n_factors")
