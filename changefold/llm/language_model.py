"""Scoring by a bigram language model in Elias-Fano tries.

Tokens are the small words of a text and one end. The base is the unigram probability with 0.1 added to each count. The model
is P(w | v) = K * c(v, w) / c(v) + (1 - K) * P(w), with words of fewer than MIN_COUNT occurrences taken as one class, within
which the base decides; it is a proper distribution over words. Counts are taken over all training texts.

The pairs are sharded by their context. A context of HOT or more occurrences is spread over all shards by its successors.
Each shard holds its contexts, the pointers to their successors, the successors and their quantised log probabilities, all
monotone sequences in Elias-Fano form within one flat buffer that is read in place, and never as a whole on the driver or in
one task. A pair is found by its context's rank, the pointers of that rank, and a successor search between them; the
interpolation with the word's own probability, which the text's block has, is added to what the trie holds.

Texts meet the tries in exchanges between blocks and shards: a block sends each distinct word and pair once.

Words are told apart by 64-bit hashes: of 10^9 distinct words, a pair collides with probability 0.03.

Defined cases: a null or empty text is one end; a null id is held out; repeated ids are rows of their own; without training
texts each token has probability 1 of being unknown; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import mixed, paired, stored, table
from changefold.llm.elias_fano import Trie
from changefold.llm.exchange import BLOCK_WORDS, SHARD_WORDS, packed, shard_order, unpacked

MIN_COUNT = 5
KEEP = 0.7
#: Occurrences from which a context is spread over all shards.
HOT = SHARD_WORDS // 8
#: Hash of the end token, which no word has but by a 64-bit collision.
END = np.uint64(0xE9D0F1A2B3C4D5E6)
BEGIN_ID, RARE_ID = 0, 1
WORD_ANSWER = "block long, shard long, counts binary, ids binary, tokens long, kinds long, rare_tokens long, rare_kinds long"
PAIR_ANSWER = "block long, shard long, codes binary, low double, step double"


def small_words(text: str | None) -> list[bytes]:
    """Words `[^\x20\x09-\x0D]+` of the text with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(doc_id) -> bool:
    """Whether the document is kept out of training; ids are text in blocks, for pandas takes whole numbers beside a null as doubles."""
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % 10 == 0


def token_blocks(docs: DataFrame, shards: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Stored blocks of (doc_id, text) and their words. A block's row has its documents (doc_ids, lengths, ends included) and
    for each token the number of its word, `end` being that of the end; its words are numbered by shard, then hash. A row
    with a shard has the hashes of the block's words there and their counts in training texts."""

    def blocks(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def emit():
            lengths = np.array([len(x) + 1 for x in texts], np.int64)
            distinct = list(set().union(*texts))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
            keys, place = np.unique(np.append(hashes, END), return_inverse=True)
            order, bounds = shard_order(keys, shards)
            rank = np.empty(len(keys), np.int64)
            rank[order] = np.arange(len(keys))
            word_of = dict(zip(distinct, rank[place[:-1]].tolist()))
            end = int(rank[place[-1]])
            tokens = np.fromiter(_numbers(texts, word_of, end), np.uint32, lengths.sum())
            train = np.repeat(~np.array([held_out(x) for x in ids], bool), lengths)
            counts = np.bincount(tokens[train], minlength=len(keys)).astype(np.int64)
            block = task << 32 | number
            yield [block], [None], [ids], [packed(lengths)], [packed(tokens)], [end], [None], [None]
            some = [int(x) for x in np.flatnonzero(np.diff(bounds))]
            parts = [slice(bounds[x], bounds[x + 1]) for x in some]
            none = [None] * len(some)
            yield (
                [block] * len(some), some, none, none, none, none, [packed(keys[order[p]]) for p in parts], [packed(counts[p]) for p in parts]
            )

        def batch_of(columns):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), *[pa.binary()] * 2, pa.int64(), *[pa.binary()] * 2]
            for doc, text in zip(batch.column(0), batch.column(1)):
                texts.append(small_words(text.as_py()))
                ids.append(doc.as_py())
                held += len(texts[-1]) + 1
                if held >= block_words:
                    yield from map(batch_of, emit())
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield from map(batch_of, emit())

    names = ["block", "shard", "doc_ids", "lengths", "tokens", "end", "keys", "counts"]
    schema = "block long, shard long, doc_ids array<string>, lengths binary, tokens binary, end long, keys binary, counts binary"
    return stored(docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(blocks, schema), "tokens")


def _numbers(texts: list[list[bytes]], word_of: dict[bytes, int], end: int) -> Iterator[int]:
    for words in texts:
        yield from map(word_of.__getitem__, words)
        yield end


def count_words(blocks: DataFrame, shards: int) -> DataFrame:
    """By block: the corpus counts and ids of its distinct words; by shard (block -1): sums over its words."""

    def answer(key, frame):
        shard = int(key[0])
        keys = [unpacked(x, np.uint64) for x in frame["keys"]]
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        added = np.concatenate([unpacked(x, np.int64) for x in frame["counts"]])
        counts = np.bincount(place, added, len(every)).astype(np.int64)
        ids = np.arange(len(every), dtype=np.int64) * shards + shard + 2
        places = np.split(place, np.cumsum([len(x) for x in keys])[:-1])
        rows = [(b, shard, packed(counts[p]), packed(ids[p]), 0, 0, 0, 0) for b, p in zip(frame["block"], places)]
        rare = (counts < MIN_COUNT) & (counts > 0) & (every != END)
        sums = (counts.sum(), (counts > 0).sum(), counts[rare].sum(), rare.sum())
        rows.append((-1, shard, packed(counts[every == END]), None, *(int(x) for x in sums)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in WORD_ANSWER.split(", ")])

    asked = blocks.filter("shard is not null").select("block", "shard", "keys", "counts")
    return stored(asked.groupBy("shard").applyInPandas(answer, WORD_ANSWER), "words")


def corpus_totals(words: DataFrame, shards: int) -> dict:
    """Sums over the corpus: tokens, distinct tokens, those of the rare class, ends, and the base's denominator."""
    names = ("tokens", "kinds", "rare_tokens", "rare_kinds")
    sums = words.filter("block = -1").agg(*(F.sum(x).alias(x) for x in names)).first()
    totals = {name: int(sums[name] or 0) for name in names}
    row = words.filter(f"block = -1 AND shard = {int(END % np.uint64(shards))}").first()
    ends = unpacked(row["counts"], np.int64) if row else []
    totals["ends"] = int(ends[0]) if len(ends) else 0
    totals["mass"] = totals["tokens"] + 0.1 * (totals["kinds"] + 1)
    return totals


class Tokens:
    """The tokens of a block with what the corpus knows of their words."""

    def __init__(self, row: dict, answers: pd.DataFrame, totals: dict):
        self.ids, self.lengths = list(row["doc_ids"]), unpacked(row["lengths"], np.int64)
        self.held = np.array([held_out(x) for x in self.ids], bool)
        self.word = unpacked(row["tokens"], np.uint32)
        self.first = np.cumsum(self.lengths) - self.lengths
        answers = answers.sort_values("shard")
        self.count = np.concatenate([unpacked(x, np.int64) for x in answers["counts"]])
        ids = np.concatenate([unpacked(x, np.int64) for x in answers["ids"]])
        rare = self.count < MIN_COUNT
        rare[row["end"]] = False
        ids = np.where(rare, RARE_ID, ids)
        self.class_count = np.where(rare, totals["rare_tokens"], self.count)
        mass = np.where(rare, totals["rare_tokens"] + 0.1 * (totals["rare_kinds"] + 1), self.count + 0.1)
        self.class_base = mass / totals["mass"]
        # Distinct pairs by context, then successor, with a word that stands for each.
        own = ids[self.word]
        previous = np.empty_like(own)
        previous[1:] = own[:-1]
        previous[self.first] = BEGIN_ID
        width = int(own.max()) + 1
        keys, at, self.pair = np.unique(previous * width + own, return_index=True, return_inverse=True)
        self.context, self.successor = keys // width, keys % width
        before = self.class_count[self.word[np.maximum(at - 1, 0)]]
        self.in_context = np.where(self.context == BEGIN_ID, totals["ends"], before)
        self.base = self.class_base[self.word[at]]

    def trained(self) -> np.ndarray:
        """How often each pair occurs in training texts."""
        train = np.repeat(~self.held, self.lengths)
        return np.bincount(self.pair[train], minlength=len(self.context)).astype(np.int64)

    def by_shard(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """The order of the pairs by shard and the bounds of the shards in it."""
        context = self.context.astype(np.uint64)
        spread = paired(context, self.successor.astype(np.uint64))
        return shard_order(np.where(self.in_context < HOT, mixed(context + np.uint64(1)), spread), shards)


def quantise(values: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Codes from 1 to 255 with the least value and the step between codes."""
    if not len(values):
        return np.empty(0, np.uint8), 0.0, 0.0
    low, high = float(values.min()), float(values.max())
    step = (high - low) / 254 or 1.0
    return (np.rint((values - low) / step) + 1).astype(np.uint8), low, step


def build_and_look_up(blocks: DataFrame, words: DataFrame, shards: int, totals: dict) -> DataFrame:
    """The tries by shard (block -1, the buffer in `codes`) and by block the codes of its distinct pairs."""

    def ask(frame, answers):
        rows = []
        for row in frame.to_dict("records"):
            tokens = Tokens(row, answers, totals)
            order, bounds = tokens.by_shard(shards)
            trained = tokens.trained()
            for shard in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[shard] : bounds[shard + 1]]
                contexts, first, sizes = np.unique(tokens.context[at], return_index=True, return_counts=True)
                successor = tokens.successor[at]
                steps = np.diff(successor, prepend=0)  # small within a context
                steps[first] = successor[first]
                values = (contexts, sizes, tokens.in_context[at[first]], steps, trained[at])
                rows.append((row["block"], int(shard), *map(packed, values)))
        return pd.DataFrame(rows, columns=["block", "shard", *names])

    def answer(key, frame):
        parts = []
        for values in zip(*(frame[name] for name in names)):
            contexts, sizes, in_context, steps, trained = (unpacked(x, np.int64) for x in values)
            sums = np.cumsum(steps)
            first = np.cumsum(sizes) - sizes
            successor = sums - np.repeat(sums[first] - steps[first], sizes)
            parts.append((np.repeat(contexts, sizes), successor, trained, np.repeat(in_context, sizes)))
        context, successor, trained, in_context = map(np.concatenate, zip(*parts))
        span = int(successor.max()) + 1
        pairs, at, place = np.unique(context * span + successor, return_index=True, return_inverse=True)
        n = np.bincount(place, trained, len(pairs))
        seen = n > 0
        codes, low, step = quantise(np.log10(KEEP * n[seen] / in_context[at[seen]]))
        buffer = Trie.encode(pairs[seen] // span, pairs[seen] % span, codes)
        found = Trie(buffer).find(pairs // span, pairs % span)[place]
        found = np.split(found, np.cumsum([len(x[0]) for x in parts])[:-1])
        rows = [(b, int(key[0]), packed(x), low, step) for b, x in zip(frame["block"], found)]
        rows.append((-1, int(key[0]), buffer, low, step))
        return pd.DataFrame(rows, columns=["block", "shard", "codes", "low", "step"])

    names = ["contexts", "sizes", "in_context", "steps", "trained"]
    schema = "block long, shard long, " + ", ".join(f"{x} binary" for x in names)
    asked = blocks.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(ask, schema)
    return stored(asked.groupBy("shard").applyInPandas(answer, PAIR_ANSWER), "trie")


def score(docs: DataFrame) -> DataFrame:
    """Scores of every row of (doc_id, text) by the model of those that are not held out."""
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(16, letters // (5 * SHARD_WORDS))
    table_of_tokens = token_blocks(docs, shards)
    words = count_words(table_of_tokens, shards)
    totals = corpus_totals(words, shards)
    blocks = table_of_tokens.filter("shard is null").select("block", "doc_ids", "lengths", "tokens", "end")
    tries = build_and_look_up(blocks, words.filter("block >= 0").select("block", "shard", "counts", "ids"), shards, totals)
    none = F.lit(None)
    both = words.select("block", "shard", "counts", "ids", *(none.cast(k).alias(n) for n, k in (("codes", "binary"), ("low", "double"), ("step", "double"))))
    pairs = tries.select("block", "shard", *(none.cast("binary").alias(n) for n in ("counts", "ids")), "codes", "low", "step")
    both = both.unionAll(pairs).filter("block >= 0")

    def scores(frame, answers):
        out = []
        by_word, by_pair = answers[answers["counts"].notna()], answers[answers["counts"].isna()]
        for row in frame.to_dict("records"):
            tokens = Tokens(row, by_word, totals)
            order, bounds = tokens.by_shard(shards)
            pair = np.where(tokens.in_context > 0, 1 - KEEP, 1.0) * tokens.base
            for shard, data, low, step in zip(by_pair["shard"], by_pair["codes"], by_pair["low"], by_pair["step"]):
                codes = unpacked(data, np.uint8).astype(np.float64)
                at = order[bounds[shard] : bounds[shard + 1]][codes > 0]
                pair[at] += 10 ** (low + step * (codes[codes > 0] - 1))
            word = np.log10((tokens.count + 0.1) / totals["mass"])
            model = np.log10(pair)[tokens.pair] + (word - np.log10(tokens.class_base))[tokens.word]
            known = (tokens.count > 0).astype(np.int64)[tokens.word]
            sums = [np.add.reduceat(x, tokens.first) for x in (known, word[tokens.word], model)]
            for doc, held, n, k, base, value in zip(tokens.ids, tokens.held, tokens.lengths, *sums):
                out.append((doc, bool(held), int(n), int(k), totals["tokens"], float(base), float(value)))
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pd.DataFrame(out, columns=names)

    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(scores, schema)
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document."""
    return score(table(spark, sf_dir, "documents"))
