"""Packing documents into token sequences by bin completion.

Every document is tokenised whole, ended by one end id, and cut only if it is longer than a sequence. Packing needs just
the number of pieces of each length, a histogram of at most `capacity` rows whatever the size of the corpus: the plan is
a list of fillings (lengths that share a sequence) with multiplicities. Pieces then find their place from their rank among
the pieces of their length. The rank is the piece's own rank within the block of rows a task read, plus the number of such
pieces in earlier blocks, so a length that a third of all pieces have is never gathered in one task.

`fill` is a branch and bound by bin completion: it takes the largest length left, enumerates undominated fillings around
it, applies one as often as the counts allow, and goes on; a branch ends where the waste so far exceeds what would still
beat the incumbent, which starts as best fit decreasing. Past MAX_NODES nodes the incumbent stands, which is always a whole
packing. It stops at once where the incumbent needs no more sequences than the tokens do.

Defined cases: a null or empty text is one piece of the end id; null and repeated ids are rows of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefold.llm.common import lean, stored, table

CAPACITY = 4096
END_ID = 1
MAX_NODES = 2000
#: Words that a task remembers; its memory is emptied when it holds more.
REMEMBERED = 400_000
#: How the tokenizer cuts small letters, numbers, and the rest between white space, within the first 256 code points.
_LETTER, _NUMBER, _SPACE = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x09-\x0d\x20\x85\xa0"
_CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_tokenizers: dict = {}


class WordTokenizer:
    """Token ids of texts. The tokenizer cuts a text into words before it encodes each by itself, so a word seen before need
    not be encoded again. Texts of the first 256 code points, where small letters and cuts are plain, are cut here; the
    chunks between white space of other texts, which the tokenizer never joins, are words too. Words of letters alone are
    encoded many at a time and told apart by the tokens that end a word."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.pool, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def words(text: str) -> list[str]:
        if "<|" not in text and (text.isascii() or max(text) <= "\xff"):  # a special token's name is no word
            return _CUT.findall(text.lower())
        return [chunk.decode() for chunk in text.encode().split()]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self.forget()
        number = self.numbers.__getitem__
        numbered = [np.fromiter(map(number, own), np.int64, len(own)) for own in map(self.words, texts)]
        self._learn()
        out = []
        for at in numbered:
            n = self.sizes[at]
            ends = np.cumsum(n)
            out.append(self.pool[np.repeat(self.starts[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)])
        return out

    def _learn(self) -> None:
        """Encode the words that have got a number since the last time."""
        new, known, held = self.numbers.new, len(self.sizes), len(self.pool)
        self.numbers.new = []
        starts, sizes, pool = np.empty(len(new), np.int64), np.empty(len(new), np.int64), [self.pool]

        def encoded(text: str) -> np.ndarray:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

        letters = np.fromiter((x.isalpha() for x in new), bool, len(new))
        plain, rest = np.flatnonzero(letters), np.flatnonzero(~letters).tolist()
        for at in range(0, len(plain), 500):
            some = plain[at : at + 500]
            ids = encoded(" ".join([new[i] for i in some]))
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):  # a letter whose small form is more than a letter
                rest += some.tolist()
                continue
            sizes[some] = np.diff(ends, prepend=0)
            starts[some] = held + ends - sizes[some]
            pool.append(ids)
            held += len(ids)
        for i in rest:
            ids = encoded(new[i])
            starts[i], sizes[i] = held, len(ids)
            pool.append(ids)
            held += len(ids)
        assert known + len(new) == len(self.numbers)
        self.pool, self.starts, self.sizes = np.concatenate(pool), np.append(self.starts, starts), np.append(self.sizes, sizes)


class _Numbers(dict):
    """Numbers of words, given as they are first asked for; `new` has the words since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


def tokenizer_of(path: str) -> WordTokenizer:
    """One tokenizer for each worker process; a task empties its memory at its end."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, block, place) of (doc_id, text): `place` counts from 0 the pieces of a
    length within a block. Store the result before its blocks are used twice."""

    @lean
    def rows(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        encode, task, block = tokenizer_of(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out, seen = [], {}
                for doc, ids in zip(part.column(0).to_pylist(), encode.ids([x or "" for x in part.column(1).to_pylist()])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for number, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        place = seen[len(piece)] = seen.get(len(piece), -1) + 1
                        out.append((doc, number, start, len(piece), zlib.crc32(piece.tobytes()), task << 32 | block, place))
                block += 1
                columns = [*zip(*out)]
                kinds = [batch.schema.field(0).type, pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        encode.forget()  # the worker lives on through other stages, and few of a task's words are new to it by the end

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "block", "place"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, piece int, " + ", ".join(f"{n} long" for n in names[2:])
    )


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over a histogram: fillings with their multiplicities."""
    room: dict[int, list[list]] = {}  # by free space: fillings with multiplicities
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = min((r for r in room if r >= length), default=None)
            filling, times = room[free].pop() if free is not None else ((), left)
            if free is not None and not room[free]:
                del room[free]
            free = capacity if free is None else free
            each = min(free // length, left)
            taken = min(times, left // each)
            if times > taken and filling:
                room.setdefault(free, []).append([filling, times - taken])
            room.setdefault(free - each * length, []).append([filling + (length,) * each, taken])
            left -= each * taken
    merged: dict[tuple[int, ...], int] = {}
    for filling, times in (x for group in room.values() for x in group):
        merged[filling] = merged.get(filling, 0) + times
    return list(merged.items())


def completions(counts: dict[int, int], room: int, width: int = 4) -> list[tuple[int, ...]]:
    """Undominated fillings of `room` from `counts`, the least waste first, at most `width` of them.

    A filling is dominated by one of as many pieces, each at least as long. For each number of pieces up to 3 the fullest
    filling is found with the longest pieces first; the fullest of any number comes from a subset-sum table."""
    lengths = sorted((x for x in counts if x <= room and counts[x]), reverse=True)
    found: set[tuple[int, ...]] = set()
    if not lengths:
        return [()]
    found.add((lengths[0],))
    here = set(lengths)

    def best_pair(space: int, most: int, used: int) -> tuple[int, ...] | None:
        best, low, small = None, 0, lengths[::-1]
        j = 0
        for a in lengths:
            if a > most or a >= space:
                continue
            while j < len(small) and small[j] <= space - a:
                j += 1
            k = min(j - 1, len(small) - 1)
            while k >= 0 and (small[k] > a or counts[small[k]] < 1 + (small[k] == a) + (small[k] == used)):
                k -= 1
            if k >= 0 and counts[a] >= 1 + (a == used) and a + small[k] > low:
                best, low = (a, small[k]), a + small[k]
                if low == space:
                    break
        return best

    pair = best_pair(room, room, 0)
    if pair:
        found.add(pair)
    for a in lengths[:2]:
        if a < room and (pair := best_pair(room - a, a, a)):
            found.add((a, *pair))
    reach, steps = 1, []
    for a in lengths:
        for _ in range(min(counts[a], room // a)):
            wider = reach | (reach << a) & ((1 << (room + 1)) - 1)
            if wider == reach:
                break
            steps.append((a, reach))
            reach = wider
        if reach >> room & 1:
            break
    total, filling = reach.bit_length() - 1, []
    for a, before in reversed(steps):
        if not before >> total & 1:
            filling.append(a)
            total -= a
    found.add(tuple(sorted(filling, reverse=True)))
    assert here.issuperset(filling)

    def dominated(x: tuple[int, ...]) -> bool:
        return any(x != y and len(x) == len(y) and all(a <= b for a, b in zip(x, y)) for y in found)

    return sorted((x for x in found if not dominated(x)), key=lambda x: (-sum(x), len(x)))[:width]


def fill(counts: dict[int, int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> list[tuple[tuple[int, ...], int]]:
    """Fillings with multiplicities that hold every piece of a histogram, in as few sequences as the search finds."""
    counts = {length: n for length, n in counts.items() if n}
    tokens = sum(length * n for length, n in counts.items())
    least = -(-tokens // capacity)
    best = best_fit(counts, capacity)
    n_best = sum(times for _, times in best)
    stack, nodes = [(counts, (), 0)], 0  # pieces left, fillings chosen as a linked list, sequences used
    while stack and n_best > least and nodes < max_nodes:
        left, chosen, used = stack.pop()
        nodes += 1
        if not left:
            if used < n_best:
                n_best, best = used, []
                while chosen:
                    chosen, filling, times = chosen
                    best.append((filling, times))
            continue
        if used + -(-sum(length * n for length, n in left.items()) // capacity) >= n_best:
            continue
        largest = max(left)
        others = dict(left)
        others[largest] -= 1
        branches = []
        for rest in completions(others, capacity - largest):
            filling = (largest, *rest)
            need = {x: filling.count(x) for x in filling}
            times = min(left[x] // n for x, n in need.items())
            after = {x: n - times * need.get(x, 0) for x, n in left.items() if n > times * need.get(x, 0)}
            branches.append((after, (chosen, filling, times), used + times))
        stack.extend(reversed(branches))
    return best


class Places:
    """Where the piece of a length with a given rank goes, from the fillings of a plan."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]]):
        base, spans = 0, {}
        for filling, times in plan:
            offset = 0
            for length in filling:  # one slot of `times` sequences
                spans.setdefault(length, []).append((times, base, offset))
                offset += length
            base += times
        self.starts, self.base, self.offset = {}, {}, {}
        for length, slots in spans.items():
            times, self.base[length], self.offset[length] = (np.array(x, np.int64) for x in zip(*slots))
            self.starts[length] = np.cumsum(times) - times

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            slot = np.searchsorted(self.starts[x], rank[at], "right") - 1
            sequence[at] = self.base[x][slot] + rank[at] - self.starts[x][slot]
            offset[at] = self.offset[x][slot]
        return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> DataFrame:
    """Stored `pieces` with `sequence_id` and `offset`. The plan that tasks get has at most a few fillings per length."""
    by_block = cut.groupBy("block", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_block.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(fill(histogram, capacity, max_nodes))
    ranked = cut.join(earlier, ["block", "length"]).withColumn("rank", F.col("earlier") + F.col("place"))

    def placed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            found = [pa.array(x) for x in places(length, rank)]
            kept = [batch.column(name) for name in kept_names]
            yield pa.RecordBatch.from_arrays(kept + found, [*kept_names, "sequence_id", "offset"])

    kept_names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = cut.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*kept_names, "rank").mapInArrow(placed, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of at most CAPACITY tokens."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
