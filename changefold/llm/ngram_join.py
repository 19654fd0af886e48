"""Near-duplicate documents: an exact Jaccard self-join over word shingles by partitioning the universe.

Two sets of sizes s >= l with a Jaccard similarity of at least PERCENT differ in at most H = floor((s + l) (1 - t) / (1 + t))
shingles. Sizes fall into bands, so that a set only needs to look for smaller ones in its own band and the one below. Each
band cuts the universe of shingles by their hash into H + 1 segments, H being the band's largest. Give segment i an allotment
v_i of 0, 1 or 2: if the allotments sum to more than H, some segment of a similar pair differs in fewer than v_i shingles, so
it is equal (v = 1) or equal after one deletion on one side (v = 2). A set is indexed by all its segments and the
one-deletion neighbourhoods of the first RAISED; it probes by an allotment of its own, chosen by cost: an empty segment is
shared by every set of the band that has none there, and one of common shingles alone, such as a line that many texts hold,
by many; those are skipped, and the allotment they leave is made up for by unused segments or by raising one of the first
RAISED to 2. How common a shingle is, a block sees from its own documents. Any allotment is right, so costs need only be
estimates. Keys only suggest pairs. A pair is first compared by sketches, the
parities of the numbers of shingles by bucket: each shingle that one set alone has changes one bit, so the bits in which
sketches differ are a lower bound of the sets' difference and no similar pair is lost; what it leaves is verified on the sets
themselves.

Groups of sets that share a key can be large. Of each key a block sends one set, and of one in STARS keys only pairs with one
leader are suggested first, the set that shares most keys with most others, as the original of a group of near copies does. Verified pairs are joined to components; then keys whose sets still lie in different components
are taken up again, and all their pairs across components that could be similar are verified, so no link between components
is lost. Where more than PAIRED sets share such a key, their sketches are compared in tiles of at most TILE by TILE sets, and
only pairs that could be similar leave a tile. A link within a component changes nothing.

Defined cases: null and empty texts have no shingles and are linked with nothing; a text of fewer words than a shingle is one
shingle by itself; equal sets are linked; null ids never name a component unless all of its ids are null; repeated ids are
documents of their own; an empty table gives no rows; other columns are ignored. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changefold.llm.common import Numbers, discard, give_back, lean, mixed, paired, run_hashes, stored, table
from changefold.llm.exchange import BLOCK_WORDS, by_place, firsts_marked, numbers_of, packed, placed, shard_count, unpacked
from changefold.llm.language_model import small_words

SHINGLE = 4
PERCENT = 85
RAISED = 3
STARS = 4
PAIRED, TILE = 32, 1000
#: Keys of a set that its rows in tiles name.
NAMED = 16
#: Words of the corpus for each shard of keys.
SHARD_WORDS = 2_000_000
#: Words whose shingles are made at once.
PIECE_WORDS = 100_000
#: Bits of a sketch, and 64-bit words that a comparison of many sketches holds at once.
MIN_BITS, MAX_BITS, HELD_WORDS = 128, 16_384, 1 << 21


def shingle_sets(hashes: np.ndarray, lengths: np.ndarray, size: int = SHINGLE, only=None) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of documents whose words' hashes follow one another; `only` some of them, by number."""
    numbers = np.arange(len(lengths)) if only is None else np.array(only, np.int64)
    ends = np.cumsum(lengths)
    piece = np.cumsum(lengths[numbers]) // PIECE_WORDS
    for some in np.split(numbers, np.flatnonzero(np.diff(piece)) + 1):
        words = np.concatenate([hashes[:0], *(hashes[ends[i] - lengths[i] : ends[i]] for i in some)])
        whole, start = paired(run_hashes(words, size), np.full(1, size, np.uint64)), 0
        for n in lengths[some].tolist():
            if n >= size:
                yield np.unique(whole[start : start + n - size + 1])
            elif n:  # the whole sequence as one
                yield paired(run_hashes(words[start : start + n], n), np.full(1, n, np.uint64))
            else:
                yield hashes[:0]
            start += n


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the numbers of shingles by bucket. There are one to two buckets for each shingle, but MAX_BITS at most:
    fewer only leave more pairs to the sets."""
    buckets = min(MAX_BITS, max(MIN_BITS, 1 << max(0, len(shingles) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def sketch_words(sketches) -> np.ndarray:
    """Sketches of one length as rows of 64-bit words."""
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches with as many buckets as `width` words have."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """No two sets with the sketches in these rows differ in fewer shingles. The finer ones are folded to the others' buckets."""
    width = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(folded(x, width) ^ folded(y, width)).sum(-1, dtype=np.int64)


def most_apart(s, other, percent: int):
    """The largest symmetric difference of similar sets of these sizes, which are numbers or arrays."""
    return (s + other) * (100 - percent) // (100 + percent)


class Bands:
    """Bands of set sizes: `low[b]` is the least size of band b, `segments[b]` into how many segments it cuts the universe."""

    def __init__(self, largest: int, percent: int):
        self.percent, self.low = percent, [1]
        while self.low[-1] <= largest:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * 100 // percent))
        tops = [x - 1 for x in self.low[1:]]
        self.segments = [most_apart(top * 100 // percent, top, percent) + 1 for top in tops]

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.low, size, "right")) - 1


def allot(sizes: np.ndarray, costs: np.ndarray, needed: int) -> np.ndarray:
    """Allotments that sum to `needed` at least, from the numbers of shingles by segment and what a probe by each costs.

    The costliest segments are left out, as many as are not needed. Then each costly one gives way to one of the first RAISED
    at 2, which costs as many lists as it has neighbours, as long as that is cheaper."""
    v = np.ones(len(sizes), np.int64)
    order = np.argsort(-costs, kind="stable")
    spare = max(0, len(sizes) - needed)
    v[order[:spare]] = 0
    raisable = sorted((i for i in range(min(RAISED, len(sizes))) if v[i] and sizes[i] > 1), key=lambda i: costs[i] * sizes[i])
    for i, j in zip(raisable, order[spare:]):
        if i != j and v[j] == 1 and v[i] == 1 and costs[j] > 2 * (sizes[i] + 1) * costs[i]:
            v[i], v[j] = 2, 0
    return v


def entries(shingles: np.ndarray, bands: Bands, counts: dict[int, int], shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a set and whether it probes by them; `counts` has the number of sets by band, `shares` the part of sets that
    have each shingle, as far as known."""
    held, named, probes = [], [], []
    size = len(shingles)
    own = bands.of(size)
    marks = mixed(shingles ^ np.uint64(0x94D049BB133111EB))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(marks)))
    for band in (own, own - 1):
        if band < 0 or (band < own and size * bands.percent > 100 * (bands.low[own] - 1)):
            continue  # no set of the band below is large enough
        m = bands.segments[band]
        segment = ((shingles >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # in order, as the shingles are
        ends = np.searchsorted(segment, np.arange(m + 1, dtype=np.uint64))
        sizes = np.diff(ends)
        sums = total[ends[1:]] - total[ends[:-1]]
        names = np.uint64(band << 32) + np.arange(m, dtype=np.uint64)
        top = min(size, bands.low[band + 1] - 1)
        costs = np.full(m, max(1.0, counts.get(band, 0) * float(np.exp(-size / m))))  # of an empty one
        some = np.flatnonzero(sizes)
        costs[some] = np.maximum(1.0, counts.get(band, 0) * np.minimum.reduceat(shares, ends[some]))
        v = allot(sizes, costs, most_apart(size, top, bands.percent) + 1)
        take = np.ones(m, bool) if band == own else v > 0
        held.append(sums[take])
        named.append(names[take])
        probes.append(v[take] > 0)
        for i in range(min(RAISED, m)):
            if sizes[i] and (band == own or v[i] == 2):
                held.append(sums[i] - marks[ends[i] : ends[i + 1]])
                named.append(np.full(sizes[i], names[i]))
                probes.append(np.full(sizes[i], v[i] == 2))
    return paired(np.concatenate(held), np.concatenate(named)), np.concatenate(probes)


def steps_of(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed bytes: from one key to the next are small numbers."""
    return by_place(np.diff(keys, prepend=np.uint64(0)))


def keys_of(data: bytes) -> np.ndarray:
    """The keys that `steps_of` packed."""
    return np.cumsum(placed(data, np.uint64), dtype=np.uint64)


def key_ranges(keys: np.ndarray, shards: int) -> np.ndarray:
    """The bounds of shards in sorted keys, a shard being a range of the key space: so the steps between a shard's keys stay as small
    as the block's, however many shards there are."""
    shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


def row_id(block: int, number):
    """One number for a document of a block."""
    return ((block >> 32) << 40) | ((block & 0xFFFFFFFF) << 20) | number


def word_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, shingle: int = SHINGLE) -> DataFrame:
    """Stored blocks of (doc_id, text): its documents (doc_ids, digests of the texts, lengths, sizes of their sets, and
    `copy_of`, the first document of the block with the same set), the hashes of its distinct words, and for each word of its
    texts, one after the other, the number of its hash, packed by `firsts_marked`."""

    @lean
    def blocks(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, digests, texts, numbers, held = [], [], [], Numbers(), 0

        def emit():
            lengths = np.array([len(x) for x in texts], np.int64)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
            words = np.concatenate(texts)
            first: dict[bytes, int] = {}
            sizes, copy_of = [], []
            for i, x in enumerate(shingle_sets(hashes[words], lengths, shingle)):
                sizes.append(len(x))
                copy_of.append(first.setdefault(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), i))
            arrays = ([packed(lengths)], [packed(hashes)], [firsts_marked(words)])
            values = ([task << 32 | number], [ids], [digests], [sizes], [copy_of], [int(lengths.sum())], *arrays)
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            many = [pa.list_(k) for k in (batch.schema.field(0).type, pa.binary(), pa.int64(), pa.int64())]
            kinds = [pa.int64(), *many, pa.int64(), *[pa.binary()] * 3]
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                own = small_words(text)
                texts.append(np.fromiter(map(numbers.__getitem__, own), np.uint32, len(own)))
                ids.append(doc.as_py())
                digests.append(hashlib.sha256((text or "").encode()).digest())
                held += len(own) + 1
                if held >= block_words:
                    yield emit()
                    number, ids, digests, texts, numbers, held = number + 1, [], [], [], Numbers(), 0
                    give_back()
        if ids:
            yield emit()

    names = ["block", "doc_ids", "digests", "sizes", "copy_of", "n_words", "lengths", "hashes", "words"]
    schema = "block long, doc_ids array<long>, digests array<binary>, sizes array<long>, copy_of array<long>, n_words long"
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return stored(docs.mapInArrow(blocks, f"{schema}, lengths binary, hashes binary, words binary"), "blocks")


def word_hashes(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of a block's documents and the hashes of their words."""
    return unpacked(row["lengths"], np.int64), unpacked(row["hashes"], np.uint64)[numbers_of(row["words"])]


def set_sizes(blocks: DataFrame) -> DataFrame:
    """(rid, doc_id, digest, n_shingles, copy_of) of every document."""
    start = F.shiftleft(F.shiftright("block", 32), 40) + F.shiftleft(F.col("block").bitwiseAND(0xFFFFFFFF), 20)
    each = blocks.select(start.alias("start"), F.posexplode(F.arrays_zip("doc_ids", "digests", "sizes", "copy_of")).alias("n", "d"))
    return stored(
        each.select(
            (F.col("start") + F.col("n")).alias("rid"),
            F.col("d.doc_ids").alias("doc_id"),
            F.col("d.digests").alias("digest"),
            F.col("d.sizes").alias("n_shingles"),
            (F.col("start") + F.col("d.copy_of")).alias("copy_of"),
        ),
        "set-sizes",
    )


def _each(frames):
    for frame in frames:
        yield from frame.to_dict("records")


def _each_of(batches):
    """The rows of record batches, one at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def shares_of(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set, the part of all sets that have each of its shingles; 0 for what one set alone has, as that says nothing."""
    every = np.concatenate(sets)
    order = np.argsort(every)
    every = every[order]
    starts = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, np.int64)
    found = np.diff(np.append(starts, len(every)))
    del every
    shares = np.empty(len(order), np.float32)
    shares[order] = np.repeat(np.where(found > 1, found / len(sets), 0.0).astype(np.float32), found)
    del order, starts, found
    at = 0
    for x in sets:
        yield shares[at : at + len(x)]
        at += len(x)


def key_groups(blocks: DataFrame, shards: int, bands: Bands, counts: dict[int, int], shingle: int = SHINGLE) -> DataFrame:
    """Stored rows of packed arrays, in order of `keys`: the `rids` of sets that share them, and whether each `probes`."""
    columns = ["keys", "rids", "probes"]

    def grouped(keys, rids, probes):
        """Sort by key, probing sets first; the first of each key, and whether any of it probes."""
        order = np.lexsort((rids, ~probes)) if len(rids) else np.empty(0, np.int64)
        order = order[np.argsort(keys[order], kind="stable")]
        keys, rids, probes = keys[order], rids[order], probes[order]
        starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        return keys, rids, probes, starts, np.diff(np.append(starts, len(keys)))

    def shared(keys, rids, probes, sizes, take):
        """The rows of keys with two sets or more, of those to `take`. Keys that the same sets of a block or shard share stay
        apart, as each may have other sets elsewhere."""
        several = np.repeat((sizes > 1) & take, sizes)
        return steps_of(keys[several]), by_place(rids[several]), packed(probes[several])

    def entries_of(row):
        """The keys of a block's sets, whose they are and whether those probe by them; None without sets."""
        firsts = [i for i, (n, first) in enumerate(zip(row["sizes"], row["copy_of"])) if n and i == first]
        if not firsts:
            return None
        lengths, hashes = word_hashes(row)
        sets = list(shingle_sets(hashes, lengths, shingle, firsts))
        del hashes
        keys, rids, probes = [], [], []
        for number, shingles, share in zip(firsts, sets, shares_of(sets)):
            own, probing = entries(shingles, bands, counts, share)
            keys.append(own)
            probes.append(probing)
            rids.append(np.full(len(own), row_id(row["block"], number)))
        del sets
        return np.concatenate(keys), np.concatenate(rids), np.concatenate(probes)

    @lean
    def ask(batches):
        import pyarrow as pa

        for row in _each_of(batches):
            found = entries_of(row)
            give_back()
            if not found:
                continue
            keys, rids, probes, starts, sizes = grouped(*found)
            del found
            out = [(-1, *shared(keys, rids, probes, sizes, True))]  # a set of another block may probe by any of them
            keys, rids, probes = keys[starts], rids[starts], probes[starts]
            bounds = key_ranges(keys, shards)
            for shard in np.flatnonzero(np.diff(bounds)):
                at = slice(bounds[shard], bounds[shard + 1])
                out.append((int(shard), steps_of(keys[at]), by_place(rids[at]), packed(probes[at])))
            del keys, rids, probes, starts, sizes
            kinds = [pa.int64(), *[pa.binary()] * len(columns)]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], ["shard", *columns])
            del out

    def merged(frame):
        read = (keys_of, lambda x: placed(x, np.int64), lambda x: unpacked(x, bool))
        keys, rids, probes, starts, sizes = grouped(*(np.concatenate([f(x) for x in frame[name]]) for name, f in zip(columns, read)))
        # a block's set probes if any of the block does, so no set at all probes by a key if none here does
        return pd.DataFrame([shared(keys, rids, probes, sizes, probes[starts])], columns=columns)

    def answer(key, frame):
        found = frame[columns] if key[0] < 0 else merged(frame)  # those below 0 are within blocks
        give_back()
        return found

    schema = ", ".join(f"{c} binary" for c in columns)
    asked = blocks.select("block", "sizes", "copy_of", "lengths", "hashes", "words").mapInArrow(ask, f"shard long, {schema}")
    spread = F.when(F.col("shard") < 0, -1 - F.pmod(F.xxhash64("keys"), F.lit(shards))).otherwise(F.col("shard"))
    return stored(asked.withColumn("shard", spread).groupBy("shard").applyInPandas(answer, schema), "groups")


def stars_of(groups: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of the leader of a key, for one in STARS keys that any set probes by, with its other sets. The leader
    has the largest degree: the sizes of its keys' groups, summed."""
    members = _unpacked_members(groups, STARS)
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.max("probes").alias("probed"))
    members = members.drop("probes").join(sizes.filter("probed").drop("probed"), "key")
    degrees = members.groupBy("rid").agg(F.sum("size").alias("degree"))
    order = F.struct("degree", -F.col("rid"))
    leads = members.join(degrees, "rid").groupBy("key").agg(F.max_by("rid", order).alias("lead"))
    pairs = members.join(leads, "key").filter("rid != lead")
    return pairs.select(F.least("rid", "lead").alias("a"), F.greatest("rid", "lead").alias("b")).distinct()


def _unpacked_members(groups: DataFrame, every: int = 1) -> DataFrame:
    """(key, rid, probes) of one in `every` keys."""

    @lean
    def rows(frames):
        for row in _each(frames):
            keys = keys_of(row["keys"]).view(np.int64)
            take = keys % every == 0
            rids, probes = placed(row["rids"], np.int64), unpacked(row["probes"], bool)
            yield pd.DataFrame({"key": keys[take], "rid": rids[take], "probes": probes[take]})

    return groups.select("keys", "rids", "probes").mapInPandas(rows, "key long, rid long, probes boolean")


def _block_no(rid):
    """Block and number of a document from its row id."""
    block = F.shiftleft(F.shiftright(rid, 40), 32).bitwiseOR(F.shiftright(rid, 20).bitwiseAND((1 << 20) - 1))
    return block.alias("block"), rid.bitwiseAND((1 << 20) - 1).cast("int").alias("number")


def fetch(blocks: DataFrame, rids: DataFrame, label: str, kind: str, value, shingle: int = SHINGLE) -> DataFrame:
    """(rid, value) of the documents in `rids`, `value` being made from their shingles.

    What is wanted of each block is stored first: where that is small, Spark sends it to the blocks instead of moving them."""

    @lean
    def rows(frames):
        for row in _each(frames):
            lengths, hashes = word_hashes(row)
            numbers = sorted(row["numbers"])
            for at in range(0, len(numbers), 200):
                some = numbers[at : at + 200]
                made = [value(x) for x in shingle_sets(hashes, lengths, shingle, some)]
                yield pd.DataFrame({"rid": [row_id(row["block"], int(n)) for n in some], label: made})

    wanted = rids.distinct().select(*_block_no(F.col("rid"))).groupBy("block").agg(F.collect_list("number").alias("numbers"))
    wanted = stored(wanted, "wanted")
    held = blocks.select("block", "lengths", "hashes", "words").join(wanted, "block")
    fetched = stored(held.mapInPandas(rows, f"rid long, {label} {kind}"), label)
    discard(wanted)
    return fetched


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rid")).unionAll(pairs.select(F.col("b").alias("rid")))


def with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Pairs with the values of both ends; a hot end's pairs are split by adaptive execution."""
    for end in "ab":
        pairs = pairs.join(values.select(F.col("rid").alias(end), F.col(name).alias(f"{name}_{end}")), end)
    return pairs


def verify(blocks: DataFrame, pairs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """The distinct pairs (a, b) of (a, b, na, nb), which are sizes, that are similar: by sketches, then by the sets."""

    @lean
    def close(frames):
        for frame in frames:
            x, y = (frame[name].to_numpy() for name in ("sketch_a", "sketch_b"))
            limit = most_apart(frame["na"].to_numpy(), frame["nb"].to_numpy(), percent)
            good = np.zeros(len(frame), bool)
            widths = np.array([list(map(len, x)), list(map(len, y))], np.int64).T
            for width in np.unique(widths, axis=0):
                of_width = np.flatnonzero((widths == width).all(1))
                step = max(1, 8 * HELD_WORDS // int(width.max()))
                for at in range(0, len(of_width), step):
                    some = of_width[at : at + step]
                    good[some] = apart(sketch_words(x[some]), sketch_words(y[some])) <= limit[some]
            yield frame.loc[good, ["a", "b"]]

    sketches = fetch(blocks, ends_of(pairs), "sketch", "binary", sketch, shingle)
    left = stored(with_both(pairs, sketches, "sketch").mapInPandas(close, "a long, b long"), "close")
    discard(sketches)
    sets = fetch(blocks, ends_of(left), "shingles", "array<long>", lambda x: x.view(np.int64), shingle)
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - both
    similar = with_both(left, sets, "shingles").filter(100 * both >= percent * union)
    verified = stored(similar.select("a", "b"), "verified")
    discard(left, sets)
    return verified


def close_in_tiles(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across roots, of (key, rid, root, probes, n_sets, n), n being a size, that share a key, at least one probing,
    and whose sizes and sketches allow the similarity. A key's sets are dealt to parts, and each two parts are a tile.

    Two sets may share many keys. So that a pair leaves the tiles of the least of them alone, each set's row names its NAMED least
    keys, and a pair for which both name an earlier one is left to that. Where they share earlier ones beyond those, it comes
    again; the fewer keys they share, the less often."""
    name = F.shiftleft("key", 1).bitwiseOR(F.col("probes").cast("int"))
    least = members.groupBy("rid").agg(F.slice(F.array_sort(F.collect_set(name)), 1, NAMED).alias("named"))
    sketches = sketches.join(least, "rid")
    parts = F.ceil(F.col("n_sets") / TILE).cast("int")
    rows = members.withColumn("part", F.pmod(F.xxhash64("rid"), parts).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n_sets")
    rows = rows.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).drop("other").join(sketches, "rid")

    def close(tile):
        """The pairs of one tile's rows, which are in order of rid, those that probe first."""
        rid, root, probes, size, part, low, high = (tile[x].to_numpy() for x in ("rid", "root", "probes", "n", "part", "low", "high"))
        sketches = tile["sketch"].to_numpy()
        width = min(map(len, sketches)) // 8
        bits = np.concatenate([folded(sketch_words([x]), width) for x in sketches])
        first = np.append(True, rid[1:] != rid[:-1])
        left, right = np.flatnonzero(first & (part == low)), np.flatnonzero(first & (part == high))
        less, more = (f(size[left][:, None], size[right]) for f in (np.minimum, np.maximum))
        may = (root[left][:, None] != root[right]) & (probes[left][:, None] | probes[right]) & (100 * less >= percent * more)
        if low[0] == high[0]:
            may &= rid[left][:, None] < rid[right]
        x, y = np.nonzero(may)
        x, y, step, good = left[x], right[y], max(1, HELD_WORDS // width), [np.zeros(0, bool)]
        for at in range(0, len(x), step):
            some, other = x[at : at + step], y[at : at + step]
            good.append(apart(bits[some], bits[other]) <= most_apart(size[some], size[other], percent))
        good = np.concatenate(good)
        x, y = x[good], y[good]
        earlier = {i: earlier_keys(tile["named"].iat[i], tile["key"].iat[0]) for i in np.unique(np.concatenate((x, y))).tolist()}
        x, y = np.array([p for p in zip(x.tolist(), y.tolist()) if not met(*(earlier[i] for i in p))], np.int64).reshape(-1, 2).T
        x, y = rid[x], rid[y]
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    @lean
    def tiles(frames):
        """Tiles follow one another; the last of a batch may go on in the next."""
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            names = frame[["key", "low", "high"]].to_numpy()
            bounds = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1)]
            found = [close(frame.iloc[start:end]) for start, end in zip(bounds, bounds[1:])]
            if found:
                yield pd.concat(found).drop_duplicates()
            rest = frame.iloc[bounds[-1] :]
        if rest is not None and len(rest):
            yield close(rest)

    order = ["key", "low", "high", "rid", F.desc("probes")]
    return rows.repartition("key", "low", "high").sortWithinPartitions(*order).mapInPandas(tiles, "a long, b long")


def earlier_keys(named: np.ndarray, key: int) -> tuple[set[int], set[int]]:
    """Of the keys that a set's row names, those before `key`: all, and those that the set probes by. A name is a key's 63 low bits
    and whether the set probes by it."""
    named = named[named < np.left_shift(np.int64(key), 1)]
    return set((named >> 1).tolist()), set((named[named & 1 == 1] >> 1).tolist())


def met(one: tuple[set[int], set[int]], other: tuple[set[int], set[int]]) -> bool:
    """Whether two sets share an earlier key that at least one of them probes by."""
    return not (one[0].isdisjoint(other[1]) and one[1].isdisjoint(other[0]))


def components(links: DataFrame) -> DataFrame:
    """(rid, root) of every linked document, the root being the smallest row id of its component.

    Alternates the large-star and small-star steps of Kiveris et al. until nothing changes; each is a join and a minimum, and
    its result is stored, so a lost executor costs one step at most."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = both.join(least, "u")
        if large:
            out = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = near.filter("v < u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            out = out.unionAll(least.select("u", F.col("m").alias("v")))
        return out.filter("u != v").distinct()

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if state == before:
            break
        before = state
        edges = stored(star(star(edges, True), False), "components")
    roots = edges.select(F.col("u").alias("rid"), F.col("v").alias("root"))
    return roots.unionAll(roots.select("root", "root").distinct())


def link_documents(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(rid, doc_id, digest, n_shingles, component_id, first) of every row of (doc_id, text), ids being whole numbers. `rid` is
    a number of the row, `digest` that of its text, and `first` is true for the row of its component that is kept if one is:
    the smallest id, then row id."""
    blocks = word_blocks(docs, block_words, shingle)
    shards = shard_count(blocks, SHARD_WORDS)
    sizes = set_sizes(blocks)
    top = sizes.agg(F.max("n_shingles")).first()[0] or 0
    bands = Bands(top, percent)
    lows = F.array(*map(F.lit, bands.low))
    in_band = F.size(F.filter(lows, lambda x: x <= F.col("n_shingles"))) - 1
    counts = {r["band"]: r["n"] for r in sizes.groupBy(in_band.alias("band")).agg(F.count("*").alias("n")).collect()}

    groups = key_groups(blocks, shards, bands, counts, shingle)
    size = sizes.select("rid", F.col("n_shingles").alias("n"))

    def plausible(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow the similarity, with the sizes."""
        sized = pairs.join(size.withColumnsRenamed({"rid": "a", "n": "na"}), "a").join(size.withColumnsRenamed({"rid": "b", "n": "nb"}), "b")
        return sized.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    stars = stored(plausible(stars_of(groups)), "stars")
    copies = sizes.filter("n_shingles > 0 AND copy_of != rid").select(F.col("rid").alias("a"), F.col("copy_of").alias("b"))
    links = verify(blocks, stars, percent, shingle)
    found = components(links)

    members = _unpacked_members(groups).join(found, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    of_key = Window.partitionBy("key")  # the members meet by key once; a join with their counts by key would send them twice
    across_roots = {"low": F.min("root").over(of_key), "high": F.max("root").over(of_key), "probed": F.max("probes").over(of_key)}
    counted = members.withColumns(across_roots | {"n_sets": F.count("*").over(of_key)}).filter("low != high AND probed")
    members = stored(counted.drop("low", "high", "probed"), "open-keys")
    discard(groups)
    few = members.filter(F.col("n_sets") <= PAIRED)
    across = (
        few.alias("x")
        .join(few.alias("y"), "key")
        .filter("x.rid < y.rid AND x.root != y.root AND (x.probes OR y.probes)")
        .select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b"))
    )
    many = members.filter(F.col("n_sets") > PAIRED)
    sketches = fetch(blocks, many.select("rid"), "sketch", "binary", sketch, shingle)
    across = across.unionAll(close_in_tiles(many.join(size, "rid"), sketches, percent)).distinct()
    across = stored(plausible(across).join(stars.select("a", "b"), ["a", "b"], "left_anti"), "pairs-left")
    discard(members, sketches, stars)
    links = links.unionAll(verify(blocks, across, percent, shingle))
    found = stored(components(links.unionAll(copies)), "roots")

    roots = sizes.join(found, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid")
    kept = roots.groupBy("root").agg(F.min(order).alias("kept"))
    return roots.join(kept, "root").select(
        "rid",
        "doc_id",
        F.lower(F.hex("digest")).alias("digest"),
        "n_shingles",
        F.col("kept.doc_id").alias("component_id"),
        (F.col("rid") == F.col("kept.rid")).alias("first"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The documents with one of each component, the smallest id, and their columns as they are.

    Rows are found again by id and text. Of rows with the same id and text, which the links cannot tell apart, as many stay
    as the components keep; only such rows are shuffled with their texts."""
    linked = link_documents(docs, percent, shingle)
    rows = linked.groupBy(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col("first").cast("long")).alias("n_kept")
    )
    rows = stored(rows.filter("n_kept > 0"), "kept")
    whole, part = rows.filter("n_kept = n_rows"), rows.filter("n_kept < n_rows")
    row = F.struct("*").alias("row")
    named = docs.select(row, F.col("doc_id").cast("long").alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))

    def same(keys):
        return named["id"].eqNullSafe(keys["kept_id"]) & (named["digest"] == keys["kept_digest"])

    place = F.row_number().over(Window.partitionBy("id", "digest").orderBy(F.lit(0)))
    some = named.join(part, same(part)).withColumn("place", place).filter("place <= n_kept")
    return named.join(whole, same(whole), "left_semi").select("row.*").unionAll(some.select("row.*"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document."""
    return link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
