"""Near-duplicate texts by Order MinHash with verified edit similarity.

A text is its lower-case words; its grams of five words are labelled with their
occurrence number.  A sketch takes the ``LENGTH`` labelled grams with the
smallest hashes and keeps them in text order, so that it agrees for two texts
about as often as they are close in edit distance.  Texts that share a sketch
are candidates, compared by banded alignment of the words.

1. Rounds with leaders join most texts cheaply: each is compared with the first
   of its bucket and one by chance; those that neither leader's class took in
   form the next round's buckets, until a round links few of its pairs.
2. Then all members of all buckets that hold several classes meet in full.  Bags
   of hashed words bound the edit distance from below; members with a partner that
   length and bags leave possible meet again with their texts, inside tasks.  A
   pair is aligned in one of the buckets it shares, unless links found there have
   joined its classes, and only links leave the task.

So each pair that shares a sketch is in one class or was ruled out exactly.
Classes are connected components.

Equal texts are one text from the start.  Sketches stay where they were made, in
blocks of texts written once as a bucketed table: a block asks the other blocks
which of its keys they have too (:mod:`blocks`), and only the members of such
buckets leave it.  Buckets are never gathered: leaders come from aggregates, their pairs are a join salted by leader, and a large bucket
meets as pairs of blocks of about ``BLOCK`` members and ``BLOCK_WORDS`` words.

Defined results: null text is empty; texts without words link only to equal
texts; rows that share a ``doc_id`` are one document and one class; a null
``doc_id`` links with nothing, has a null class, and is kept; empty tables give
no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.blocks import SENT, answered, order_of, received, send
from civitas.llm.common import clean_text, parts, passing, stage, stage_bucketed
from civitas.llm.components import components

GRAM = 5
LENGTH = 2
SKETCHES = 48
THRESHOLD = 0.8
CACHED_WORDS = 400_000
SLICE = 1 << 16
#: Kinds of buckets, each with a second leader of its own.
LEADERS = 4
#: Edits up to which the band alone decides.
NARROW = 24
#: Counters in a bag of words, and members of a bucket that meet in one piece.
BAG = 256
BLOCK = 1024
BLOCK_WORDS = 1 << 20
#: Pairs of a leader that are aligned in one piece.
MET = 64
#: Rounds with leaders end when they link less than one in so many pairs.
SPARSE = 20

#: Texts in a block of sketches, and keys that a bucket of questions meets.
BLOCK_TEXTS = 2048
BUCKET_ENTRIES = 1_000_000
_SKETCHED = (
    "block long, entries long, docs array<long>, texts array<binary>, words array<long>, "
    "sizes array<int>, keys binary, bags binary"
)
_MEMBERS = "node long, words long, key long"
#: The lower half of a key and whether several texts of the block have it.  Keys that
#: agree in it and in the bucket are taken for shared; they are told apart as members.
ASKED_KINDS = ("<u4", "<u1")
_PRIMES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = x * np.uint64(_PRIMES[0])
    x ^= x >> np.uint64(32)
    x *= np.uint64(_PRIMES[1])
    x ^= x >> np.uint64(29)
    return x


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def grams(words: np.ndarray) -> np.ndarray:
    """Occurrence-labelled hashes of the grams, in text order."""
    size = min(GRAM, len(words))
    count = len(words) - size + 1
    if not len(words):
        return np.zeros(0, np.uint64)
    value = np.zeros(count, np.uint64)
    for k in range(size):
        value = mix(value + words[k : k + count] + np.uint64(k + 1))
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    at = np.arange(count)
    occurrence = np.empty(count, np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    return mix(value ^ mix(occurrence))


SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64))


def sketch(labelled: np.ndarray) -> np.ndarray:
    """One key per sketch: the smallest labelled grams in text order."""
    if not len(labelled):
        return np.zeros(0, np.int64)
    take = min(LENGTH, len(labelled))
    least = np.full((SKETCHES, take), np.iinfo(np.uint64).max, np.uint64)
    place = np.zeros((SKETCHES, take), np.int64)
    for start in range(0, len(labelled), SLICE):
        hashed = mix(labelled[None, start : start + SLICE] ^ SEEDS[:, None])
        rows = np.arange(SKETCHES)
        found, where = [least], [place]
        for _ in range(min(take, hashed.shape[1])):
            at = hashed.argmin(axis=1)
            found.append(hashed[rows, at][:, None].copy())
            where.append(at[:, None] + start)
            hashed[rows, at] = np.iinfo(np.uint64).max
        found, where = np.concatenate(found, axis=1), np.concatenate(where, axis=1)
        best = np.argsort(found, axis=1, kind="stable")[:, :take]
        least, place = np.take_along_axis(found, best, 1), np.take_along_axis(where, best, 1)
    key = SEEDS.copy()
    for column in np.sort(place, axis=1).T:
        key = mix(key + labelled[column])
    return key.view(np.int64)


def edit_distance(a: Sequence, b: Sequence, most: int) -> int | None:
    """Edit distance if at most ``most``, by furthest-reaching points of a band."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    reach = {0: _run(a, b, 0, 0)}
    if n == m == reach[0]:
        return 0
    goal = m - n
    for edits in range(1, most + 1):
        new: dict[int, int] = {}
        # a diagonal further from the goal than the edits left can't return
        for k in range(max(-edits, goal - most + edits), min(edits, goal + most - edits) + 1):
            i = max(
                reach.get(k, -2) + 1,  # replace
                reach.get(k + 1, -2) + 1,  # drop a word of a
                reach.get(k - 1, -2),  # add a word of b
            )
            i = min(i, n, m - k)
            if i < 0 or i + k < 0:
                continue
            new[k] = i + _run(a, b, i, i + k)
        reach = new
        if reach.get(goal, -1) >= n:
            return edits
    return None


def bit_distance(a: Sequence, b: Sequence, most: int) -> int | None:
    """Edit distance if at most ``most``: a column of the table in two bit rows.

    Costs the same however far apart the texts are, where the band grows with
    the square of the edits.
    """
    if not a or not b:
        return max(len(a), len(b)) if max(len(a), len(b)) <= most else None
    rows: dict = {}
    for at, word in enumerate(a):
        rows[word] = rows.get(word, 0) | 1 << at
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for left, word in enumerate(b, 1 - len(b)):
        equal = rows.get(word, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        rises = down | (full & ~(horizontal | up))
        falls = up & horizontal
        if rises & top:
            distance += 1
        elif falls & top:
            distance -= 1
        if distance + left > most:  # each column left takes off one at most
            return None
        rises = (rises << 1 | 1) & full
        falls = falls << 1 & full
        up = falls | (full & ~(vertical | rises))
        down = rises & vertical
    return distance if distance <= most else None


def _run(a: Sequence, b: Sequence, i: int, j: int) -> int:
    """Length of the common run from a[i] and b[j]."""
    start, step = i, 8
    while True:
        x, y = a[i : i + step], b[j : j + step]
        if x == y and len(x) == step:
            i, j, step = i + step, j + step, min(step * 2, 4096)
            continue
        for u, v in zip(x, y, strict=False):
            if u != v:
                break
            i += 1
        return i - start


def similar(a: str, b: str, threshold: float = THRESHOLD) -> bool:
    """Whether 1 - word edit distance / longer length reaches the threshold."""
    x, y = a.lower().split(), b.lower().split()
    return alike(x, y, Counter(x), Counter(y), threshold) if x or y else a == b


def alike(x: Sequence, y: Sequence, counts_x: Counter, counts_y: Counter, threshold: float) -> bool:
    """The same for words and their counts."""
    longest = max(len(x), len(y))
    most = int((1 - threshold) * longest + 1e-9)
    if abs(len(x) - len(y)) > most:
        return False
    if longest - sum((counts_x & counts_y).values()) > most:  # the words alone, in any order, are too few
        return False
    if most <= NARROW:
        return edit_distance(x, y, most) is not None
    return edit_distance(x, y, NARROW) is not None or bit_distance(x, y, most) is not None


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to blocks of sketches."""
    from pyspark import TaskContext

    number, hashes = TaskContext.get().partitionId() << 32, WordHashes()
    for given in batches:
        for at in range(0, given.num_rows, BLOCK_TEXTS):
            batch = given.slice(at, BLOCK_TEXTS)
            keys, counts, bags = [], [], []
            for text in batch.column(2):
                words = text.as_py().lower().split()
                values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                keys.append(np.unique(sketch(grams(values))))
                counts.append(len(words))
                bags.append(bag(values).tobytes())
            sizes = [len(k) for k in keys]
            yield pa.record_batch(
                [
                    pa.array([number], pa.int64()),
                    pa.array([sum(sizes)], pa.int64()),
                    pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([batch.column(1).to_pylist()], pa.list_(pa.binary())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([np.concatenate(keys).astype("<i8").tobytes()], pa.binary()),
                    pa.array([b"".join(bags)], pa.binary()),
                ],
                names=["block", "entries", "docs", "texts", "words", "sizes", "keys", "bags"],
            )
            number += 1


class Sketched:
    """A block of sketches without the copies of texts that others stand for."""

    def __init__(self, row: dict, buckets: int):
        copies = {(c["a"], bytes(c["text_key"])) for c in row["copies"] or ()}
        alone = np.asarray(
            [pair not in copies for pair in zip(row["docs"], map(bytes, row["texts"]), strict=True)], bool
        )
        sizes = np.asarray(row["sizes"], np.int64)
        self.block, self.alone = row["block"], alone
        self.docs, self.words = np.asarray(row["docs"], np.int64), np.asarray(row["words"], np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        taken = alone[owner]
        self.owner = owner[taken]
        self.keys = np.frombuffer(row["keys"], "<u8")[taken]
        self.distinct, self.of, self.counts = np.unique(
            self.keys, return_inverse=True, return_counts=True
        )
        self.order, self.bucket = order_of(self.distinct, buckets, 32)

    def asks(self) -> pa.RecordBatch:
        low = self.distinct[self.order].astype("<u4")
        return send(self.block, self.bucket, [low, (self.counts[self.order] > 1).astype("<u1")])

    def shared(self, row: dict) -> np.ndarray:
        """Which of the keys others have too, per key of a text."""
        found = np.empty(len(self.distinct), bool)
        found[self.order] = received(row["shared"], ("<u1",))[0]
        return found[self.of]

    def members(self, row: dict) -> pa.RecordBatch:
        at = np.flatnonzero(self.shared(row))
        owner = self.owner[at]
        columns = [self.docs[owner], self.words[owner], self.keys[at].view(np.int64)]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["node", "words", "key"])

    def bags(self, row: dict) -> pa.RecordBatch:
        """The bags of the members."""
        some = np.unique(self.owner[self.shared(row)]).tolist()
        bags = [row["bags"][n * BAG : (n + 1) * BAG] for n in some]
        return pa.record_batch(
            [pa.array(self.docs[some], pa.int64()), pa.array(bags, pa.binary())], names=["node", "bag"]
        )


def _of_blocks(rows: DataFrame, buckets: int, work, schema: str) -> DataFrame:
    """Applies work to each block of sketches and its row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                yield work(Sketched(row, buckets), row)

    return rows.mapInArrow(each, schema)


def _judge_keys(columns: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Whether several texts have a key."""
    keys, several = columns
    _, of, counts = np.unique(keys, return_inverse=True, return_counts=True)
    found = counts > 1
    np.logical_or.at(found, of, several.astype(bool))
    return [found[of].astype("<u1")], 0


def bag(words: np.ndarray) -> np.ndarray:
    """How often words fall on each counter.  Words that share one, and counters
    that are full, only bring texts closer."""
    counts = np.bincount((words % np.uint64(BAG)).astype(np.int64), minlength=BAG)
    return np.minimum(counts, 255).astype(np.uint8)


def possible_pairs(
    words: np.ndarray, classes: np.ndarray, sides: np.ndarray, bags: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places) of different classes that lengths and bags don't rule out.

    An edit takes one word off and adds one at most, so the distance is at least
    what either bag has more than the other.  ``sides``: the blocks of the
    members; those of two blocks meet across only.
    """
    least = int(round(threshold * 1_000_000))
    order = np.argsort(words, kind="stable")
    words, classes, sides = words[order], classes[order], sides[order]
    bags = bags[order].astype(np.float32)
    ones, total = np.ones(bags.shape[1], np.float32), bags.sum(axis=1)
    most = ((1 - threshold) * words + 1e-9).astype(np.int64)
    stop = np.searchsorted(words * least, words * 1_000_000, side="right")
    across = len(sides) > 0 and sides.min() != sides.max()
    left, right = [], []
    for i in range(len(words)):
        open_ = classes[i + 1 : stop[i]] != classes[i]
        if across:
            open_ &= sides[i + 1 : stop[i]] != sides[i]
        j = np.flatnonzero(open_) + i + 1
        if not len(j):
            continue
        shared = np.minimum(bags[i], bags[j]) @ ones
        j = j[np.maximum(total[i], total[j]) - shared <= most[j]]
        left.append(np.full(len(j), i))
        right.append(j)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return order[np.concatenate(left)], order[np.concatenate(right)]


GROUP = ["key", "low", "high"]
_PLACED = "node long, words long, component long, salt long, key long, low long, high long"


def _by_group(work):
    """Applies work to the whole groups of rows that come sorted by group."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in GROUP])
            cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
            if held and any(keys[n, 0] != held[-1].column(c)[0].as_py() for n, c in enumerate(GROUP)):
                yield from work(pa.Table.from_batches(held))
                held = []
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if start:
                    yield from work(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from work(pa.Table.from_batches(held))

    return groups


def _pairs_in(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    words, component, salt = (rows.column(c).to_numpy() for c in ("words", "component", "salt"))
    bags = np.frombuffer(b"".join(rows.column("bag").to_pylist()), np.uint8).reshape(-1, BAG)
    return possible_pairs(words, component, salt, bags, threshold)


def _with_partner(threshold: float):
    """Keeps the members of a group that have a possible partner in it."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows > 1:
            some = np.unique(np.concatenate(_pairs_in(rows, threshold)))
            if len(some):
                yield from rows.take(pa.array(some)).combine_chunks().to_batches()

    return work


def _linked(threshold: float):
    """The links in a group of members with texts, as far as they join classes."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        left, right = _pairs_in(rows, threshold)
        if not len(left):
            return
        nodes = rows.column("node").to_numpy()
        node, component = nodes.tolist(), rows.column("component").to_pylist()
        texts = [t.lower().split() for t in rows.column("text").to_pylist()]
        counts = [Counter(t) for t in texts]
        # the buckets of a member as bits, in order of their keys
        listed = rows.column("keys").to_pylist()
        every = np.unique(np.concatenate(listed))
        bits = [sum(1 << at for at in np.searchsorted(every, own).tolist()) for own in listed]
        here = 1 << int(np.searchsorted(every, rows.column("key")[0].as_py()))
        # a pair is aligned in the first bucket it shares from a place of its own on
        chance = mix(nodes[left].view(np.uint64) ^ nodes[right].view(np.uint64)).view(np.int64)
        joined: dict[int, int] = {}

        def root(label: int) -> int:
            while label in joined:
                label = joined[label]
            return label

        a, b = [], []
        for i, j, place in zip(
            left.tolist(), right.tolist(), np.searchsorted(every, chance).tolist(), strict=True
        ):
            shared = bits[i] & bits[j]
            later = shared >> place
            if ((later & -later) << place if later else shared & -shared) != here:
                continue
            x, y = root(component[i]), root(component[j])
            if x != y and alike(texts[i], texts[j], counts[i], counts[j], threshold):
                joined[max(x, y)] = min(x, y)
                a.append(max(node[i], node[j]))
                b.append(min(node[i], node[j]))
        if a:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return work


def _grouped(frame: DataFrame, work, schema: str) -> DataFrame:
    return (
        frame.repartition(parts(frame), *GROUP).sortWithinPartitions(*GROUP).mapInArrow(_by_group(work), schema)
    )


def _full_meeting(
    members: DataFrame, bags: DataFrame, given: DataFrame, threshold: float, block: int
) -> DataFrame:
    """(a, b) that links classes sharing a bucket."""
    hashed = F.xxhash64("node")
    sets = members.groupBy("key").agg(
        F.count("*").alias("members"),
        F.sum("words").alias("size"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.bit_xor(hashed).alias("set"),
        F.sum(F.shiftrightunsigned(hashed, 32)).alias("set2"),
    )
    # buckets of the same texts meet once
    several = (
        sets.filter("least < most").groupBy("members", "size", "set", "set2").agg(F.min("key").alias("key"))
        .select(
            "key",
            F.ceil(F.greatest(F.col("members") / block, F.col("size") / BLOCK_WORDS)).cast("long").alias("salts"),
        )
    )
    placed = (
        members.join(several, "key")
        .withColumn("salt", F.pmod(hashed, F.col("salts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        .withColumn("low", F.least("salt", "other"))
        .withColumn("high", F.greatest("salt", "other"))
        .select("node", "words", "component", "salt", *GROUP)
    )
    open_ = stage(
        _grouped(placed.join(bags, "node"), _with_partner(threshold), f"{_PLACED}, bag binary"), "meetings"
    )
    keys = open_.groupBy("node").agg(F.collect_set("key").alias("keys"))
    texts = _texts_of(keys.select("node"), given).join(keys, "node")
    return _grouped(open_.join(texts, "node"), _linked(threshold), "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) pairs whose texts are similar; b may be in very many."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(x.as_py(), y.as_py(), threshold)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / MET).cast("long").alias("salts"))
    own = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    lead = (
        salts.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "text_b")
    )
    return (
        pairs.join(salts, "b")
        .select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"))
        .join(own, "a")
        .repartition(parts(pairs), "b", "salt")
        .join(lead, ["b", "salt"])
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(align, "a long, b long")
    )


def _texts_of(wanted: DataFrame, given: DataFrame) -> DataFrame:
    """Texts of candidates only; one row per text, or its first where an id repeats.

    The ids are written first: their size is then known, and only where it is too
    large for a broadcast do all texts move.
    """
    listed = stage(wanted.distinct(), "wanted")
    return stage_bucketed(
        given.join(listed, F.col("doc_id") == F.col("node"), "left_semi")
        .groupBy(F.col("doc_id").alias("node")).agg(F.min("text").alias("text")),
        "texts", "node", parts(given),
    )


def _links(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """Links with those that the classes so far stand for."""
    if classes is None:
        return links
    return links.unionByName(classes.select(F.col("node").alias("a"), F.col("class").alias("b")))


def near_texts(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, kept`` per row; one document of each class is kept."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text")
    ).withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary"))))
    with passing(docs.sparkSession):
        final = _classes(given, threshold, block)
    return (
        given.select("doc_id")
        .join(final, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
    )


def _classes(given: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, component) of the documents in classes of several."""
    sketched = stage_bucketed(
        given.filter("doc_id is not null").select("doc_id", "text_key", "text")
        .mapInArrow(_sketches, _SKETCHED),
        "sketches", "block", parts(given),
    )
    # equal texts: the smallest id stands for all, the others are tied to it
    named = sketched.select("block", F.explode(F.arrays_zip("docs", "texts")).alias("text")).select(
        "block", F.col("text.docs").alias("a"), F.col("text.texts").alias("text_key")
    )
    firsts = named.groupBy("text_key").agg(F.min("a").alias("b"))
    same = stage(named.join(firsts, "text_key").filter("a != b"), "same")
    copies = stage_bucketed(
        same.groupBy("block").agg(F.collect_list(F.struct("a", "text_key")).alias("copies")),
        "copies", "block", parts(given),
    )
    entries = sketched.agg(F.sum("entries")).first()[0] or 0
    buckets = max(parts(given), math.ceil(entries / BUCKET_ENTRIES))
    units = sketched.join(copies, "block", "left")
    asked = units.select("block", "docs", "texts", "words", "sizes", "keys", "copies")
    shared = answered(
        _of_blocks(asked, buckets, lambda own, _: own.asks(), SENT), ASKED_KINDS, _judge_keys, "shared"
    ).select("block", "shared")
    every = stage(
        _of_blocks(asked.join(shared, "block"), buckets, Sketched.members, _MEMBERS)
        .withColumn("component", F.col("node")),
        "members",
    )
    bags = _of_blocks(
        units.drop("entries").join(shared, "block"), buckets, Sketched.bags, "node long, bag binary"
    )
    least = int(round(threshold * 1_000_000))
    members, classes = every, None
    while True:
        # the smallest member, and one by a hash that varies over a few kinds of
        # buckets: members that one leader misses meet others in other buckets
        chance = F.xxhash64("node", F.pmod("key", F.lit(LEADERS)))
        leaders = members.groupBy("key").agg(
            F.min(F.struct("node", "words", "component")).alias("low"),
            F.min(F.struct(chance, "node", "words", "component")).alias("high"),
        )
        met = members.join(leaders, "key")
        pairs = None
        for side in ("low", "high"):
            lead = F.col(f"{side}.words")
            close = F.least("words", lead) * 1_000_000 >= F.greatest("words", lead) * least
            apart = F.col("component") != F.col(f"{side}.component")
            part = met.filter(apart & close).select(
                F.greatest("node", f"{side}.node").alias("x"), F.least("node", f"{side}.node").alias("y"),
                F.col(f"{side}.node").alias("b"),
            )
            pairs = part if pairs is None else pairs.unionByName(part)
        # b: the leader, or either of two
        pairs = stage(
            pairs.groupBy("x", "y").agg(F.max("b").alias("b"))
            .select(F.when(F.col("b") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("a"), "b"),
            "pairs",
        )
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        new = stage(_verified(pairs, _texts_of(wanted, given), threshold), "links")
        linked = new.count()
        if linked:
            # classes so far count as one link per member
            classes = stage(components(_links(classes, new)), "classes").withColumnRenamed("component", "class")
        if not linked or linked * SPARSE < pairs.count():
            break  # the full meeting below compares the rest
        named = members.join(classes, "node", "left").withColumn(
            "component", F.coalesce("class", "node")
        )
        ends = named.groupBy("key").agg(
            F.min(F.struct("node", "component")).alias("low"),
            F.min(F.struct(chance, "node", "component")).alias("high"),
        )
        rest = named.join(ends, "key").filter(
            (F.col("component") != F.col("low.component"))
            & (F.col("component") != F.col("high.component"))
        )
        members = stage(rest.select("node", "words", "key", "component"), "members")
        if members.isEmpty():
            break
    # what the leaders left: classes that share a bucket meet in full
    if classes is not None:
        every = every.drop("component").join(
            classes.withColumnRenamed("class", "component"), "node", "left"
        ).withColumn("component", F.coalesce("component", "node"))
    new = stage(_full_meeting(every, bags, given, threshold, block), "links")
    return stage(components(_links(classes, same.select("a", "b").unionByName(new))), "classes", keep=True)
