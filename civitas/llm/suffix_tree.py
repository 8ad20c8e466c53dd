"""A probabilistic suffix tree over words, learned and used by Spark jobs.

The root is the smoothed distribution of single tokens.  A context of one to
``DEPTH`` words is a candidate when it was seen ``LEAST_CONTEXT`` times in
training; successors seen ``LEAST_PAIR`` times with it are its own.  It is kept
as a state when its divergence from its parent (the context without its first
word), over all its occurrences, exceeds the cost of its parameters; its
distribution hands the remaining mass on to the parent, so every state is a
proper distribution.  A token is scored by the longest kept suffix of what
precedes it in its document.

Documents become blocks of token numbers in a bucketed table; the hashes of their
words are dropped once the words are counted.  Counts, pair counts and states are
asked for block by block (:mod:`blocks`); a very frequent context arrives as one
partial sum per block.  Words and pairs that can be part of a longer context are
numbered by the buckets that count them, so that pairs and contexts are asked for
by dense numbers, which take fewer bytes than hashes and cannot collide.

Defined results: null text is empty (its end alone); a null ``doc_id`` counts as
the empty text for the split, hence as held out; repeated rows are documents of
their own; without training documents every token has the root's probability;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.blocks import SENT, answered, packed, ranges_of, received, send, unpacked
from civitas.llm.common import clean_text, parts, passing, stage_bucketed
from civitas.llm.order_minhash import mix

DEPTH = 2
LEAST_CONTEXT = 16
LEAST_PAIR = 3
FOLDS = 10
SMOOTHING = 0.1
BLOCK_TOKENS = 600_000
BUCKET_ENTRIES = 1_000_000
#: Odd factors that spread pairs of numbers over the buckets, each to a key of its own.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
NUMBERS = ("<u4",)
WORDS = ("+<u8",)

BLOCKS = (
    "block long, tokens long, trained long, docs array<long>, sizes array<int>, held array<boolean>, "
    "numbers binary, words binary"
)
SCORE = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)
_SCORE = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)
#: The end of a document; no word is a line break.
END = b"\n"


class _Numbers(dict):
    """Numbers of a block's words, in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def _block(number: int, docs: list, sizes: list[int], parts: list, seen: dict) -> pa.RecordBatch:
    hashes = np.asarray([xxhash.xxh3_64_intdigest(w) for w in seen], np.uint64)
    words, place = np.unique(hashes, return_inverse=True)
    numbers = place[np.concatenate(parts)]
    held = [held_out(d) for d in docs]
    trained = sum(n for n, h in zip(sizes, held, strict=True) if not h)
    return pa.record_batch(
        [
            pa.array([number], pa.int64()),
            pa.array([len(numbers)], pa.int64()),
            pa.array([trained], pa.int64()),
            pa.array([docs], pa.list_(pa.int64())),
            pa.array([sizes], pa.list_(pa.int32())),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([packed([numbers.astype("<u4")])], pa.binary()),
            pa.array([packed([words], WORDS)], pa.binary()),
        ],
        names=["block", "tokens", "trained", "docs", "sizes", "held", "numbers", "words"],
    )


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to blocks; only A-Z are lowered, only ASCII blanks separate."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    docs, sizes, parts, seen = [], [], [], _Numbers()
    held = 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            words = text.as_py().encode("utf-8", "surrogatepass").lower().split()
            if docs and held + len(words) > BLOCK_TOKENS:
                yield _block(number, docs, sizes, parts, seen)
                number, docs, sizes, parts, seen = number + 1, [], [], [], _Numbers()
                held = 0
            words.append(END)
            docs.append(doc.as_py())
            sizes.append(len(words))
            parts.append(np.fromiter(map(seen.__getitem__, words), np.int64, len(words)))
            held += len(words)
    if docs:
        yield _block(number, docs, sizes, parts, seen)


def pair_keys(context: np.ndarray, word: np.ndarray, contexts: int, words: int) -> tuple[np.ndarray, int]:
    """Keys of pairs of numbers below ``contexts`` and ``words``, and how many bits they have.

    Different pairs have different keys as long as there are at most 2**64; then they are hashes.
    """
    bits = max((contexts * words - 1).bit_length(), 2)
    if bits > 64:
        return mix(mix(context) ^ word), 64
    mask, half = np.uint64((1 << bits) - 1), np.uint64(bits // 2)
    keys = context * np.uint64(words) + word
    for factor in FACTORS:
        keys = (keys * np.uint64(factor)) & mask
        keys ^= keys >> half
    return (keys * np.uint64(FACTORS[0])) & mask, bits


class Tree:
    """One block's tokens and what is known about them, level by level."""

    def __init__(self, row: dict, buckets: int):
        self.block, self.buckets = row["block"], buckets
        # rising, and so in sending order
        self.words = np.frombuffer(row.get("words") or b"", np.uint64)
        self.numbers = np.frombuffer(row["numbers"], "<u4").astype(np.int64)
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.held = np.asarray(row["held"], bool)
        self.order = np.arange(int(self.numbers.max(initial=-1)) + 1)
        self.trained = np.repeat(~self.held, self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(self.numbers)) - np.repeat(starts, self.sizes)

    def word_counts(self) -> pa.RecordBatch:
        counts = np.bincount(self.numbers, self.trained, len(self.words)).astype("<u4")
        bucket, keys = ranges_of(self.words, self.buckets)
        return send(self.block, bucket, [keys, counts], WORD_KINDS)

    def root(
        self, counts: np.ndarray, total: int, distinct: int, numbered: np.ndarray | None = None, most: int = 0
    ) -> None:
        """``numbered``: the words' numbers over all blocks, from 1; alone, a block has its own."""
        self.known = counts[self.numbers]
        if numbered is None:
            numbered, most = self.order.astype(np.uint64) + np.uint64(1), -(-len(self.order) // self.buckets)
        # a word without a number is in no pair that is asked for
        self.number = np.maximum(numbered, 1) - np.uint64(1)
        self.word = self.number[self.numbers]
        self.most = self.words_most = max(most, 1)
        below = math.log(total + SMOOTHING * (distinct + 1))
        self.base = np.log(self.known + SMOOTHING) - below
        self.log = self.base.copy()
        self.level = 0

    def candidates(self) -> None:
        """Move to the next level: its contexts, as words or pairs of the block, and counts per token."""
        self.level += 1
        # a pair is as frequent as its last word, or its last two, at most
        if self.level == 1:
            context, often = self.numbers, self.known
        else:
            context, often = np.zeros_like(self.numbers), np.zeros(len(self.numbers), np.int64)
            context[self.at[self.asked]], often[self.at] = self.of, self.pairs
            self.number, self.most = self.pair_number, self.pairs_most
        self.context = np.zeros_like(self.numbers)
        self.context[1:] = context[:-1]
        self.count = np.zeros(len(self.numbers), np.int64)
        self.count[1:] = often[:-1]
        self.at = np.flatnonzero((self.place >= self.level) & (self.count >= LEAST_CONTEXT))
        self.asked = np.flatnonzero(often[self.at] >= LEAST_PAIR)
        ends = self.at[self.asked]
        keys, self.pair_bits = pair_keys(
            self.number[self.context[ends]], self.word[ends], self.buckets * self.most, self.buckets * self.words_most
        )
        self.distinct, self.of = np.unique(keys, return_inverse=True)

    def pair_counts(self) -> pa.RecordBatch:
        trained = self.trained[self.at[self.asked]]
        counts = np.bincount(self.of, trained, len(self.distinct)).astype("<u4")
        bucket, keys = ranges_of(self.distinct, self.buckets, self.pair_bits)
        return send(self.block, bucket, [keys, counts], PAIR_KINDS)

    def counted(
        self, counts: np.ndarray, owned: np.ndarray, numbered: np.ndarray | None = None, most: int = 0
    ) -> None:
        """``numbered``: the numbers of pairs that are contexts, from 1, as for words."""
        if numbered is None:
            numbered = np.arange(1, len(counts) + 1, dtype=np.uint64)
            most = -(-len(counts) // self.buckets)
        self.owned, self.pairs_most = owned, max(most, 1)
        self.pairs = np.zeros(len(self.at), np.int64)
        self.pairs[self.asked] = counts[self.of]
        self.pair_number = np.maximum(numbered, 1) - np.uint64(1)
        # a block's words and pairs rise with their numbers, so that nothing is sorted here
        used = np.zeros(len(self.number), bool)
        used[self.context[self.at]] = True
        self.contexts = self.number[used]
        self.context_of = (np.cumsum(used) - 1)[self.context[self.at]]

    def divergences(self) -> pa.RecordBatch:
        """Partial sums, over the pairs that this block answers for, per context."""
        one = np.zeros(len(self.distinct), np.int64)
        one[self.of] = self.asked
        mine = one[self.owned]
        n, c = self.pairs[mine], self.count[self.at[mine]]
        log, context = self.log[self.at[mine]], self.context_of[mine]
        size = len(self.contexts)
        count = np.zeros(size, "<u4")
        count[context] = c
        bucket = self.contexts // np.uint64(self.most)
        sums = [
            (self.contexts - bucket * np.uint64(self.most)).astype("<u4"),
            count,
            np.bincount(context, n, size).astype("<u4"),
            np.bincount(context, minlength=size).astype("<u4"),
            np.bincount(context, n * (np.log(n / c) - log), size).astype("<f8"),
            np.bincount(context, np.exp(log), size).astype("<f8"),
        ]
        return send(self.block, bucket.astype(np.int64), sums, SUM_KINDS)

    def states(self, kept: np.ndarray, successors: np.ndarray) -> None:
        """Score with the states of this level where they were kept."""
        own_kept, own = kept.astype(np.int64), successors.astype(np.int64)
        spread = own[self.context_of]
        c = self.count[self.at]
        rest = (c - own_kept[self.context_of] + spread) / (c + spread)
        inside = self.pairs / (c + spread) + rest * np.exp(self.log[self.at])
        use = spread > 0
        self.log[self.at[use]] = np.log(inside[use])

    def scores(self, docs: list, total: int) -> pa.RecordBatch:
        heads = np.cumsum(self.sizes) - self.sizes
        tens = 1 / math.log(10)
        columns = [
            docs,
            self.held,
            self.sizes,
            np.add.reduceat((self.known > 0).astype(np.int64), heads),
            np.full(len(docs), total),
            np.add.reduceat(self.base, heads) * tens,
            np.add.reduceat(self.log, heads) * tens,
        ]
        return pa.record_batch(
            [pa.array(c, f.type) for c, f in zip(columns, _SCORE, strict=True)], schema=_SCORE
        )


def _numbers(of: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Numbers from 1, in the order of the keys, for ``some`` of them; 0 for the others."""
    return np.where(some, np.cumsum(some), 0).astype("<u4")[of]


def _sum_words(columns: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    keys, counts = columns
    _, of = np.unique(keys, return_inverse=True)
    sums = np.bincount(of, counts)
    return [sums[of].astype("<u8"), _numbers(of, sums >= LEAST_PAIR)], int((sums > 0).sum())


def _sum_pairs(columns: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Counts of pairs seen often enough; the first block that asks answers for a pair."""
    keys, counts = columns
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    sums = np.bincount(of, counts)
    sums[sums < LEAST_PAIR] = 0
    owned = np.zeros(len(keys), np.uint8)
    owned[first] = sums > 0
    return [sums[of].astype("<u4"), owned, _numbers(of, sums >= LEAST_CONTEXT)], 0


def _judge_states(total: int):
    def judge(columns: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
        keys, count, *sums = columns
        _, of = np.unique(keys, return_inverse=True)
        kept, successors, gain, mass = (np.bincount(of, s) for s in sums)
        # blocks that answer for none of a context's pairs do not tell its count
        c = np.zeros(len(kept))
        c[of[count > 0]] = count[count > 0]
        rest = np.maximum(c - kept, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gain + np.where(rest > 0, rest * np.log(rest / c / np.maximum(1 - mass, 1e-12)), 0)
        # description length of a state's parameters
        good = (successors > 0) & (gain > 0.5 * (successors + 1) * math.log(max(total, 2)))
        kept, successors = np.where(good, kept, 0), np.where(good, successors, 0)
        return [kept[of].astype("<u4"), successors[of].astype("<u4")], int(good.sum())

    return judge


WORD_KINDS = ("+<u8", "<u4")
PAIR_KINDS = ("+<u8", "<u4")
SUM_KINDS = ("+<u4", "<u4", "<u4", "<u4", "<f8", "<f8")
GIVEN = {"counts": ("<u8", "+<u4"), "pairs": ("<u4", "<u1", "+<u4"), "states": ("<u4", "<u4")}


def _kind(label: str) -> str:
    return label.rstrip("0123456789")


def suffix_tree_scores(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per document (columns of ``SCORE``)."""
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"))
    got: list[tuple[str, DataFrame]] = []
    most: dict[str, int] = {}
    distinct = 0

    def known() -> DataFrame:
        rows = blocks
        for label, answers in got:
            rows = rows.join(answers.select("block", label), "block", "left")
        return rows

    def grown(row: dict, labels: list[str]) -> Tree:
        """A block's tree as far as the answers go."""
        row = row | {"numbers": unpacked(row["numbers"], NUMBERS)[0].tobytes()}
        if not labels:
            row["words"] = unpacked(row["words"], WORDS)[0].tobytes()
        tree = Tree(row, buckets)
        for label in labels:
            answer = received(row[label], GIVEN[_kind(label)], most.get(label, 0))
            if label == "counts":
                tree.root(answer[0].astype(np.int64), total, distinct, answer[1], most[label])
            elif label.startswith("pairs"):
                tree.candidates()
                tree.counted(answer[0], answer[1].astype(bool), answer[2], most[label])
            else:
                tree.states(*answer)
        return tree

    def asked(step) -> DataFrame:
        labels = [label for label, _ in got]

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                    yield step(grown(row, labels))

        return known().mapInArrow(ask, SENT)

    def pairs_of(tree: Tree) -> pa.RecordBatch:
        tree.candidates()
        return tree.pair_counts()

    def answer(step, kinds: tuple[str, ...], judge, label: str) -> DataFrame:
        answers = answered(asked(step), kinds, judge, label, GIVEN[_kind(label)], keep=True)
        most[label] = answers.agg(F.max("most")).first()[0] or 0
        got.append((label, answers))
        return answers

    with passing(spark):
        blocks = stage_bucketed(given.mapInArrow(_tokens, BLOCKS), "token_blocks", "block", parts(docs))
        sizes = blocks.agg(F.sum("tokens"), F.sum("trained")).first()
        tokens, total = sizes[0] or 0, sizes[1] or 0
        buckets = max(parts(docs), math.ceil(tokens / BUCKET_ENTRIES))
        counts = answer(Tree.word_counts, WORD_KINDS, _sum_words, "counts")
        distinct = counts.agg(F.sum("total")).first()[0] or 0
        # the words' hashes are not needed any more
        blocks = stage_bucketed(blocks.drop("words"), "token_numbers", "block", parts(docs), keep=True)
    for level in range(1, depth + 1):
        answer(pairs_of, PAIR_KINDS, _sum_pairs, f"pairs{level}")
        answer(Tree.divergences, SUM_KINDS, _judge_states(total), f"states{level}")
    labels = [label for label, _ in got]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                yield grown(row, labels).scores(row["docs"], total)

    return known().mapInArrow(finish, SCORE)
