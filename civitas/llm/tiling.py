"""Benchmark decontamination by greedy string tiling.

Tokens are lower-case words without surrounding punctuation.  Grams of
``least`` words that a document shares with a benchmark item are the seeds;
nothing outside seeds can be part of a tile.  For every (document, item) with
enough seeded words, running Karp-Rabin greedy tiling repeatedly marks the
longest common runs that do not overlap, so a passage whose sentences were put
in another order is still covered.  An item is leaked when tiles cover at least
``threshold`` of its words.

The benchmark is the stated query set: it is cut into blocks of at most
``block_mb`` of text, each sent to all tasks, and every block meets all
documents in one pass without a shuffle.

Defined results: null or empty text and items without words match nothing; an
item shorter than ``least`` words must occur as one run; repeated rows are
judged one by one; a null ``doc_id`` stays null; empty tables give empty or
clean results; further columns of the documents are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import clean_text, stage

LEAST = 5
THRESHOLD = 0.8
FIRST_LENGTH = 20
BLOCK_MB = 16
VOCABULARY_ENTRIES = 500_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = (1 << 61) - 1

RESULT = (
    "doc_id long, n_tokens long, n_items long, item_ids array<long>, "
    "max_coverage double, contaminated boolean"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("item_ids", pa.list_(pa.int64())),
        ("max_coverage", pa.float64()),
    ]
)
_PARTIAL = "doc_id long, n_tokens long, item_ids array<long>, max_coverage double"


def bare(word: str) -> str:
    """A lower-case word without the punctuation around it."""
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


def tokens(text: str) -> list[str]:
    return [t for t in map(bare, text.lower().split()) if t]


class _Vocabulary(dict):
    """Ids of raw words: an item word's id, -1 for others, -2 for no word."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> int:
        key = bare(word)
        number = self.known.get(key, -1) if key else -2
        if len(self) < VOCABULARY_ENTRIES:
            self[word] = number
        return number


def _windows(ids: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, rolling Karp-Rabin value) of every unmarked window."""
    lead = pow(1_000_003, size - 1, _BASE)
    value = run = 0
    for at, (token, taken) in enumerate(zip(ids, marked, strict=True)):
        if taken:
            value = run = 0
            continue
        if run == size:
            value = (value - (ids[at - size] + 1) * lead) % _BASE
            run -= 1
        value = (value * 1_000_003 + token + 1) % _BASE
        run += 1
        if run == size:
            yield at - size + 1, value


def greedy_tiles(
    item: list[int], doc: list[int], least: int, first: int = FIRST_LENGTH
) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in doc, length); negative doc ids match nothing."""
    in_item = [False] * len(item)
    in_doc = [t < 0 for t in doc]
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(first, len(item)))
    while True:
        found, longest = [], 0
        table: dict[int, list[int]] = {}
        for start, value in _windows(item, in_item, size):
            table.setdefault(value, []).append(start)
        for j, value in _windows(doc, in_doc, size) if table else ():
            for i in table.get(value, ()):
                k = 0
                while (
                    i + k < len(item)
                    and j + k < len(doc)
                    and item[i + k] == doc[j + k]
                    and not in_item[i + k]
                    and not in_doc[j + k]
                ):
                    k += 1
                if k >= size:
                    found.append((-k, i, j))
                    longest = max(longest, k)
        if longest > 2 * size:
            size = longest
            continue
        for k, i, j in sorted(found):
            k = -k
            if any(in_item[i : i + k]) or any(in_doc[j : j + k]):
                continue
            in_item[i : i + k] = in_doc[j : j + k] = [True] * k
            tiles.append((i, j, k))
        if _again(found, in_item, in_doc, size):
            continue
        if size <= least:
            return tiles
        size = max(least, size // 2)


def _again(found, in_item, in_doc, size: int) -> bool:
    """Whether a match that was partly covered still has a free run of ``size``."""
    for k, i, j in found:
        run = 0
        for step in range(-k):
            run = 0 if in_item[i + step] or in_doc[j + step] else run + 1
            if run == size:
                return True
    return False


class ItemBlock:
    """Items of one block with their grams in sorted arrays."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        known: dict[str, int] = {}
        self.least = least
        self.items = []
        grams: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item_id, text in items:
            ids = [known.setdefault(t, len(known)) for t in tokens(text or "")]
            if item_id is None or not ids:
                continue
            size = min(least, len(ids))
            grams.setdefault(size, []).append((np.asarray(ids, np.int64), len(self.items)))
            self.items.append((item_id, ids))
        self.known = known
        self.grams = {}
        for size, rows in grams.items():
            codes = [self.codes(ids, size) for ids, _ in rows]
            code = np.concatenate(codes)
            item = np.repeat([n for _, n in rows], [len(c) for c in codes])
            at = np.concatenate([np.arange(len(c)) for c in codes])
            order = np.argsort(code, kind="stable")
            self.grams[size] = code[order], item[order], at[order]

    @staticmethod
    def codes(ids: np.ndarray, size: int) -> np.ndarray:
        count = len(ids) - size + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        value = np.zeros(count, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                value = (value + ids[k : k + count].astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
                value ^= value >> np.uint64(29)
        return value

    def leaks(self, ids: np.ndarray, threshold: float) -> tuple[list[int], float]:
        """Leaked item ids and the highest coverage of one document's word ids."""
        leaked, highest = [], 0.0
        for size, (code, item, at) in self.grams.items():
            known = np.flatnonzero(ids >= 0)
            if len(known) < size:
                continue
            # starts of windows whose words are all item words
            starts = known[: len(known) - size + 1]
            starts = starts[known[size - 1 :] - starts == size - 1]
            if not len(starts):
                continue
            mine = self.codes(ids, size)[starts]
            low = np.searchsorted(code, mine, "left")
            count = np.searchsorted(code, mine, "right") - low
            hit = np.flatnonzero(count)
            if not len(hit):
                continue
            where = np.repeat(starts[hit], count[hit])
            first = np.repeat(low[hit] - np.cumsum(count[hit]) + count[hit], count[hit])
            entry = first + np.arange(len(first))
            items, places = item[entry], at[entry]
            order = np.argsort(items, kind="stable")
            items, places, where = items[order], places[order], where[order]
            for part in np.split(np.arange(len(items)), np.flatnonzero(np.diff(items)) + 1):
                item_id, own = self.items[items[part[0]]]
                covered = np.zeros(len(own), bool)
                for k in range(size):
                    covered[places[part] + k] = True
                highest = max(highest, 0.0)
                if covered.sum() < threshold * len(own):
                    continue
                tiles = greedy_tiles(own, self._seeded(ids, where[part], size), size)
                coverage = sum(k for _, _, k in tiles) / len(own)
                highest = max(highest, coverage)
                if coverage >= threshold:
                    leaked.append(item_id)
        return leaked, highest

    @staticmethod
    def _seeded(ids: np.ndarray, where: np.ndarray, size: int) -> list[int]:
        """The document's seeded words, runs kept apart by -1."""
        spots = np.unique((where[:, None] + np.arange(size)).ravel())
        runs = np.split(spots, np.flatnonzero(np.diff(spots) > 1) + 1)
        out: list[int] = []
        for run in runs:
            out.extend(ids[run].tolist())
            out.append(-1)
        return out


def _judge(rows: DataFrame, items: list[tuple[int, str]], least: int, threshold: float):
    """Add one block's leaks to (doc_id, text, item_ids, max_coverage)."""
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = ItemBlock(shared.value, least)
        vocabulary = _Vocabulary(block.known)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                words = text.as_py().lower().split()
                ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
                if len(ids) and ids.min() == -2:
                    ids = ids[ids != -2]
                out.append((doc.as_py(), len(ids), *block.leaks(ids, threshold)))
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
            )

    return judge


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    threshold: float = THRESHOLD,
    block_mb: float = BLOCK_MB,
) -> DataFrame:
    """One row per document row with the items it leaks (columns of ``RESULT``)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), clean_text())
    size = items.agg(F.sum(F.octet_length(items.columns[1]))).first()[0] or 0
    blocks = max(1, math.ceil(size / (block_mb * 1e6)))
    keyed = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"))
    if blocks == 1:
        out = rows.mapInArrow(_judge(rows, _rows(items), least, threshold), _PARTIAL)
    else:
        # rows get a number, so that repeated documents stay apart over the blocks
        rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
        found = None
        for number in range(blocks):
            part = _rows(keyed.filter(F.col("block") == number).drop("block"))
            judged = stage(
                rows.select(F.col("row").alias("doc_id"), "text").mapInArrow(
                    _judge(rows, part, least, threshold), _PARTIAL
                ),
                "tiled",
            )
            found = judged if found is None else found.unionByName(judged)
        by_row = found.groupBy(F.col("doc_id").alias("row")).agg(
            F.max("n_tokens").alias("n_tokens"),
            F.flatten(F.collect_list("item_ids")).alias("item_ids"),
            F.max("max_coverage").alias("max_coverage"),
        )
        out = rows.select("row", "doc_id").join(by_row, "row").drop("row")
    return out.select(
        "doc_id",
        "n_tokens",
        F.size("item_ids").cast("long").alias("n_items"),
        F.array_sort("item_ids").alias("item_ids"),
        "max_coverage",
        (F.size("item_ids") > 0).alias("contaminated"),
    )


def _rows(items: DataFrame) -> list[tuple[int, str]]:
    """The items of one block, whose size was checked before."""
    return [tuple(r) for r in items.collect()]
