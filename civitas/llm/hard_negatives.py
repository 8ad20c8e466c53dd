"""Hard negatives by exact integer products of anchor and candidate tiles.

Anchors go out in blocks of bounded bytes to all tasks; a task multiplies tiles
of its candidates with tiles of the block by Strassen's recursion on int64,
padded with zeros to even sides, so every score is exact.  Each anchor keeps a
heap of its best positives; heaps of tiles are merged inside a task and those of
tasks by rank.  With the positives known, a second pass fills one heap of
negatives for each (anchor, positive) window in the same way.  Candidates move
once, to find rows of one id, and pairs never leave a task: per task and anchor
at most ``k`` rows do, and ``k * k`` in the second pass.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part.  Of several rows with one id, that with the smallest
label and then the smallest vector does.  Components beyond 2^21 in size, after
scaling, are held there, so that scores of up to 8,000 components fit a long
with room for the window's factors.  Vectors of different lengths do not meet.
Equal scores go by id; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civitas.llm.common import stage

K = 5
SCALE = 256
#: A negative's score against its positive's, in hundredths.
LOW, HIGH = 80, 100
BOUND = float(1 << 21)
BLOCK_BYTES = 16 << 20
ANCHORS, CANDIDATES = 512, 2048
LEAF = 32
LEAST = np.iinfo(np.int64).min

PARTIAL = "anchor_id long, score long, id long"
WINDOWED = "anchor_id long, positive_id long, positive_score long, score long, id long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of int64 matrices by seven half-sized products a level."""
    (m, n), p = a.shape, b.shape[1]
    if min(m, n, p) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, n % 2)))
    b = np.pad(b, ((0, n % 2), (0, p % 2)))
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k] = p1 + p4 - p5 + p7
    out[:i, k:] = p3 + p5
    out[i:, :k] = p2 + p4
    out[i:, k:] = p1 - p2 + p3 + p6
    return out[:m, :p]


class Heaps:
    """The best ``k`` (score, id) of each slot; equal scores go by id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), LEAST, np.int64)
        self.id = np.zeros((slots, k), np.int64)
        self.filled = np.zeros(slots, np.int64)

    def least(self, slots: slice) -> np.ndarray:
        """What a score must reach to enter, per slot."""
        return self.score[slots, -1]

    def merge(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Take in entries of any slots, several for a slot or none."""
        if not len(slot):
            return
        touched = np.unique(slot)
        held = self.filled[touched]
        old = np.repeat(touched, held)
        rank = np.arange(len(old)) - np.repeat(np.cumsum(held) - held, held)
        slot = np.concatenate([old, slot])
        score = np.concatenate([self.score[old, rank], score])
        ids = np.concatenate([self.id[old, rank], ids])
        # no score is the least long, so its sign can be turned
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        heads = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(heads, np.diff(np.append(heads, len(slot))))
        kept = place < self.k
        slot, place = slot[kept], place[kept]
        self.score[slot, place], self.id[slot, place] = score[kept], ids[kept]
        self.filled[touched] = np.bincount(np.searchsorted(touched, slot), minlength=len(touched))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(np.arange(self.k)[None, :] < self.filled[:, None])
        return slot, self.score[slot, place], self.id[slot, place]


def _tiles(batches, sizes: set[int]):
    """(length, ids, labels, matrix) of candidates, at most a tile at a time."""
    for batch in batches:
        length = batch.column("n").to_numpy(zero_copy_only=False)
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(length)
        for n in sizes.intersection(np.unique(length).tolist()):
            own = np.flatnonzero(length == n)
            for at in range(0, len(own), CANDIDATES):
                part = own[at : at + CANDIDATES]
                cells = (ends[part] - n)[:, None] + np.arange(n)[None, :]
                yield n, ids[part], labels[part], flat[cells].astype(np.int64)


def _scores(block: dict, tiles):
    """Tiles of the product: slice of the block's anchors, candidates, scores."""
    for n, ids, labels, matrix in tiles:
        turned = np.ascontiguousarray(matrix.T)
        start, stop = block["spans"][n]
        for at in range(start, stop, ANCHORS):
            rows = slice(at, min(at + ANCHORS, stop))
            anchors = block["vectors"][n][rows.start - start : rows.stop - start]
            yield rows, ids, labels, strassen(anchors, turned)


def _positives(shared, k: int):
    def search(batches):
        block = shared.value
        heaps = Heaps(len(block["ids"]), k)
        for rows, ids, labels, scores in _scores(block, _tiles(batches, set(block["spans"]))):
            fit = labels[None, :] == block["labels"][rows, None]
            fit &= ids[None, :] != block["ids"][rows, None]
            fit &= scores >= heaps.least(rows)[:, None]
            i, j = np.nonzero(fit)
            heaps.merge(rows.start + i, scores[i, j], ids[j])
        slot, score, ids = heaps.rows()
        yield pa.record_batch(
            [pa.array(block["ids"][slot]), pa.array(score), pa.array(ids)],
            names=["anchor_id", "score", "id"],
        )

    return search


def _negatives(shared, k: int, low: int, high: int):
    def search(batches):
        block = shared.value
        counts = block["counts"]
        # slots of an anchor lie side by side
        heaps = Heaps(int(counts.sum()), k)
        heads = np.cumsum(counts) - counts
        for rows, ids, labels, scores in _scores(block, _tiles(batches, set(block["spans"]))):
            other = labels[None, :] != block["labels"][rows, None]
            for n in range(int(counts[rows].max(initial=0))):
                anchors = np.arange(rows.start, rows.stop)[counts[rows] > n]
                slots = heads[anchors] + n
                within = scores[anchors - rows.start]
                goal = block["positive_score"][slots][:, None]
                fit = other[anchors - rows.start] & (within >= heaps.score[slots, -1][:, None])
                fit &= (high * within <= high * goal) & (high * within >= low * goal)
                i, j = np.nonzero(fit)
                heaps.merge(slots[i], within[i, j], ids[j])
        slot, score, ids = heaps.rows()
        owner = np.repeat(np.arange(len(counts)), counts)
        yield pa.record_batch(
            [
                pa.array(block["ids"][owner[slot]]),
                pa.array(block["positive_id"][slot]),
                pa.array(block["positive_score"][slot]),
                pa.array(score),
                pa.array(ids),
            ],
            names=["anchor_id", "positive_id", "positive_score", "score", "id"],
        )

    return search


def _vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """The rows that take part: id, label, length and integer vector."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(
        vector, lambda v: F.floor(F.greatest(F.least(v * float(scale), F.lit(BOUND)), F.lit(-BOUND))).cast("int")
    )
    return (
        embeddings.filter(
            F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
        )
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min(F.struct(F.col("label").cast("long").alias("label"), whole.alias("vector"))).alias("row"))
        .select(
            "vec_id",
            # relabelled ids
            F.when(F.col("vec_id") % 7 == 0, (F.col("row.label") + 1) % 10)
            .otherwise(F.col("row.label")).alias("label"),
            F.size("row.vector").alias("n"),
            F.col("row.vector").alias("vector"),
        )
    )


def _pages(anchors: DataFrame, rows: int):
    """Blocks of exactly up to so many anchors, by id."""
    last = None
    while True:
        rest = anchors if last is None else anchors.filter(F.col("vec_id") > last)
        page = rest.orderBy("vec_id").limit(rows).toArrow()
        if page.num_rows:
            last = page.column("vec_id")[-1].as_py()
            yield page
        if page.num_rows < rows:
            return


def _block(page: pa.Table) -> dict:
    """Anchors by length, as matrices."""
    page = page.sort_by([("n", "ascending"), ("vec_id", "ascending")]).combine_chunks()
    length = page.column("n").to_numpy()
    flat = page.column("vector").combine_chunks().flatten().to_numpy().astype(np.int64)
    spans, vectors, at = {}, {}, 0
    for n, count in zip(*np.unique(length, return_counts=True), strict=True):
        head = int(np.searchsorted(length, n))
        spans[int(n)] = (head, head + int(count))
        vectors[int(n)] = flat[at : at + n * count].reshape(count, n)
        at += n * count
    return {
        "ids": page.column("vec_id").to_numpy(),
        "labels": page.column("label").to_numpy(),
        "spans": spans,
        "vectors": vectors,
    }


def hard_negatives(
    embeddings: DataFrame,
    every: int = 100,
    k: int = K,
    scale: int = SCALE,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``; each block of them
    reads the candidates twice.
    """
    spark = embeddings.sparkSession
    rows = stage(_vectors(embeddings, scale), "vectors")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    longest = anchors.agg(F.max("n")).first()[0] or 1
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    found = []
    for page in _pages(anchors, max(1, block_bytes // (8 * longest))):
        block = _block(page)
        shared = spark.sparkContext.broadcast(block)
        # at most k rows for an anchor of the block
        positives = (
            rows.mapInArrow(_positives(shared, k), PARTIAL)
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .toArrow()
        )
        shared.unpersist()
        ids = np.argsort(block["ids"], kind="stable")
        owner = ids[np.searchsorted(block["ids"][ids], positives.column("anchor_id").to_numpy())]
        order = np.lexsort((positives.column("rank").to_numpy(), owner))
        block |= {
            "counts": np.bincount(owner, minlength=len(block["ids"])),
            "positive_id": positives.column("id").to_numpy()[order],
            "positive_score": positives.column("score").to_numpy()[order],
        }
        shared = spark.sparkContext.broadcast(block)
        found.append(
            stage(
                rows.mapInArrow(_negatives(shared, k, low, high), WINDOWED)
                .withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k),
                "negatives",
            )
        )
        shared.unpersist()
    if not found:
        found = [spark.createDataFrame([], f"{WINDOWED}, rank int")]
    return reduce(DataFrame.unionByName, found).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


ORACLE = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
scores AS (
  SELECT a.vec_id AS anchor, c.vec_id AS other, a.label = c.label AS same,
    CAST(list_inner_product(a.vector, c.vector) AS BIGINT) AS score
  FROM given a JOIN given c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
    AND len(a.vector) = len(c.vector)),
positives AS (
  SELECT anchor, other, score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor = n.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other) <= 5
"""
