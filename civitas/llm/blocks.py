"""Blocks of documents that ask keyed questions of all others.

A block sends its distinct 64-bit keys, with values, to the buckets of the keys;
a bucket meets what all blocks sent and answers each of them, aligned with what
it sent.  Only compact arrays move, one row per (block, bucket), and a key that
is everywhere is one entry per block.

Kinds of columns are numpy's; a column that rises strictly, but for zeros that
stand for nothing, may be ``+`` and its kind: its steps are sent, and of these the
low bytes, which are as good as random, are not compressed.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import briefly, stage_bucketed
from civitas.llm.common import parts as partitions

SENT = "block long, bucket long, entries long, blob binary"
ANSWER = "block long, bucket long, blob binary, total long, most long"


def order_of(keys: np.ndarray, buckets: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The order in which distinct keys, of which ``bits`` are sent, are sent, and their buckets in it."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((keys & np.uint64((1 << bits) - 1), bucket))
    return order, bucket[order].astype(np.int64)


def ranges_of(keys: np.ndarray, buckets: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of rising keys below ``2**bits``, by range, and what is left of the keys in them."""
    width = np.uint64(min(-(-(1 << bits) // buckets), (1 << 64) - 1))
    bucket = keys // width
    return bucket.astype(np.int64), keys - bucket * width


def _planes(column: np.ndarray) -> np.ndarray:
    """Equal bytes of the numbers lie together."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), column.itemsize).T


def _steps(column: np.ndarray) -> np.ndarray:
    return np.diff(np.maximum.accumulate(column), prepend=column.dtype.type(0))


def packed(columns: Sequence[np.ndarray], kinds: Sequence[str] | None = None) -> bytes:
    """Compressed columns; without kinds none is taken to rise."""
    import zstandard

    heads, plain, rest = [], [], []
    for column, kind in zip(columns, kinds or [""] * len(columns), strict=True):
        planes = _planes(_steps(column) if kind.startswith("+") else column)
        if kind.startswith("+"):
            step = int(column.max(initial=0)) // max(len(column), 1)
            even = min(max(step.bit_length() - 1, 0) // 8, len(planes) - 1)
            heads.append(even)
            plain.append(planes[:even].tobytes())
            planes = planes[even:]
        rest.append(planes.tobytes())
    front = struct.pack("<I", len(columns[0])) + bytes(heads) + b"".join(plain) if heads else b""
    return front + zstandard.ZstdCompressor(level=1).compress(b"".join(rest))


def unpacked(blob: bytes, kinds: Sequence[str]) -> list[np.ndarray]:
    import zstandard

    rising = [k.startswith("+") for k in kinds]
    dtypes = [np.dtype(k.removeprefix("+")) for k in kinds]
    widths = [d.itemsize for d in dtypes]
    even, plain, front = [0] * len(kinds), 0, 0
    if any(rising):
        plain = 4 + sum(rising)
        heads = iter(blob[4:plain])
        even = [next(heads) if r else 0 for r in rising]
        front = plain + struct.unpack_from("<I", blob)[0] * sum(even)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(blob)[front:]), np.uint8)
    entries, at, out = len(raw) // (sum(widths) - sum(even)), 0, []
    for dtype, width, low, rises in zip(dtypes, widths, even, rising, strict=True):
        part = raw[at : at + entries * (width - low)].reshape(width - low, entries)
        at += entries * (width - low)
        if low:
            lows = np.frombuffer(blob, np.uint8, entries * low, plain).reshape(low, entries)
            part, plain = np.concatenate([lows, part]), plain + entries * low
        column = np.ascontiguousarray(part.T).view(dtype).reshape(entries)
        if rises:
            column = np.where(column > 0, np.cumsum(column, dtype=dtype), 0).astype(dtype)
        out.append(column)
    return out


def send(
    block: int, bucket: np.ndarray, columns: Sequence[np.ndarray], kinds: Sequence[str] | None = None
) -> pa.RecordBatch:
    """Rows for columns that are in sending order already."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    heads = np.append(0, cuts) if len(bucket) else np.zeros(0, np.int64)
    stops = np.append(cuts, len(bucket)) if len(bucket) else heads
    blobs = [
        packed([c[a:b] for c in columns], kinds)
        for a, b in zip(heads.tolist(), stops.tolist(), strict=True)
    ]
    return pa.record_batch(
        [
            pa.array(np.full(len(heads), block, np.int64)),
            pa.array(bucket[heads]),
            pa.array(stops - heads, pa.int64()),
            pa.array(blobs, pa.binary()),
        ],
        names=["block", "bucket", "entries", "blob"],
    )


def _columns(blobs: list[bytes], kinds: Sequence[str]) -> list[np.ndarray]:
    """Columns of several blobs, end to end."""
    return [np.concatenate(c) for c in zip(*[unpacked(b, kinds) for b in blobs], strict=True)]


def answered(
    sent: DataFrame,
    kinds: Sequence[str],
    answer: Callable[[list[np.ndarray]], tuple[list[np.ndarray], int]],
    label: str,
    gives: Sequence[str] | None = None,
    keep: bool = False,
) -> DataFrame:
    """(block, answers, total, most): what the buckets answer, written as a table bucketed by block.

    ``most`` is the largest number in the last column of the answers, if that one rises.
    """
    numbers = bool(gives) and gives[-1].startswith("+")

    def reduce(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        sizes = table.column("entries").to_pylist()
        columns, total = answer(_columns(table.column("blob").to_pylist(), kinds))
        cuts = np.cumsum(sizes)[:-1]
        parts = zip(*[np.split(c, cuts) for c in columns], strict=True)
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "blob": pa.array([packed(p, gives) for p in parts], pa.binary()),
                "total": pa.array([total] + [0] * (len(sizes) - 1), pa.int64()),
                "most": pa.array([int(columns[-1].max()) if numbers else 0] * len(sizes), pa.int64()),
            }
        )

    # what was sent is deleted before the answers move
    with briefly(sent.groupBy("bucket").applyInArrow(lambda _, t: reduce(t), ANSWER), label) as answers:
        return stage_bucketed(
            answers.groupBy("block").agg(
                F.collect_list(F.struct("bucket", "blob")).alias(label),
                F.sum("total").alias("total"),
                F.max("most").alias("most"),
            ),
            label,
            "block",
            partitions(sent),
            keep,
        )


def received(answers: list[dict] | None, kinds: Sequence[str], most: int = 0) -> list[np.ndarray]:
    """A block's answers in sending order.

    With ``most``, numbers in the last column, from 1 in each bucket, become numbers from 1 over
    all buckets, which have that many each.
    """
    rows = sorted(answers or (), key=lambda a: a["bucket"])
    if not rows:
        return [np.zeros(0, k.removeprefix("+")) for k in kinds]
    parts = [unpacked(r["blob"], kinds) for r in rows]
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    if most:
        before = np.repeat([r["bucket"] for r in rows], [len(p[-1]) for p in parts]).astype(np.uint64)
        columns[-1] = np.where(columns[-1] > 0, before * np.uint64(most) + columns[-1], 0).astype(np.uint64)
    return columns
