"""Bounded-space online packing of token streams into fixed windows.

Every partition holds at most ``open_windows`` unfinished windows.  A document's
whole windows go out at once; its rest is placed into the open window whose gap
is smallest among those that can take it.  When none can and no further window
may be opened, the fullest is topped up with the head of the rest (unless its
gap is below ``least_cut``) and goes out.  What is open at the end of a
partition is staged with its ids and merged with that of ``merge_width``
neighbour partitions: best fit over whole windows first, then end to end; the
last tail is cut into powers of two, which need no padding.

Defined results: null text is an empty document (its end id alone); null
``doc_id`` stays null; repeated rows are packed once each; an empty table gives
no pieces; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import clean_text, parts, stage

WINDOW = 2048
END_ID = 1
OPEN_WINDOWS = 64
LEAST_CUT = 8
MERGE_WIDTH = 8
CACHE_ENTRIES = 1_000_000

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
STAGED = f"{PIECE}, part long, ids binary"
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64())]
    + [("ids", pa.binary())]
)

# Letters, numbers and white space of Latin, Greek, Cyrillic and
# general punctuation.  All of these were assigned long ago, so every version of
# Unicode sorts them alike.
_LETTERS = (
    r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u0233\u0391-\u03a1\u03a3-\u03f5\u03f7-\u0481\u048a-\u04ff"
)
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = r"\t-\r \x85\xa0\u2000-\u200a"
_SETTLED = re.compile(
    rf"[\x00-\u0233{_LETTERS}\u03f6\u2000-\u2027\u2030-\u205e\u20ac\u2122]*"
).fullmatch
# Fixed value: the pre-token pattern of byte-level BPE, over these characters.
_PRE_TOKENS = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
).findall
#: Characters of texts that are looked up together.
TOGETHER = 1 << 20
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Texts to their ids as little-endian bytes.

    Byte-level BPE never merges across pre-tokens, so a text is looked up one by
    one of these and only unseen ones reach the tokenizer, those of many texts in
    one call.  Texts with characters outside ``_SETTLED`` or with an added token
    go there as a whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.seen: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def many(self, texts: list[str]) -> list[bytes]:
        if len(self.seen) > CACHE_ENTRIES:
            self.seen.clear()
        get, out, late, new = self.seen.get, [], [], {}
        for text in texts:
            if any(a in text for a in self.added) or not (text.isascii() or _SETTLED(text)):
                out.append(self._ids([text])[0])
                continue
            pieces = _PRE_TOKENS(text)
            found = list(map(get, pieces))
            if None in found:
                # looked up again: the holes alone, not the whole text
                holes = [(n, pieces[n]) for n, f in enumerate(found) if f is None]
                new.update(dict.fromkeys(p for _, p in holes))
                late.append((len(out), found, holes))
                out.append(b"")
            else:
                out.append(b"".join(found))
        if new:
            self.seen.update(zip(new, self._ids(list(new)), strict=True))
            for at, found, holes in late:
                for n, piece in holes:
                    found[n] = self.seen[piece]
                out[at] = b"".join(found)
        return out


def encoder(path: str) -> Encoder:
    """The encoder of a worker; its cache outlives the task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in groups of about ``TOGETHER`` characters."""
    for batch in batches:
        docs, texts, size = [], [], 0
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            docs.append(doc.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= TOGETHER:
                yield docs, texts
                docs, texts, size = [], [], 0
        if docs:
            yield docs, texts


class Packer:
    """Windows of one partition; ``done`` collects pieces of finished windows."""

    def __init__(self, window: int, most_open: int, least_cut: int, first_id: int):
        self.window, self.most_open, self.least_cut = window, most_open, least_cut
        self.next_id = first_id
        self.open: list[tuple[int, int]] = []  # (gap, sequence), sorted
        self.held: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _put(self, piece: tuple, sequence: int, gap: int) -> None:
        """Place a piece (doc, start, ids, doc tokens) and close a full window."""
        doc, start, ids, total = piece
        row = (doc, start, ids, total, sequence, self.window - gap)
        gap -= len(ids) // 4
        held = self.held.setdefault(sequence, [])
        held.append(row)
        if gap:
            insort(self.open, (gap, sequence))
        else:
            self.done.extend(self.held.pop(sequence))

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        while ids:
            size = len(ids) // 4
            if size >= self.window:
                head = ids[: self.window * 4]
                self._put((doc, start, head, total), self._new(), self.window)
                ids, start = ids[self.window * 4 :], start + self.window
                continue
            at = bisect_left(self.open, (size, -1))
            if at < len(self.open):
                gap, sequence = self.open.pop(at)
            elif len(self.open) < self.most_open:
                gap, sequence = self.window, self._new()
            else:
                gap, sequence = self.open.pop(0)
                if gap >= self.least_cut:
                    self._put((doc, start, ids[: gap * 4], total), sequence, gap)
                    ids, start = ids[gap * 4 :], start + gap
                else:
                    self.done.extend(self.held.pop(sequence))
                continue
            self._put((doc, start, ids, total), sequence, gap)
            return

    def take(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


def _batch(rows: list[tuple], part: int | None) -> pa.RecordBatch:
    """Piece rows; open ones carry their partition and ids."""
    doc, start, ids, total, sequence, offset = zip(*rows, strict=True) if rows else [()] * 6
    columns = [
        doc,
        start,
        [len(i) // 4 for i in ids],
        [zlib.crc32(i) for i in ids],
        total,
        sequence,
        offset,
        [part] * len(rows),
        ids if part is not None else [None] * len(rows),
    ]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)]
    return pa.record_batch(arrays, schema=_ARROW)


def _merge(held: list[tuple], window: int, first_id: int) -> list[tuple]:
    """Merge open windows of several partitions: best fit, then end to end."""
    by_window: dict[int, list[tuple]] = {}
    for row in held:
        by_window.setdefault(row[4], []).append(row)
    loads = [sorted(rows, key=lambda r: r[5]) for rows in by_window.values()]
    size = {id(rows): sum(len(r[2]) for r in rows) // 4 for rows in loads}
    loads.sort(key=lambda rows: (-size[id(rows)], rows[0][4]))
    gaps: list[tuple[int, int]] = []
    bins: list[list[tuple]] = []
    for rows in loads:
        need = size[id(rows)]
        at = bisect_left(gaps, (need, -1))
        gap, number = gaps.pop(at) if at < len(gaps) else (window, len(bins))
        if number == len(bins):
            bins.append([])
        bins[number].extend(rows)
        insort(gaps, (gap - need, number))
    whole = {number for gap, number in gaps if gap == 0}
    out: list[tuple] = []
    following = first_id

    def lay(rows: list[tuple], sequence: int) -> None:
        offset = 0
        for doc, start, ids, total, *_ in rows:
            out.append((doc, start, ids, total, sequence, offset))
            offset += len(ids) // 4

    for number in sorted(whole):
        lay(bins[number], following)
        following += 1
    rest = [row for n, rows in enumerate(bins) if n not in whole for row in rows]
    left = sum(len(r[2]) for r in rest) // 4
    queue = rest[::-1]
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        rows = []
        while room:
            doc, start, ids, total, *tail = queue.pop()
            now, later = ids[: room * 4], ids[room * 4 :]
            rows.append((doc, start, now, total))
            room -= len(now) // 4
            if later:
                queue.append((doc, start + len(now) // 4, later, total, *tail))
        lay(rows, following)
        following += 1
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
    merge_width: int = MERGE_WIDTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece of a packed document (columns of ``PIECE``)."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        packer = Packer(window, open_windows, least_cut, part << 32)
        for docs, texts in _together(batches):
            for doc, ids in zip(docs, encode.many(texts), strict=True):
                packer.add(doc, 0, ids + end, len(ids) // 4 + 1)
            yield _batch(packer.take(), None)
        yield _batch([r for rows in packer.held.values() for r in rows], part)

    def merge(table: pa.Table) -> pa.Table:
        names = ("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset")
        rows = list(zip(*(table.column(n).to_pylist() for n in names), strict=True))
        group = min(table.column("part").to_pylist()) // merge_width
        merged = _merge(sorted(rows, key=lambda r: r[4:]), window, (1 << 62) | group << 32)
        batch = _batch(merged, group)
        return pa.Table.from_batches([batch]).select(_ARROW.names[:7])

    columns = [c.name for c in _ARROW][:7]
    placed = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"))
        .mapInArrow(place, STAGED),
        "packed",
    )
    groups = F.floor(F.col("part") / merge_width)
    merged = (
        placed.filter("part is not null")
        .withColumn("neighbours", groups)
        .repartition(parts(docs), "neighbours")
        .groupBy("neighbours")
        .applyInArrow(lambda _, t: merge(t), PIECE)
    )
    return placed.filter("part is null").select(*columns).unionByName(merged)
