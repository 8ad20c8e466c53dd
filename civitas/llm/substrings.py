"""Exact removal of byte strings that a document with a smaller id also has.

Every ``WINDOW``-byte string is known by its anchor, the ``GRAM``-byte string in
it with the smallest hash; equal strings have equal anchors.  A document falls
into contexts, maximal stretches whose windows have one anchor.

1. Documents are packed, in scan order, into blocks of a few megabytes, written
   once as a bucketed table: texts are never shuffled.
2. Each block sends the distinct anchors it has, four bytes each, to the
   anchors' buckets and gets one bit back for each: whether another document
   has it.
3. Contexts with such anchors go, as fingerprints and with the block's smallest
   document, to the anchors' buckets as well.  A context that a smaller document
   has whole is removed whole.
4. Where an anchor has several different contexts, windows of two of them can be
   equal only if what all windows with the anchor at about the same place have
   around it is equal; blocks ask for that like for anchors.  Words that are
   frequent make ever more anchors common by chance as a corpus grows, but
   hardly any of these longer strings.
5. The bytes of what is left (one document's for each context) are brought
   together; where they differ they are sorted by suffix groups
   (:mod:`suffix_groups`), and windows that are equal get the smallest document
   that has them.
6. Back at the blocks, the spans of each document are merged and cut out.

An anchor with very many contexts is not one group: what is left of its contexts
is sent as single windows keyed by their own hash.

Defined results: null text is empty; documents shorter than the window are kept;
rows with equal ``doc_id`` do not remove from each other; a null ``doc_id``
counts as larger than all others; cut characters are dropped from kept texts;
empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.blocks import SENT, answered, received, send
from civitas.llm.common import parts, passing, stage
from civitas.llm.order_minhash import mix
from civitas.llm.suffix_groups import shared_windows

WINDOW = 50
GRAM = 16
BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 8_000_000
BATCH_BYTES = 1_000_000
BATCH_SPANS = 50_000
HOT_CONTEXTS = 20_000
CHUNK = 1 << 17
LAST = (1 << 63) - 1
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)

SPAN = "block long, row int, start int, size int"


# -- blocks --------------------------------------------------------------------


def _blocks(frame: DataFrame) -> DataFrame:
    """Rows in blocks: ids, texts end to end, and the other columns as they came."""
    names = frame.columns
    text_at, id_at = names.index("text"), names.index("doc_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column(text_at)]
            docs = [LAST if d.as_py() is None else d.as_py() for d in batch.column(id_at)]
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BLOCK_BYTES):
                    size += len(texts[stop])
                    stop += 1
                others = pa.table(batch.slice(start, stop - start)).drop_columns(["text"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, others.schema) as writer:
                    writer.write_table(others)
                yield pa.record_batch(
                    [
                        pa.array([(part << 32) | number], pa.int64()),
                        pa.array([size], pa.int64()),
                        pa.array([docs[start:stop]], pa.list_(pa.int64())),
                        pa.array([[len(t) for t in texts[start:stop]]], pa.list_(pa.int32())),
                        pa.array([b"".join(texts[start:stop])], pa.large_binary()).cast(pa.binary()),
                        pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    ],
                    names=["block", "bytes", "docs", "sizes", "data", "others"],
                )
                start, number = stop, number + 1

    return frame.mapInArrow(
        pack, "block long, bytes long, docs array<long>, sizes array<int>, data binary, others binary"
    )


class Block:
    """The contexts of one block's documents."""

    def __init__(self, docs: np.ndarray, sizes: np.ndarray, data: bytes):
        self.docs, self.sizes = docs, sizes
        self.offsets = np.cumsum(sizes, dtype=np.int64) - sizes
        total = int(sizes.sum())
        self.total = total
        self.padded = np.zeros(total + 2 * WINDOW, np.uint8)
        self.padded[:total] = np.frombuffer(data, np.uint8, total)
        self.hashed = np.empty(total, np.uint64)
        least = np.empty(total, np.uint64)
        reach = WINDOW - GRAM + 1
        for at in range(0, total, CHUNK):  # pieces that fit the processor's cache
            stop = min(total, at + CHUNK)
            eights = _eights(self.padded[at : stop + reach - 1 + GRAM])
            hashed = mix(eights[: stop - at + reach - 1] ^ mix(eights[8 : stop - at + reach + 7]))
            self.hashed[at:stop] = hashed[: stop - at]
            width = 1
            while width < reach:
                step = min(width, reach - width)
                hashed = np.minimum(hashed[:-step], hashed[step:])
                width += step
            least[at:stop] = hashed
        lengths = np.maximum(sizes - WINDOW + 1, 0)
        self.rows = np.repeat(np.arange(len(sizes)), lengths)
        starts = np.repeat(self.offsets - (np.cumsum(lengths) - lengths), lengths)
        starts = starts + np.arange(len(self.rows))
        value = least[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)
        heads = np.flatnonzero(fresh)
        self.first = starts[heads]
        self.last = starts[np.append(heads[1:], len(starts)) - 1] if len(heads) else self.first
        self.rows = self.rows[heads]
        self.keys = value[heads]

    def codes(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _codes(self.keys, self.docs[self.rows], buckets)

    def contexts(self, block: int, chosen: np.ndarray) -> pa.RecordBatch:
        """The chosen contexts: one row of arrays."""
        first, last, rows = self.first[chosen], self.last[chosen], self.rows[chosen]
        keys = self.keys[chosen]
        powers, back = _powers(self.total + 1)
        sums = np.zeros(self.total + 1, np.uint64)
        for at in range(0, self.total, CHUNK):
            stop = min(self.total, at + CHUNK)
            eights = mix(_eights(self.padded[at : stop + 7])) * powers[at:stop]
            eights[0] += sums[at]
            np.cumsum(eights, out=sums[at + 1 : stop + 1])
        size = (last - first + WINDOW).astype(np.uint64)
        prints = mix((sums[last + WINDOW - 7] - sums[first]) * back[first] + mix(size))
        anchor = np.full(len(first), NO_ANCHOR, np.uint8)
        # none where the anchor has several places; one place is in all windows
        open_ = np.flatnonzero(last - first <= WINDOW - GRAM)
        seen = np.zeros(len(first), bool)
        for step in range(2 * (WINDOW - GRAM) + 1):
            at = first[open_] + step
            inside = at <= last[open_] + WINDOW - GRAM
            open_, at = open_[inside], at[inside]
            found = self.hashed[at] == keys[open_]
            hit, again = open_[found], found & seen[open_]
            anchor[hit] = np.where(seen[hit], NO_ANCHOR, step)
            seen[hit] = True
            open_ = open_[~again]
        columns = [
            keys, prints, first.astype("<u4"), last.astype("<u4"), rows.astype("<u4"), anchor,
        ]
        return pa.record_batch(
            [pa.array([block], pa.int64()), pa.array([len(first)], pa.int64())]
            + [pa.array([c.tobytes()], pa.binary()) for c in columns],
            names=["block", "contexts", *CONTEXT_KINDS],
        )


#: Arrays of a block's contexts; the anchor's place in it, or none.
CONTEXT_KINDS = {
    "keys": "<u8", "prints": "<u8", "first": "<u4", "last": "<u4", "rows": "<u4", "anchors": "<u1",
}
CONTEXTS = "block long, contexts long, " + ", ".join(f"{n} binary" for n in CONTEXT_KINDS)
NO_ANCHOR = 255
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, remembered by the process."""
    if len(_POWERS[0]) < size:
        for at, factor in enumerate((_ODD, _INVERSE)):
            odd = np.full(size + size // 4, factor, np.uint64)
            odd[0] = 1
            _POWERS[at] = np.cumprod(odd)
    return _POWERS


class Contexts:
    """A block's contexts as its buckets know them: distinct, with the smallest document."""

    def __init__(self, row: dict, docs: np.ndarray, buckets: int):
        self.keys, self.prints, self.first, self.last, self.rows, self.anchors = (
            np.frombuffer(row[n], kind) for n, kind in CONTEXT_KINDS.items()
        )
        self.docs = docs[self.rows]
        order = np.lexsort((self.prints, self.keys))
        keys, prints = self.keys[order], self.prints[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])
        heads = np.flatnonzero(fresh)
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(fresh) - 1
        least = np.minimum.reduceat(self.docs[order], heads) if len(heads) else self.docs
        bucket = ((keys[heads] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        self.sent = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.sent]
        self.columns = [keys[heads][self.sent], prints[heads][self.sent], least[self.sent]]
        self.least = least

    def verdicts(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per context: whether a smaller document has it whole, and its answer."""
        code = np.empty(len(self.sent), np.uint8)
        code[self.sent] = answers
        code = code[self.of]
        return (self.docs > self.least[self.of]) | (code == ELSEWHERE), code


#: Answers of the buckets.
ALONE, ELSEWHERE, SEVERAL, CROWDED = range(4)
SENT_KINDS = ("<u8", "<u8", "<i8")


def _judge_contexts(columns: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Who has a context first, and whether its anchor has others."""
    keys, prints, docs = columns
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    new_key = np.ones(len(order), bool)
    new_key[1:] = keys[1:] != keys[:-1]
    fresh = new_key.copy()
    fresh[1:] |= prints[1:] != prints[:-1]
    least = np.minimum.reduceat(docs[order], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
    kinds = np.add.reduceat(fresh.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
    code = np.where(kinds > HOT_CONTEXTS, CROWDED, np.where(kinds > 1, SEVERAL, ALONE))
    result = np.empty(len(order), np.uint8)
    result[order] = np.where(least < docs[order], ELSEWHERE, code)
    return [result], 0


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as one number."""
    out = np.empty(len(data) - 7, np.uint64)
    for shift in range(8):
        words = data[shift : shift + (len(data) - shift) // 8 * 8].view("<u8")
        target = out[shift::8]
        target[:] = words[: len(target)]
    return out


def _codes(keys: np.ndarray, docs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, low bits) codes in order, inverse, and whether two documents have it."""
    high = (keys >> np.uint64(32)) % np.uint64(buckets)
    code = (high << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
    distinct, inverse = np.unique(code, return_inverse=True)
    low = np.full(len(distinct), LAST, np.int64)
    high_doc = np.full(len(distinct), -LAST, np.int64)
    np.minimum.at(low, inverse, docs)
    np.maximum.at(high_doc, inverse, docs)
    return distinct, inverse, low != high_doc


def _of(batch: pa.RecordBatch, at: int) -> Block:
    docs = batch.column("docs")[at].values.to_numpy(zero_copy_only=False)
    sizes = batch.column("sizes")[at].values.to_numpy(zero_copy_only=False).astype(np.int64)
    return Block(docs, sizes, batch.column("data")[at].as_buffer())


# -- which anchors do several documents have -------------------------------------


ASKED = "block long, bucket long, anchors binary, several binary"


def _asked(block: int, codes: np.ndarray, several: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket that is asked."""
    owner = (codes >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(owner)) + 1
    low = (codes & np.uint64(0xFFFFFFFF)).astype("<u4")
    numbers = owner[np.append(0, cuts)] if len(owner) else []
    return pa.record_batch(
        [
            pa.array([block] * len(numbers), pa.int64()),
            pa.array(numbers, pa.int64()),
            pa.array([p.tobytes() for p in np.split(low, cuts)][: len(numbers)], pa.binary()),
            pa.array([np.packbits(p).tobytes() for p in np.split(several, cuts)][: len(numbers)], pa.binary()),
        ],
        names=["block", "bucket", "anchors", "several"],
    )


def _anchors(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                codes, _, several = _of(batch, at).codes(buckets)
                yield _asked(batch.column("block")[at].as_py(), codes, several)

    return send


def _repeated(table: pa.Table) -> pa.Table:
    """One bit per anchor sent to a bucket."""
    sent = [np.frombuffer(b, "<u4") for b in table.column("anchors").to_pylist()]
    sizes = [len(s) for s in sent]
    several = np.concatenate(
        [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table.column("several").to_pylist(), sizes, strict=True)]
    )
    _, inverse, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    found = counts > 1
    np.logical_or.at(found, inverse, several.astype(bool))
    bits = np.split(found[inverse], np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "bits": pa.array([np.packbits(b).tobytes() for b in bits], pa.binary()),
        }
    )


def _answers(asked: DataFrame, label: str) -> DataFrame:
    """(block, answers): the bits for what each block asked."""
    return stage(
        asked.groupBy("bucket")
        .applyInArrow(lambda _, t: _repeated(t), "block long, bucket long, bits binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("bucket", "bits")).alias(label)),
        label,
    )


def _found(codes: np.ndarray, answers: list[dict]) -> np.ndarray:
    """Which of the codes another document has."""
    bits = {a["bucket"]: a["bits"] for a in answers}
    numbers, counts = np.unique((codes >> np.uint64(32)).astype(np.int64), return_counts=True)
    return np.concatenate(
        [np.zeros(0, np.uint8)]
        + [
            np.unpackbits(np.frombuffer(bits[n], np.uint8), count=c)
            for n, c in zip(numbers.tolist(), counts.tolist(), strict=True)
        ]
    ).astype(bool)


def _contexts(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                answers = batch.column("answers")[at].as_py()
                if not answers:
                    continue
                block = _of(batch, at)
                codes, inverse, _ = block.codes(buckets)
                found = _found(codes, answers)
                yield block.contexts(batch.column("block")[at].as_py(), np.flatnonzero(found[inverse]))

    return emit


# -- different contexts of one anchor ----------------------------------------------


CUT = "block long, spans binary, key long, row int, start int, doc long, anchor int, text binary"
_CUT = pa.schema(
    [
        ("block", pa.int64()), ("spans", pa.binary()), ("key", pa.int64()), ("row", pa.int32()),
        ("start", pa.int32()), ("doc", pa.int64()), ("anchor", pa.int32()), ("text", pa.binary()),
    ]
)


def _sends(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                own = Contexts(row, np.asarray(row["docs"], np.int64), buckets)
                yield send(row["block"], own.bucket, own.columns)

    return ask


class Compared:
    """The contexts of a block that no document has whole, but whose anchor others have as well.

    Of each, the windows are taken by the place of the anchor in them, within ``SPREADS``:
    from ``start`` to ``stop``, with a hash of the bytes that these places have in common.
    """

    def __init__(self, row: dict, data: pa.Buffer, buckets: int):
        self.own = own = Contexts(row, np.asarray(row["docs"], np.int64), buckets)
        self.whole, self.code = own.verdicts(received(row["codes"], ("<u1",))[0])
        self.wanted = np.flatnonzero(~self.whole & (self.code >= SEVERAL))
        self.first, self.last = (c[self.wanted].astype(np.int64) for c in (own.first, own.last))
        self.place = own.anchors[self.wanted].astype(np.int64)
        keys = own.keys[self.wanted]
        eights = _eights(np.frombuffer(data, np.uint8)) if len(keys) else np.zeros(0, np.uint64)
        one = np.flatnonzero(self.place != NO_ANCHOR)
        several = np.flatnonzero(self.place == NO_ANCHOR)
        grams = (self.last - self.first)[several] + WINDOW - GRAM + 1
        of = np.repeat(several, grams)
        at = np.arange(len(of)) + np.repeat(self.first[several] - (np.cumsum(grams) - grams), grams)
        hit = mix(eights[at] ^ mix(eights[at + 8])) == keys[of]
        of = np.concatenate([one, of[hit]])
        at = np.concatenate([self.first[one] + self.place[one], at[hit]])
        parts = []
        for number, (least, most) in enumerate(SPREADS):
            start = np.maximum(at - most, self.first[of])
            stop = np.minimum(at - least, self.last[of])
            has = start <= stop
            common, size = at[has] - least, WINDOW - most + least
            hashed = np.full(len(common), number, np.uint64)
            for step in (*range(0, size - 8, 8), size - 8):
                hashed = mix(hashed ^ eights[common + step])
            parts.append((of[has], start[has], stop[has], hashed))
        self.of, self.start, self.stop, hashes = map(np.concatenate, zip(*parts, strict=True))
        self.codes, self.inverse, self.several = _codes(hashes, own.docs[self.wanted[self.of]], buckets)

    def left(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, first, last) of the windows that another document can have."""
        found = _found(self.codes, answers)[self.inverse]
        return self.of[found], self.start[found], self.stop[found]


#: Places of the anchor in a window, from and to.
SPREADS = ((0, 8), (9, 17), (18, 26), (27, WINDOW - GRAM))


def _compared(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[dict, pa.Buffer, Compared]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = {n: batch.column(n)[at].as_py() for n in batch.schema.names if n != "data"}
            data = batch.column("data")[at].as_buffer()
            yield row, data, Compared(row, data, buckets)


def _surroundings(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, compared in _compared(batches, buckets):
            yield _asked(row["block"], compared.codes, compared.several)

    return ask


def _cut(buckets: int):
    """Spans of what a smaller document has whole; bytes of contexts to compare."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, compared in _compared(batches, buckets):
            own, whole = compared.own, compared.whole
            sizes = np.asarray(row["sizes"], np.int64)
            offsets = np.cumsum(sizes) - sizes
            first, last = own.first.astype(np.int64), own.last.astype(np.int64) + WINDOW
            yield _span_row(row["block"], first[whole], last[whole], own.rows[whole], offsets)
            of, start, stop = compared.left(row["surroundings"] or ())
            least = np.full(len(compared.wanted), len(data), np.int64)
            most = np.full(len(compared.wanted), -1, np.int64)
            np.minimum.at(least, of, start)
            np.maximum.at(most, of, stop)
            crowded = compared.code[compared.wanted] == CROWDED
            windows: dict[int, set[int]] = {}
            for n, a, b in zip(*(c[crowded[of]].tolist() for c in (of, start, stop)), strict=True):
                windows.setdefault(n, set()).update(range(a, b + 1))
            left = np.flatnonzero(most >= 0)
            numbers = compared.wanted[left]
            anchors = compared.first + compared.place - least
            anchors[compared.place == NO_ANCHOR] = -1
            columns = (
                left, least[left], most[left], anchors[left], own.keys[numbers].view(np.int64),
                own.rows[numbers], own.docs[numbers], offsets[own.rows[numbers]],
            )
            view, rows = memoryview(data), []
            for n, a, b, anchor, key, number, doc, offset in zip(*(c.tolist() for c in columns), strict=True):
                if n not in windows:
                    rows.append((key, number, a - offset, doc, anchor, bytes(view[a : b + WINDOW])))
                    continue
                for o in sorted(windows[n]):
                    window = bytes(view[o : o + WINDOW])
                    digest = hashlib.blake2b(window, digest_size=8).digest()
                    key = int.from_bytes(digest, "little", signed=True)
                    rows.append((key, number, o - offset, doc, -1, window))
            if rows:
                columns = list(zip(*rows, strict=True))
                fixed = [[row["block"]] * len(rows), [None] * len(rows)]
                yield pa.record_batch(
                    [pa.array(c, f.type) for c, f in zip([*fixed, *columns], _CUT, strict=True)],
                    schema=_CUT,
                )

    return cut


def _span_row(block: int, first, last, rows, offsets) -> pa.RecordBatch:
    """Overlapping contexts as (row, start, size) runs, in one row."""
    fresh = np.ones(len(first), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (first[1:] > last[:-1])
    heads = np.flatnonzero(fresh)
    ends = last[np.append(heads[1:], len(first)) - 1] if len(heads) else last
    runs = np.column_stack([rows[heads], first[heads] - offsets[rows[heads]], ends - first[heads]])
    columns = [[block], [runs.astype("<u4").tobytes()]] + [[None]] * 6
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _CUT, strict=True)], schema=_CUT)


def trim(contexts: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
    """Of each (anchor place, text) the part that another can share, as (from, to).

    Contexts of one anchor lie over each other at it.  What two share reaches
    from it as far left and right as they agree, so sorted neighbours bound the
    part for each side.  Where an anchor has several places in a context, nothing
    is cut off.
    """
    if any(anchor < 0 for anchor, _ in contexts):
        return [(0, len(text)) for _, text in contexts]
    left = _agreed([text[:anchor][::-1] for anchor, text in contexts])
    right = _agreed([text[anchor + GRAM :] for anchor, text in contexts])
    return [
        (anchor - before, anchor + GRAM + after)
        for (anchor, _), before, after in zip(contexts, left, right, strict=True)
    ]


def _agreed(sides: list[bytes]) -> list[int]:
    """For each string the longest prefix that another one has as well."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    longest = [0] * len(sides)
    for one, other in zip(order, order[1:], strict=False):
        a, b = sides[one], sides[other]
        size = min(len(a), len(b))
        differing = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
        same = size - (differing.bit_length() + 7) // 8
        longest[one] = max(longest[one], same)
        longest[other] = max(longest[other], same)
    return longest


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of windows that a smaller document has; rows come sorted by key."""
    texts: list[bytes] = []
    owners: list[int] = []  # the smallest document of each different text
    places: list[tuple[int, int, int, int, int]] = []  # with document and text number
    equal: list[tuple[int, int, int, int]] = []  # spans that need no sorting
    held = 0

    def finish() -> pa.RecordBatch:
        least = shared_windows(texts, owners, WINDOW)
        place = np.asarray(places, np.int64).reshape(-1, 5)
        sizes = np.asarray([len(t) - WINDOW + 1 for t in texts])
        heads = np.cumsum(sizes) - sizes
        counts = sizes[place[:, 4]]
        owner = np.repeat(np.arange(len(place)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        taken = np.flatnonzero(least[heads[place[owner, 4]] + inside] < place[owner, 3])
        fresh = np.ones(len(taken), bool)
        fresh[1:] = (np.diff(taken) > 1) | (np.diff(owner[taken]) > 0)
        starts = np.flatnonzero(fresh)
        runs = np.diff(np.append(starts, len(taken)))
        found = place[owner[taken[starts]]]
        columns = [
            found[:, 0],
            found[:, 1].astype(np.int32),
            (found[:, 2] + inside[taken[starts]]).astype(np.int32),
            (runs + WINDOW - 1).astype(np.int32),
        ]
        texts.clear(), owners.clear(), places.clear()
        return runs_of(columns)

    def runs_of(columns: Iterable) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "row", "start", "size"]
        )

    def take(group: list[dict]) -> int:
        added = 0
        numbers: dict[bytes, int] = {}
        spans = trim([(g["anchor"], g["text"]) for g in group])
        parts = [
            (g, low, g["text"][low:high])
            for g, (low, high) in zip(group, spans, strict=True)
            if high - low >= WINDOW
        ]
        if len({text for _, _, text in parts}) == 1:  # what is left of the contexts is equal as a whole
            least = min(g["doc"] for g, _, _ in parts)
            equal.extend(
                (g["block"], g["row"], g["start"] + low, len(text)) for g, low, text in parts if g["doc"] > least
            )
            return 0
        for g, low, text in parts:
            number = numbers.get(text)
            if number is None:
                number = numbers[text] = len(texts)
                texts.append(text)
                owners.append(g["doc"])
                added += len(text)
            else:
                owners[number] = min(owners[number], g["doc"])
            places.append((g["block"], g["row"], g["start"] + low, g["doc"], number))
        return added

    group: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and group[0]["key"] != row["key"]:
                held += take(group)
                group = []
                if held >= BATCH_BYTES:
                    yield finish()
                    held = 0
                if len(equal) >= BATCH_SPANS:
                    yield runs_of(zip(*equal, strict=True))
                    equal.clear()
            group.append(row)
    if group:
        take(group)
    if texts:
        yield finish()
    if equal:
        yield runs_of(zip(*equal, strict=True))


# -- cutting out -------------------------------------------------------------------


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (from, to) of (start, size) spans."""
    out: list[list[int]] = []
    for start, size in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + size)
        else:
            out.append([start, start + size])
    return [tuple(r) for r in out]


def _kept(schema: list[str]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                view = memoryview(batch.column("data")[at].as_buffer())
                others = pa.ipc.open_stream(batch.column("others")[at].as_buffer()).read_all()
                spans: dict[int, list[tuple[int, int]]] = {}
                whole = np.frombuffer(batch.column("whole")[at].as_py() or b"", "<u4")
                for row, start, size in whole.reshape(-1, 3).tolist():
                    spans.setdefault(row, []).append((start, size))
                for s in batch.column("spans")[at].as_py() or ():
                    spans.setdefault(s["row"], []).append((s["start"], s["size"]))
                offset = 0
                texts, sizes, removed, runs, digests = [], [], [], [], []
                for row, size in enumerate(batch.column("sizes")[at].as_py()):
                    own = view[offset : offset + size]
                    offset += size
                    gone = covered(spans.get(row, []))
                    place, pieces = 0, []
                    for start, stop in gone:
                        pieces.append(own[place:start])
                        place = stop
                    kept = b"".join([*pieces, own[place:]])
                    texts.append(kept.decode("utf-8", "ignore"))
                    sizes.append(size)
                    removed.append(size - len(kept))
                    runs.append(len(gone))
                    digests.append(hashlib.sha256(kept).hexdigest())
                made = {
                    "text": pa.array(texts, pa.string()),
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(runs, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                }
                columns = [made[n] if n in made else others.column(n) for n in schema]
                yield from pa.table(columns, names=schema).to_batches()

    return cut


MADE = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with what is left of ``text``, and the columns of ``MADE``.

    Columns of the documents that are named like those of ``MADE`` are replaced.
    """
    spark = docs.sparkSession
    given = docs.select(*[c for c in docs.columns if c not in MADE])
    name = f"text_blocks_{uuid.uuid4().hex}"
    fresh = _blocks(given.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")))
    fresh.write.option("compression", "zstd").bucketBy(parts(docs), "block").saveAsTable(name)
    blocks = spark.table(name)
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    # an anchor for about every (WINDOW - GRAM + 2) / 2 bytes, four bytes each
    buckets = max(parts(docs), math.ceil(total * 8 / (WINDOW - GRAM + 2) / BUCKET_BYTES))
    with passing(spark):  # the cut has all that is asked later
        texts = blocks.select("block", "docs", "sizes", "data")
        answers = _answers(texts.mapInArrow(_anchors(buckets), ASKED), "answers")
        contexts = stage(texts.join(answers, "block").mapInArrow(_contexts(buckets), CONTEXTS), "contexts")
        numbered = contexts.join(blocks.select("block", "docs"), "block")
        codes = answered(numbered.mapInArrow(_sends(buckets), SENT), SENT_KINDS, _judge_contexts, "codes")
        known = texts.join(contexts, "block").join(codes.select("block", "codes"), "block")
        surroundings = _answers(known.mapInArrow(_surroundings(buckets), ASKED), "surroundings")
        cut = stage(
            known.join(surroundings, "block", "left").mapInArrow(_cut(buckets), CUT), "cut", keep=True
        )
    partial = stage(
        cut.filter("spans is null")
        .drop("spans")
        .repartition(parts(docs), "key")
        .sortWithinPartitions("key")
        .mapInArrow(_sorted_windows, SPAN)
        .groupBy("block")
        .agg(F.collect_list(F.struct("row", "start", "size")).alias("spans")),
        "spans",
    )
    whole = cut.filter("spans is not null").select("block", F.col("spans").alias("whole"))
    fields = [f for f in given.schema.fields if f.name not in ("text", "doc_id")]
    kinds_of = {f.name: f.dataType.simpleString() for f in fields} | {
        "doc_id": "long", "text": "string", "n_bytes": "long", "n_removed": "long",
        "n_spans": "long", "kept_sha256": "string",
    }
    names = [*given.columns, *MADE]
    return (
        blocks.join(whole, "block", "left")
        .join(partial, "block", "left")
        .select("block", "sizes", "data", "others", "whole", "spans")
        .mapInArrow(_kept(names), ", ".join(f"`{n}` {kinds_of[n]}" for n in names))
    )
