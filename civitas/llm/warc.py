"""WARC archives compressed record by record with Zstandard and a dictionary.

An archive begins with a skippable frame that holds the dictionary (itself
perhaps compressed); every record after it is one frame of its own.  Writing
runs inside tasks: each rolls a new archive after ``archive_mb`` of payload,
trains its dictionary on the first records, and reports the archive in a
manifest, so files of failed attempts are never read.  Archives are read whole
through Spark's binary file source, frame by frame; headers, lengths and
digests of every record are checked and a violation fails the task.

Of records with equal payloads of at least ``least`` bytes the one with the
largest ``page_id`` is stored, the others are revisits that refer to it.

Defined results: null html is an empty payload; null urls become
``about:blank``; control characters of a url are percent-encoded; rows that
repeat the largest ``page_id`` of a payload are all stored; a null ``page_id``
stays null and is referred to by none unless no other has the payload, in which
case ``refers_to`` is null too and all are stored; empty tables give no
archives and no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 1000
ARCHIVE_MB = 32
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 2_000_000
DICTIONARY_BYTES = 16_384
LEVEL = 3
SLICE = 1 << 16
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

MANIFEST = "archive string, records long, payload_bytes long"
RECORD = (
    "archive string, page_id long, url string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)
_RECORD = pa.schema(
    [
        ("archive", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def _plain(url: str | None) -> str:
    if not url:
        return "about:blank"
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def record_bytes(page_id, url, digest: str, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One uncompressed record; a revisit keeps the HTTP headers only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    encoded = base64.b32encode(bytes.fromhex(digest)).decode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _plain(url)),
        ("WARC-Payload-Digest", f"sha1:{encoded}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        headers.append(("Page-Number", str(page_id)))
    if revisit:
        headers.append(("WARC-Profile", PROFILE))
        headers.append(("WARC-Refers-To", _record_id(refers_to)))
        headers.append(("Refers-To-Page-Number", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one decoded record; raises ValueError if malformed."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header line {line!r}")
        headers[name] = value.strip()
    for name in REQUIRED:
        if name not in headers:
            raise ValueError(f"record without {name}")
    if not headers["Content-Length"].isdigit():
        raise ValueError("Content-Length is not a number")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("record length differs from Content-Length")
    return headers, rest[:length]


def _dictionary(samples: list[bytes]):
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few samples to train on
        return None


class ArchiveWriter:
    """Writes a dictionary frame, if one can be trained, and a frame per record."""

    def __init__(self, out):
        self.out, self.waiting, self.held = out, [], 0
        self.compressor = None

    def add(self, record: bytes) -> None:
        if self.compressor is None:
            self.waiting.append(record)
            self.held += len(record)
            if len(self.waiting) >= SAMPLE_RECORDS or self.held >= SAMPLE_BYTES:
                self._start()
        else:
            self.out.write(self.compressor.compress(record))

    def _start(self) -> None:
        import zstandard

        dictionary = _dictionary(self.waiting)
        if dictionary is None:
            self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        else:
            raw = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
            self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for record in self.waiting:
            self.out.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.out.close()


def records_of(content: bytes) -> Iterator[bytes]:
    """The decoded records of one archive, a frame each."""
    import zstandard

    view, at, dictionary = memoryview(content), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", view, 4)[0]
        if len(view) < 8 + size:
            raise ValueError("dictionary frame is cut off")
        raw = bytes(view[8 : 8 + size])
        if raw[:4] == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
        at = 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        if bytes(view[at : at + 4]) != FRAME_MAGIC:
            raise ValueError("no Zstandard frame where a record must begin")
        frame, decoded = reader.decompressobj(), []
        while not frame.eof:
            part = view[at : at + SLICE]
            if not part:
                raise ValueError("last frame is cut off")
            decoded.append(frame.decompress(part))
            at += len(part)
        at -= len(frame.unused_data)
        yield b"".join(decoded)


def with_originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages as payloads with ``digest`` and ``refers_to`` (null: stored itself)."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    shared = (
        rows.filter(F.octet_length("payload") >= least)
        .groupBy(F.col("digest").alias("same"))
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("original"))
        .filter("copies > 1")
    )
    known = (F.col("digest") == F.col("same")) & (F.octet_length("payload") >= least)
    other = ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(shared, known, "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("original")).alias("refers_to")
    )


def write_archives(rows: DataFrame, folder: str, archive_mb: float = ARCHIVE_MB) -> DataFrame:
    """Write rows of :func:`with_originals`; a lazy manifest of the archives."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        done: list[tuple[str, int, int]] = []
        writer = None
        name, records, size = "", 0, 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns, strict=True):
                if writer is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    writer = ArchiveWriter(out)
                payload, original = payload.as_py(), refers_to.as_py()
                writer.add(
                    record_bytes(
                        page_id.as_py(), url.as_py(), digest.as_py(), payload,
                        original, original is not None,
                    )
                )
                records, size = records + 1, size + len(payload)
                if size >= archive_mb * 1e6:
                    writer.close()
                    done.append((name, records, size))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((name, records, size))
        columns = list(zip(*done, strict=True)) or [()] * 3
        yield pa.record_batch(
            [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["archive", "records", "payload_bytes"],
        )

    return rows.mapInArrow(write, MANIFEST)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The checked records of all archives of a folder (columns of ``RECORD``)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                name, rows, held = path.as_py().rsplit("/", 1)[-1], [], 0
                for data in records_of(content.as_buffer()):
                    rows.append((name, *_checked(*parse_record(data))))
                    held += len(data)
                    if held > SAMPLE_BYTES:
                        yield _record_batch(rows)
                        rows, held = [], 0
                yield _record_batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(decode, RECORD)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_RECORD)
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(columns, _RECORD, strict=True)], schema=_RECORD
    )


def _checked(headers: dict[str, str], block: bytes) -> tuple:
    """The fields of a record; raises ValueError when block and headers disagree."""
    kind = headers["WARC-Type"]
    head, found, payload = block.partition(b"\r\n\r\n")
    size = [v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")) if k == "Content-Length"]
    if kind not in ("response", "revisit") or not found or len(size) != 1:
        raise ValueError(f"unexpected {kind} record")
    algorithm, _, encoded = headers["WARC-Payload-Digest"].partition(":")
    digest = base64.b32decode(encoded).hex()
    page, original = headers.get("Page-Number"), headers.get("Refers-To-Page-Number")
    if kind == "response":
        if int(size[0]) != len(payload):
            raise ValueError("payload length differs from its HTTP header")
        if algorithm != "sha1" or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("payload digest differs")
    elif payload or headers.get("WARC-Refers-To") != _record_id(original):
        raise ValueError("revisit record with a payload or without its original")
    return (
        None if page is None else int(page),
        headers.get("WARC-Target-URI"),
        kind,
        None if original is None else int(original),
        digest,
        int(size[0]),
        payload,
    )
