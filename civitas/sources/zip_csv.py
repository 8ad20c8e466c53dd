"""Headerless delimited files read straight out of ZIP archives.

A compressed member can only be inflated from its start, so one task reads one
member; it only cuts the text into blocks of whole records, and a Python data
source hands these on in Arrow batches.  Cells are parsed by ``from_csv`` in the
JVM, over as many tasks as the blocks are spread to.  Nothing is extracted to disk
and no member held in memory.  Archives are opened through ``pyarrow.fs``, so
local folders and object stores both work.
"""

from __future__ import annotations

import csv
import io
import json
import sys
import zipfile
import zlib
from collections.abc import Iterator
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "zip_csv"
BLOCK_CHARS = 1 << 20
CSV_ROWS = 200
BLOCK = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_member", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("records", T.ArrayType(T.StringType())),
    ]
)
PROVENANCE = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_member", T.StringType()),
        T.StructField("_line", T.LongType()),
        T.StructField("_fields", T.IntegerType()),
    ]
)


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_archives(path_glob: str) -> list[str]:
    """Files of one folder matching the last part of ``path_glob``, sorted."""
    folder, _, pattern = path_glob.rpartition("/")
    system, base = _open_fs(folder)
    found = system.get_file_info(fs.FileSelector(base))
    prefix = folder[: len(folder) - len(base)]
    return sorted(
        prefix + info.path
        for info in found
        if info.type == fs.FileType.File and fnmatch(info.base_name.lower(), pattern.lower())
    )


class Member(InputPartition):
    def __init__(self, archive: str, member: str):
        super().__init__((archive, member))
        self.archive, self.member = archive, member


class ZipCsvReader(DataSourceReader):
    """Blocks of whole records; their cells are parsed later, by other tasks.

    A block starts outside quotes.  Where each quote opens or closes a cell, the
    parity of the quotes before a line break tells whether it ends a record, so
    borders come from a scan of bytes.  Records with quotes elsewhere (``5" x``)
    are read by the csv module and written again with all their cells quoted.
    """

    def __init__(self, schema: T.StructType, options: dict):
        self.archives = json.loads(options["archives"])
        self.sep = options.get("sep", ";")
        self.encoding = options.get("encoding", "latin1")
        self.on_error = options.get("on_error", "fail")
        self.block_chars = int(options.get("block_chars", BLOCK_CHARS))

    def partitions(self) -> list[Member]:
        members = []
        for archive in self.archives:
            system, path = _open_fs(archive)
            with system.open_input_file(path) as handle, zipfile.ZipFile(handle) as archive_file:
                members += [
                    Member(archive, info.filename)
                    for info in archive_file.infolist()
                    if not info.is_dir()
                ]
        return members

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        name = partition.archive.rsplit("/", 1)[-1]
        first = 1
        try:
            for records in self._blocks(partition):
                yield self._batch(name, partition.member, first, records)
                first += len(records)
        except (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, csv.Error):
            if self.on_error != "quarantine":
                raise
            # a record that is NULL marks the file
            yield self._batch(name, partition.member, first, pa.array([None], pa.string()))

    def _blocks(self, partition: Member) -> Iterator[pa.Array]:
        """Records in the order of the file."""
        system, path = _open_fs(partition.archive)
        with (
            system.open_input_file(path) as handle,
            zipfile.ZipFile(handle) as archive_file,
            archive_file.open(partition.member) as raw,
        ):
            text = io.TextIOWrapper(raw, encoding=self.encoding)
            data, ended = b"", False
            while not ended or data:
                if not ended and len(data) < self.block_chars:
                    chunk = text.read(self.block_chars)
                    ended = not chunk
                    data += chunk.encode()
                ends = record_ends(data, self.sep, ended)
                if len(ends):
                    yield _text_records(data, ends)
                    data = data[ends[-1] :]
                elif data:
                    rows, data = self._through_csv(data, text)
                    yield pa.array(rows, pa.string())

    def _through_csv(self, data: bytes, text: io.TextIOWrapper) -> tuple[list[str], bytes]:
        """Up to ``CSV_ROWS`` records from the start of ``data``, all cells quoted,
        and what is left.

        The csv module asks for a line at a time, so once it has given a record
        everything it was not handed still lies ahead.
        """
        at = 0

        def lines() -> Iterator[str]:
            nonlocal at
            while at < len(data):
                end = data.find(b"\n", at) + 1 or len(data)
                line, at = data[at:end], end
                # the last line of the data may go on in the file
                more = b"" if line.endswith(b"\n") else text.readline().encode()
                yield (line + more).decode()
            while line := text.readline():
                yield line

        rows = []
        for row in csv.reader(lines(), delimiter=self.sep):
            rows.append(self.sep.join('"' + cell.replace('"', '""') + '"' for cell in row))
            if len(rows) == CSV_ROWS or at >= len(data):
                break
        return rows, data[at:]

    def _batch(self, archive, member, first, records) -> pa.RecordBatch:
        arrays = [
            pa.array([archive], pa.string()),
            pa.array([member], pa.string()),
            pa.array([first], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=BLOCK.fieldNames())


def record_ends(data: bytes, sep: str, ended: bool) -> np.ndarray:
    """Where the records at the start of ``data`` end, up to the first record with
    a quote that neither opens nor closes a cell; ``ended``: nothing follows."""
    codes = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(codes == ord('"'))
    breaks = np.flatnonzero(codes == ord("\n"))
    ends = breaks[np.searchsorted(quotes, breaks) % 2 == 0] + 1
    if ended and len(data) and (not len(ends) or ends[-1] < len(data)) and len(quotes) % 2 == 0:
        ends = np.append(ends, len(data))
    beside = np.zeros(256, bool)
    beside[[ord(sep), ord("\n"), ord('"')]] = True
    around = np.concatenate([[ord("\n")], codes, [ord("\n")]]).astype(np.uint8)
    opening = np.arange(len(quotes)) % 2 == 0
    # in ``around`` the byte before position q lies at q, the one after it at q + 2
    wrong = quotes[~beside[around[np.where(opening, quotes, quotes + 2)]]]
    return ends[ends <= wrong[0]] if len(wrong) else ends


def _text_records(data: bytes, ends: np.ndarray) -> pa.Array:
    """Each record with the line break after it; the bytes are not copied."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data))


class ZipCsvSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return BLOCK

    def reader(self, schema: T.StructType) -> ZipCsvReader:
        return ZipCsvReader(schema, self.options)


def read_zip_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    sep: str = ";",
    encoding: str = "latin1",
    spread: int | None = None,
    on_error: str = "fail",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """All rows of all members as text, with file, member, line and field count.

    ``paths`` is a glob over one folder or a list of archives.
    ``spread`` deals the blocks of records out to that many tasks, which parse
    them; without it the rows of a member are parsed where it is inflated.
    ``_line`` counts records.  A short row is NULL at its end, ``_fields`` tells.
    A damaged member fails the load; with ``on_error='quarantine'`` it ends in a
    row without values instead, which the quarantine turns into a parked file.
    """
    if len(sep) != 1 or not sep.isascii():
        raise ValueError("sep must be one ASCII character")
    # Travels with the job, so executors need not have this package installed.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ZipCsvSource)
    archives = list_archives(paths) if isinstance(paths, str) else list(paths)
    blocks = (
        spark.read.format(FORMAT)
        .schema(BLOCK)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("on_error", on_error)
        .option("block_chars", block_chars)
        .option("archives", json.dumps(archives))
        .load()
    )
    if spread:
        blocks = blocks.repartition(spread)
    return _parsed(blocks, schema.fieldNames(), sep)


def _parsed(blocks: DataFrame, names: list[str], sep: str) -> DataFrame:
    """One row per record of the blocks."""
    records = blocks.select(
        "_source_file", "_member", "first", F.posexplode("records").alias("pos", "record")
    ).select(
        "_source_file",
        "_member",
        (F.col("first") + F.col("pos")).alias("_line"),
        F.rtrim("record", F.lit("\n")).alias("record"),
    )
    layout = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = records.select(
        "*",
        F.from_csv("record", layout, {"sep": sep, "quote": '"', "escape": '"'}).alias("cells"),
        F.coalesce(_field_count(F.col("record"), sep), F.lit(-1)).alias("_fields"),
    )
    # unquoted empty cells are NULL to from_csv, like those that are not there
    values = [
        F.coalesce(f"cells.c{i}", F.when(F.col("_fields") > i, "")).alias(name)
        for i, name in enumerate(names)
    ]
    return parsed.select(*values, *PROVENANCE.fieldNames())


def _field_count(record: Column, sep: str) -> Column:
    """Separators outside quotes, and one; 0 for a blank line."""
    outside = F.regexp_replace(record, '"[^"]*+"', "")
    seps = F.length(outside) - F.length(F.replace(outside, F.lit(sep)))
    return F.when(record == "", 0).otherwise(seps + 1).cast("int")
