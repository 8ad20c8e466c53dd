"""Tables in numbered versions, each of which one writer alone can claim.

A writer stores its rows in a folder of its own, then puts a version file that
names the folder, where no such file is yet.  Putting is one step that fails
when the file exists: a hard link on a local disk, a rename on HDFS, a
conditional create elsewhere.  Of two writers one loses, reads what the other
made and tries the next number.  Readers take the highest version file; it
appears with its content, after the rows, so a writer that dies leaves a folder
nobody reads, and there is no moment without a table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"versao-(\d{10})")
#: Losing so often in a row means something else is wrong.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another writer was first every time."""


class Versions:
    """The versions of one table under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._path(self.folder)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def latest(self) -> tuple[int, str] | None:
        """Number and folder of the version in force."""
        if not self._fs.exists(self._root):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        numbers = [int(m[1]) for n in names if (m := _VERSION.fullmatch(n))]
        if not numbers:
            return None
        return max(numbers), f"{self.folder}/{self._content(max(numbers))}"

    def read(self) -> DataFrame | None:
        found = self.latest()
        return None if found is None else self.spark.read.parquet(found[1])

    def put(
        self,
        change: Callable[[DataFrame | None], DataFrame],
        check: Callable[[DataFrame], None] | None = None,
    ) -> int:
        """Write ``change(version in force)`` as the next version.

        ``change`` runs again on what is then in force when another writer was
        first; the number of the version written is returned.  ``check`` sees the
        stored rows and raises to leave the version in force as it is.
        """
        for _ in range(ATTEMPTS):
            found = self.latest()
            number = 0 if found is None else found[0] + 1
            name = f"dados-{uuid.uuid4().hex}"
            frame = change(None if found is None else self.spark.read.parquet(found[1]))
            frame.write.parquet(f"{self.folder}/{name}")
            if check is not None:
                check(self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}"))
            if self.claim(number, name):
                return number
        raise Conflict(f"{self.folder}: {ATTEMPTS} versions were taken by others")

    def _file(self, number: int) -> str:
        return f"{self.folder}/versao-{number:010d}"

    def _content(self, number: int) -> str:
        stream = self._fs.open(self._path(self._file(number)))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def _write(self, path, text: str) -> None:
        stream = self._fs.create(path, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def claim(self, number: int, name: str) -> bool:
        """Put the version file unless it exists; whether this writer did."""
        target, scheme = self._path(self._file(number)), self._fs.getScheme()
        if scheme not in ("file", "hdfs", "viewfs"):
            try:
                self._write(target, name)
            except Exception as failure:
                if self._fs.exists(target) and self._content(number) != name:
                    return False
                raise failure
            return True
        fresh = self._path(f"{self.folder}/_novo-{uuid.uuid4().hex}")
        self._write(fresh, name)
        try:
            if scheme != "file":
                return bool(self._fs.rename(fresh, target))
            # a local rename would replace what is there
            nio = self._jvm.java.nio.file
            local = [nio.Paths.get(self._fs.makeQualified(p).toUri()) for p in (target, fresh)]
            try:
                nio.Files.createLink(*local)
            except Exception:
                if self._fs.exists(target):
                    return False
                raise
            return True
        finally:
            self._fs.delete(fresh, False)
