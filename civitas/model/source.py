"""Where a job reads its tables from.

Every plan asks for a table by name together with the columns it needs, so the
same view runs over Parquet folders, catalog tables or in-memory frames and the
scan never carries a column the view does not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class TableSource:
    """Base: resolve a table name to a DataFrame."""

    def load(self, name: str, columns: tuple[str, ...] | None) -> DataFrame:
        raise NotImplementedError

    def has(self, name: str) -> bool:
        raise NotImplementedError

    def table(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        wanted = tuple(columns) if columns else None
        frame = self.load(name, wanted)
        return frame.select(*wanted) if wanted else frame


class PathSource(TableSource):
    """``<root>/<table>`` Parquet folders."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def load(self, name, columns):
        return self.spark.read.parquet(self.path(name))

    def has(self, name):
        try:
            self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise  # there, but unreadable
        return True


class CatalogSource(TableSource):
    """Tables of one catalog database, i.e. one data generation."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def load(self, name, columns):
        return self.spark.table(f"{self.database}.{name}")

    def has(self, name):
        return self.spark.catalog.tableExists(f"{self.database}.{name}")


class FrameSource(TableSource):
    """DataFrames already at hand, or functions that build one on demand."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self.frames = dict(frames)

    def load(self, name, columns):
        found = self.frames[name]
        return found if isinstance(found, DataFrame) else found()

    def has(self, name):
        return name in self.frames


class OverlaySource(TableSource):
    """Tables of ``top`` where it has them, else those of ``base``.

    Lets a dependent view read the already written series instead of
    recomputing it.
    """

    def __init__(self, base: TableSource, top: TableSource):
        self.base, self.top = base, top

    def load(self, name, columns):
        chosen = self.top if self.top.has(name) else self.base
        return chosen.load(name, columns)

    def has(self, name):
        return self.top.has(name) or self.base.has(name)
