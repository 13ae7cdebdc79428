"""The landing zone as a Python data source: its files, listed without reading any.

``spark.read.format("landing").load(folder)`` gives a row per file: ``file``, ``object``, ``file_date``,
``length`` and ``modified`` (microseconds). Files without content are listed too. Planning lists the
landing folder itself, one entry per object; what lies inside an object is listed by the tasks. Filters on
``object`` and ``file_date`` (equality, membership, bounds) are pushed down to the names, so a day's
filter plans the partition of that day's object alone.

The folder may be on any file system that Arrow opens (local or mounted, HDFS, object stores).
"""

from __future__ import annotations

import datetime
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    LessThan, LessThanOrEqual)

from candleworks.session import share_package

SCHEMA = "file string, object string, file_date date, length bigint, modified bigint"
#: Objects that a task lists.
OBJECTS_A_TASK = 64
_FOLDER = "object="
_COMPARE = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}


def file_system(folder: str):
    """The file system of a folder and the folder's path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder) if ":" in folder else f"file://{folder}")


def object_day(name: str) -> datetime.date | None:
    """The date at characters 6 to 15 of an object's name."""
    try:
        return datetime.date.fromisoformat(name[5:15])
    except ValueError:
        return None


@dataclass
class Objects(InputPartition):
    """Folders (or single files) of some objects."""

    names: list[str]

    def __init__(self, names: list[str]) -> None:
        super().__init__(None)
        self.names = names


class LandingReader(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.filters: list[tuple[str, object, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ())
            if column not in (("object",), ("file_date",)):
                yield f
            elif isinstance(f, In):
                self.filters.append((column[0], lambda x, values: x in values, f.value))
            elif type(f) in _COMPARE:
                self.filters.append((column[0], _COMPARE[type(f)], f.value))
            else:
                yield f

    def _wanted(self, name: str) -> bool:
        of = {"object": name, "file_date": object_day(name)}
        return all(of[column] is not None and compare(of[column], value) for column, compare, value in self.filters)

    def partitions(self) -> list[Objects]:
        from pyarrow import fs

        system, root = file_system(self.folder)
        entries = system.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True))
        names = sorted(e.base_name for e in entries if not e.base_name.startswith(("_", ".")))
        names = [n for n in names if self._wanted(n.removeprefix(_FOLDER))]
        return [Objects(names[a:a + OBJECTS_A_TASK]) for a in range(0, len(names), OBJECTS_A_TASK)] or [Objects([])]

    def read(self, partition: Objects) -> Iterator[tuple]:
        from pyarrow import fs

        system, root = file_system(self.folder)
        scheme = self.folder.split(":", 1)[0] + ":" if ":" in self.folder else "file:"
        for name in partition.names:
            entry = system.get_file_info(f"{root}/{name}")
            found = [entry] if entry.is_file else system.get_file_info(fs.FileSelector(entry.path, recursive=True))
            plain = name.removeprefix(_FOLDER)
            for f in found:
                if f.is_file and not f.base_name.startswith(("_", ".")):
                    yield (scheme + f.path if scheme == "file:" else f"{self.folder.rstrip('/')}{f.path.removeprefix(root.rstrip('/'))}",
                           plain, object_day(plain), f.size, f.mtime_ns // 1000 if f.mtime_ns is not None else None)


class LandingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandingReader:
        return LandingReader(self.options["path"])


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a landing folder."""
    share_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandingSource)
    return spark.read.format("landing").load(folder)
