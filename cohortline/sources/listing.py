"""File listing as a data source: directories are listed in tasks, not in the driver.

The built-in file readers list every file in the driver before a task starts. Here the driver lists directories only down to a
level with enough of them, a number that does not follow the number of files, and each task lists what lies
below its directories. Equality and prefix tests on ``path``, ``name`` and ``extension``, and those on the ``project`` taken from the
first directory below the root, are pushed into the listing, so that whole directories are left out.

The storage is reached with ``pyarrow.fs``: local paths and the stores it knows by address (``s3://``, ``gs://``, ``hdfs://``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringEndsWith,
)

NAME = "file_listing"
SCHEMA = "path string, name string, extension string, project string, length bigint, modified timestamp"
#: Directories that are dealt to tasks, at least if there are as many, and the most that the driver holds.
LEAST_DIRECTORIES = 64
MOST_DIRECTORIES = 100_000
ROWS = 4096


def _extension(name: str) -> str:
    """From the last point on, in lower case; empty without one."""
    return name[name.rfind(".") :].lower() if "." in name else ""


class Prefixes(InputPartition):
    """Directories of one task: all below them, or only the files in them."""

    def __init__(self, directories: list[tuple[str, bool]]):
        super().__init__(0)
        self.directories = directories


class ListingReader(DataSourceReader):
    def __init__(self, root: str, tasks: int):
        self.root, self.tasks = root, tasks
        self.equal: dict[str, set[str]] = {}
        self.endings: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take what a directory listing can decide; the rest stays with Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, EqualTo) and column in ("project", "extension", "name") and isinstance(f.value, str):
                self._also(column, {f.value})
            elif isinstance(f, In) and column in ("project", "extension", "name"):
                self._also(column, {v for v in f.value if v is not None})
            elif isinstance(f, StringEndsWith) and column in ("path", "name"):
                self.endings.append((column, f.value))
            else:
                yield f

    def _also(self, column: str, values: set[str]) -> None:
        self.equal[column] = self.equal.get(column, values) & values

    def _store(self):
        from pyarrow import fs

        if "://" in self.root:
            return fs.FileSystem.from_uri(self.root)
        store, path = fs.LocalFileSystem(), self.root.removeprefix("file:")
        return store, path

    def _wanted(self, project: str) -> bool:
        return "project" not in self.equal or project in self.equal["project"]

    def partitions(self) -> list[Prefixes]:
        """Directories, level by level, until there are enough to deal; files above them stay with their directory."""
        from pyarrow import fs

        store, top = self._store()
        top = top.rstrip("/")
        done: list[tuple[str, bool]] = []
        level = [top]
        depth = 0
        while level and len(level) < LEAST_DIRECTORIES:
            deeper = []
            for directory in level:
                done.append((directory, False))
                found = [i.path for i in store.get_file_info(fs.FileSelector(directory)) if i.type == fs.FileType.Directory]
                deeper += [d for d in found if depth or self._wanted(d.rpartition("/")[2])]
                if len(deeper) > MOST_DIRECTORIES:
                    # Too wide for the driver: these stay whole with their parents.
                    done = [x for x in done if x[0] not in set(level)]
                    deeper = []
                    done += [(d, True) for d in level]
                    break
            level, depth = deeper, depth + 1
        done += [(d, True) for d in level]
        # Sorted by their digest, large neighbours fall into different tasks.
        import hashlib

        done.sort(key=lambda d: hashlib.md5(d[0].encode()).hexdigest())
        return [Prefixes(done[i :: self.tasks]) for i in range(min(self.tasks, len(done)))]

    def read(self, partition: Prefixes) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        store, top = self._store()
        top = top.rstrip("/")
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = [pa.string()] * 4 + [pa.int64(), pa.timestamp("us", tz="UTC")]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        waiting = list(partition.directories)
        while waiting:
            directory, below = waiting.pop()
            for info in store.get_file_info(fs.FileSelector(directory)):
                inside = info.path[len(top) + 1 :]
                project = inside.split("/", 1)[0] if "/" in inside else ""
                if info.type == fs.FileType.Directory:
                    if below and self._wanted(project or inside):
                        waiting.append((info.path, True))
                    continue
                row = {"path": info.path, "name": info.base_name, "extension": _extension(info.base_name), "project": project}
                if any(row[c] not in values for c, values in self.equal.items()):
                    continue
                if any(not row[c].endswith(end) for c, end in self.endings):
                    continue
                rows.append((*row.values(), info.size, info.mtime))
                if len(rows) >= ROWS:
                    yield batch()
                    rows = []
        if rows:
            yield batch()


class FileListing(DataSource):
    """``spark.read.format('file_listing').load(root)``; option ``tasks`` is the number of listing tasks."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        if "path" not in self.options:
            raise ValueError("load() needs the folder to list")
        return ListingReader(self.options["path"], int(self.options.get("tasks", "64")))


def list_files(spark: SparkSession, root: str, ext: str | None = None, tasks: int = 64) -> DataFrame:
    """All files below a folder: path, name, extension, project (first directory), length, modified.

    ``ext``, such as ``.dcm``, and later tests on ``project`` or ``extension`` reach the listing itself.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FileListing)
    files = spark.read.format(NAME).option("tasks", str(tasks)).load(root)
    return files if ext is None else files.where(F.col("extension") == ext.lower())
