"""Listing of every file below a folder: hidden names and links too.

Spark's file sources leave out names that start with ``.`` or ``_`` and follow links without telling. This one is a Python data source whose
partitions are folders: the driver looks at folders only until there are enough of them to deal out, each task lists its own. A folder may
hold very many others, so when there are too many for a task each they are dealt out in groups.
No file is opened. Executors have to see the folder under the same path; stores other than local folders
are listed through ``pyarrow.fs``, which knows no links.
"""

from __future__ import annotations

import os
import sys
from collections import deque
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from exposcan.functions.ids import base_name, file_ext

# The source goes to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Folders the driver lists at most before it deals out what it has found, and tasks they are dealt to.
FOLDERS = 1_000
GROUPS = 100
NAME = "exposcan_listing"


class Folder(InputPartition):
    def __init__(self, path: str, below: bool):
        super().__init__((path, below))
        self.path, self.below = path, below  # below: with all folders below it


class Folders(InputPartition):
    """Several of them for one task."""

    def __init__(self, folders: list[Folder]):
        super().__init__(tuple(f.value for f in folders))
        self.folders = folders


def _entries(folder: str) -> tuple[list[tuple[str, int, bool]], list[str]]:
    """(path, size, is_link) of the files of a folder and the folders in it. A folder that has gone meanwhile is empty."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        prefix = folder[: len(folder) - len(root.lstrip("/"))] if folder.endswith(root.lstrip("/")) else f"{url.scheme}://{url.netloc}/"
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        files = [(prefix + e.path.lstrip("/"), e.size or 0, False) for e in found if e.type != fs.FileType.Directory]
        return files, [prefix + e.path.lstrip("/") for e in found if e.type == fs.FileType.Directory]
    files, folders = [], []
    try:
        with os.scandir(url.path) as entries:
            for entry in entries:
                if entry.is_dir(follow_symlinks=False):
                    folders.append(entry.path)
                elif not entry.is_dir():  # a link to a folder is neither walked nor a file
                    files.append((entry.path, entry.stat(follow_symlinks=False).st_size, entry.is_symlink()))
    except FileNotFoundError:
        pass
    return files, folders


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "path string, size bigint, is_link boolean"

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["path"], int(self.options.get("folders", FOLDERS)))


class ListingReader(DataSourceReader):
    def __init__(self, root: str, folders: int):
        self.root, self.folders = root, folders

    def partitions(self) -> list[InputPartition]:
        """Folders whose own files a task lists, and those it walks with all below them; in groups if there are more than wanted."""
        listed, waiting = [], deque([self.root])
        while waiting and len(listed) + len(waiting) < self.folders:
            folder = waiting.popleft()
            listed.append(folder)
            waiting.extend(sorted(_entries(folder)[1]))
        dealt = [Folder(f, False) for f in listed] + [Folder(f, True) for f in waiting]
        return dealt if len(dealt) <= self.folders else [Folders(dealt[n::GROUPS]) for n in range(min(GROUPS, len(dealt)))]

    def read(self, partition: Folder | Folders) -> Iterator[tuple[str, int, bool]]:
        for folder in partition.folders if isinstance(partition, Folders) else [partition]:
            yield from self._walk(folder)

    def _walk(self, partition: Folder) -> Iterator[tuple[str, int, bool]]:
        waiting = deque([partition.path])
        while waiting:
            files, folders = _entries(waiting.popleft())
            yield from files
            if partition.below:
                waiting.extend(folders)


def list_all_files(spark: SparkSession, directory: str, folders: int = FOLDERS) -> DataFrame:
    """``path, name, ext, size, is_link`` of every file below ``directory``. The size of a link is its own."""
    spark.dataSource.register(Listing)
    listed = spark.read.format(NAME).option("folders", folders).load(directory)
    path = F.col("path")
    return listed.select("path", base_name(path).alias("name"), file_ext(path).alias("ext"), "size", "is_link")
