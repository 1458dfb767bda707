"""Listings of stores whose folders are opened in tasks, so that no listing lies in the driver.

Each level of folders is one step: files pass, folders are dealt over tasks by their key and
opened there; below the last step a task walks on by itself, one folder in memory at a time.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LEVELS = 2  # levels of folders dealt over tasks below the root
TASKS = 64  # tasks of a level
BATCH = 10_000  # rows a task gives at a time
CONTENT_BYTES = 8 << 20  # of files' contents that a task gives at a time, or one larger file

SCHEMA = "key string, size long"  # a null size: a folder that is still to be opened
_ARROW = pa.schema([("key", pa.string()), ("size", pa.int64())])

FileSystem = Callable[[], pafs.FileSystem]


def _hidden(name: str) -> bool:
    """Names that Spark's own readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _children(
    fs: pafs.FileSystem, root: str, folder: str, pattern: str | None, prefix: str
) -> Iterator[tuple[str, int | None]]:
    """(key, size) of what a folder holds; a folder among it has no size."""
    selector = pafs.FileSelector(f"{root}/{folder}" if folder else root)
    for info in fs.get_file_info(selector):
        key = f"{folder}/{info.base_name}" if folder else info.base_name
        if _hidden(info.base_name):
            continue
        if info.type == pafs.FileType.Directory:
            if f"{key}/".startswith(prefix) or prefix.startswith(f"{key}/"):
                yield key, None
        elif key.startswith(prefix) and (pattern is None or fnmatch.fnmatchcase(info.base_name, pattern)):
            yield key, info.size


def _opened(
    batches: Iterator[pa.RecordBatch], filesystem: FileSystem, root: str, pattern: str | None, prefix: str, deep: bool
) -> Iterator[pa.RecordBatch]:
    """Files as they come, folders by what they hold; deep: down to the files."""
    fs = filesystem()

    def rows() -> Iterator[tuple[str, int | None]]:
        for batch in batches:
            for folder, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if size is not None:
                    yield folder, size
                    continue
                waiting = [folder]
                while waiting:
                    for key, size in _children(fs, root, waiting.pop(), pattern, prefix):
                        if deep and size is None:
                            waiting.append(key)
                        else:
                            yield key, size

    held: list[tuple[str, int | None]] = []
    for row in rows():
        held.append(row)
        if len(held) == BATCH:
            yield _batch(held)
            held = []
    yield _batch(held)


def _batch(rows: list[tuple[str, int | None]]) -> pa.RecordBatch:
    keys, sizes = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sizes, pa.int64())], schema=_ARROW)


def list_in_tasks(
    spark: SparkSession, filesystem: FileSystem, root: str, pattern: str | None = None, prefix: str = "",
    levels: int = LEVELS, tasks: int = TASKS,
) -> DataFrame:
    """(key, size) of every file below ``root``, a path of the file system.

    ``filesystem`` opens the store and is called in the tasks. ``pattern`` (``*``, ``?``,
    ``[...]``) is for file names; folders that cannot hold a key with ``prefix`` stay shut.
    A root that is not there is an error when the listing runs.
    """
    opened = partial(_opened, filesystem=filesystem, root=root.rstrip("/") or "/", pattern=pattern, prefix=prefix)
    found = spark.range(1, numPartitions=1).select(F.lit("").alias("key"), F.lit(None).cast("long").alias("size"))
    found = found.mapInArrow(partial(opened, deep=levels == 0), SCHEMA)
    for level in range(levels):
        # A number of tasks of its own: the few bytes of folder names say nothing of what lies below.
        found = found.repartition(tasks, "key").mapInArrow(partial(opened, deep=level == levels - 1), SCHEMA)
    return found


def contents(filesystem: FileSystem, root: str) -> Callable[[str], Column]:
    """A function of a column of keys below ``root``: the bytes of these files, read in the tasks."""
    top = root.rstrip("/")

    @F.arrow_udf("binary")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fs = filesystem()
        for keys in batches:
            held: list[bytes] = []
            size = 0
            for key in keys.to_pylist():
                with fs.open_input_file(f"{top}/{key}") as file:
                    held.append(file.read())
                size += len(held[-1])
                if size >= CONTENT_BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary())

    return read
