"""The files below a folder, listed by tasks: one listing per directory, level by level.

Directories of a level are a stored table between two jobs. Names of files stay in tables; only
whether a level has directories comes to the driver. Hidden names and files without a byte are
listed like all others. Tasks list through pyarrow, which opens local folders, S3, GCS and HDFS.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from remitspark.session import qualified
from remitspark.tables import store

LISTED = "name string, is_folder boolean, modified long, length long"
#: Directories that one task lists.
TASK_FOLDERS = 50


def walk(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """``name`` below ``root``, ``modified`` in nanoseconds and ``length`` of every file; tables are stored in ``folder``."""
    base, types = qualified(spark, root), (pa.string(), pa.bool_(), pa.int64(), pa.int64())

    # Everything that tasks need is in here: they may run where this package is not installed.
    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        if base.startswith("file:"):
            system, top = fs.LocalFileSystem(), "/" + base.removeprefix("file:").lstrip("/")
        else:
            scheme, rest = base.split(":", 1)
            system, top = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }:{rest}")
        for batch in batches:
            for name in batch.column("name").to_pylist():
                found = system.get_file_info(fs.FileSelector(f"{top}/{name}".rstrip("/"), recursive=False))
                is_folder = [info.type == fs.FileType.Directory for info in found]
                columns = (
                    [f"{name}/{info.base_name}".lstrip("/") for info in found],
                    is_folder,
                    [0 if is_dir else info.mtime_ns or 0 for info, is_dir in zip(found, is_folder, strict=True)],
                    [0 if is_dir else info.size or 0 for info, is_dir in zip(found, is_folder, strict=True)],
                )
                arrays = [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", "is_folder", "modified", "length"])

    level, levels = spark.createDataFrame([("",)], "name string"), []
    folders = 1
    while folders:
        tasks = -(-folders // TASK_FOLDERS)
        levels.append(store(level.repartition(tasks).mapInArrow(listed, LISTED), f"{folder}/level-{len(levels)}"))
        level = levels[-1].filter("is_folder").select("name")
        folders = level.count()
    return reduce(DataFrame.unionByName, levels).filter("NOT is_folder").select("name", "modified", "length")
