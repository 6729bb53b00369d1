"""Object listings (relative path, size, modification time) without reading contents.

A tree is listed folder by folder on the executors: every round deals the folders
found so far to tasks, each of which lists its own, until no folder is left.
Neither the driver nor a task holds the whole listing.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.ordering import staged
from tidepool.sources.files import file_system


def _listed(root: str):
    """One row for what stands in each of the given folders (paths relative to the root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        base = base.rstrip("/")
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True))
                found = [x for x in found if not x.base_name.startswith(("_", "."))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x.path[len(base) :].lstrip("/") for x in found], pa.string()),
                        pa.array([x.type == pafs.FileType.Directory for x in found], pa.bool_()),
                        pa.array([x.size for x in found], pa.int64()),
                        pa.array([x.mtime_ns // 1000 if x.mtime_ns else None for x in found], pa.int64()),
                    ],
                    names=["path", "folder", "size", "at"],
                )

    return run


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files below the root, recursively, as (path relative to the root, size,
    modified) whose name fits ``glob``; names that begin with ``_`` or ``.`` are
    left out, with all below them. A missing root has no files.

    One job a level of the tree. The folders of a level are spread over tasks
    by their names; each level is staged, so a lost executor costs a reread."""
    schema = "path string, folder boolean, size bigint, at bigint"
    folders, levels = spark.range(1).select(F.lit("").alias("path")), []
    while True:
        # names are spread evenly: neighbours in the tree land in different tasks
        level = staged(folders.repartition(F.xxhash64("path")).mapInArrow(_listed(root), schema), "listing")
        levels.append(level.where("NOT folder"))
        folders = level.where("folder").select("path")
        if folders.isEmpty():
            break
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    if glob != "*":
        out = out.where(F.element_at(F.split("path", "/"), -1).rlike(fnmatch.translate(glob)))
    return out.select("path", "size", F.timestamp_micros("at").cast("timestamp_ntz").alias("modified"))
