"""Files by name: opening them on executors, and a sink that writes one file per row.

``write_files(df, folder)`` (``df.write.format("named_files")``) writes rows (``path string, content string or binary``) as files below the folder. Each
task writes into a staging folder and reports what it wrote; the driver's commit
moves the files into place, an abort removes them. A failed or repeated task thus
leaves nothing behind, and writing the same rows again gives the same files.

Paths are opened with Arrow's file systems (local, HDFS, S3, GCS by their URI).
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Fixed value: files that the commit moves at a time (a move waits for the store).
MOVERS = 16


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, or of a plain local path."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def open_uri(uri: str):
    """The file as a stream of bytes, unpacked by its extension."""
    fs, path = file_system(uri)
    return fs.open_input_stream(path, compression="detect")


# --- one file per row -----------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


def _inside(path: str) -> str:
    """The normal form of a relative path; one that leaves the folder is an error."""
    clean = posixpath.normpath(path)
    if clean.startswith(("/", "../")) or clean in ("", ".", ".."):
        raise ValueError(f"not a path inside of the folder: {path!r}")
    return clean


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder, self.staging = folder, f"_staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = file_system(self.folder)
        own = f"{self.staging}/{uuid.uuid4().hex}"  # this attempt's: tasks may run twice
        made, paths = set(), []
        for batch in batches:
            for row in batch.to_pylist():
                path, content = _inside(row["path"]), row["content"]
                above = posixpath.dirname(f"{folder}/{own}/{path}")
                if above not in made:
                    fs.create_dir(above, recursive=True)
                    made.add(above)
                with fs.open_output_stream(f"{folder}/{own}/{path}", compression=None) as out:
                    out.write(content.encode() if isinstance(content, str) else content or b"")
                paths.append(f"{own}/{path}")
        return Written(paths)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = file_system(self.folder)
        staged: dict[str, str] = {}  # of files of the same name the last task's stays
        for path in (p for m in messages if m for p in m.paths):
            name = path.split("/", 2)[2]
            if staged.get(name) == path:
                self._clear(fs, folder)
                raise FileExistsError(f"one task wrote the same file twice: {name!r}")
            staged[name] = path
        for above in {posixpath.dirname(f"{folder}/{name}") for name in staged}:
            fs.create_dir(above, recursive=True)

        def move(names: list[str]) -> None:
            for name in names:
                fs.move(f"{folder}/{staged[name]}", f"{folder}/{name}")

        names = list(staged)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(move, [names[k::MOVERS] for k in range(MOVERS)]))
        self._clear(fs, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*file_system(self.folder))

    def _clear(self, fs: pafs.FileSystem, folder: str) -> None:
        if fs.get_file_info(f"{folder}/{self.staging}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{folder}/{self.staging}")


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "path string, content string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        if overwrite:
            raise ValueError("named_files are appended; a file of the same name is replaced")
        return NamedFilesWriter(self.options["path"])


def write_files(rows: DataFrame, folder: str) -> None:
    """Writes (path, content) rows as files below the folder."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    rows.select("path", "content").write.format("named_files").mode("append").save(folder)
