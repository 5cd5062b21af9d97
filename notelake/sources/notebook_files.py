"""One file per notebook, written by a Python data source with task and job commit.

Rows are the lines of rebuilt notebooks (``rebuild_notebooks``). The lines of a notebook meet in one
task, sorted, and are written as they come: a task holds one line at a time, whatever the size of a
notebook. Files are written into a folder of the task attempt; when the attempt is complete they move
to the folder of the job, and when all tasks are, that folder becomes the target by one rename. A failed
or repeated attempt leaves nothing behind, nor does a failed job, and readers never see half a corpus.

With ``buckets`` notebooks are packed into as many zip archives, which a large corpus needs: millions of
small files are slow to list on any store. ``scan_packed`` reads archives, ``scan_notebooks`` files;
both give the documents under the names they were written by.

Folders are named by URI or absolute path and have to be shared by all executors.
"""

from __future__ import annotations

import io
import posixpath
import sys
import uuid
import zipfile
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SUFFIX = ".ipynb"
FORMAT = "notebook_files"

# Functions that run on the executors travel by value, the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_name(name: str | None) -> str:
    """Where a notebook lies below the target; names may have folders but not leave the target."""
    parts = (name or "").split("/")
    if not all(parts) or any(part in (".", "..") for part in parts):
        raise ValueError(f"no file can be named {name!r}")
    return name if name.endswith(SUFFIX) else name + SUFFIX


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Folder:
    """Notebooks as files of their own."""

    def __init__(self, store: fs.FileSystem, folder: str):
        self.store, self.folder, self.out = store, folder, None

    def open(self, name: str):
        self.close()
        path = posixpath.join(self.folder, file_name(name))
        self.store.create_dir(posixpath.dirname(path), recursive=True)
        self.out = self.store.open_output_stream(path)
        return self.out

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class _Archives:
    """Notebooks as members of the archive of their bucket, one bucket after another."""

    def __init__(self, store: fs.FileSystem, folder: str):
        self.store, self.folder = store, folder
        self.bucket = self.stream = self.archive = self.out = None

    def open(self, name: str, bucket: int):
        if self.out is not None:
            self.out.close()
        if bucket != self.bucket:
            self.close()
            self.store.create_dir(self.folder, recursive=True)
            self.stream = self.store.open_output_stream(
                posixpath.join(self.folder, f"bucket-{bucket:05}.zip"))
            self.archive = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_DEFLATED)
            self.bucket = bucket
        member = zipfile.ZipInfo(file_name(name))  # with a fixed date: equal runs give equal bytes
        member.compress_type = zipfile.ZIP_DEFLATED
        self.out = self.archive.open(member, "w", force_zip64=True)
        return self.out

    def close(self) -> None:
        for part in (self.out, self.archive, self.stream):
            if part is not None:
                part.close()
        self.bucket = self.stream = self.archive = self.out = None


@dataclass
class _Written(WriterCommitMessage):
    notebooks: int


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.packed = options["path"], options["packed"] == "true"
        self.staging = f"{self.path.rstrip('/')}.staging-{options['job']}"

    def write(self, iterator) -> _Written:
        store, staging = _place(self.staging)
        attempt = posixpath.join(staging, f"attempt-{TaskContext.get().taskAttemptId()}")
        target = (_Archives if self.packed else _Folder)(store, attempt)
        now, out, notebooks = None, None, 0
        try:
            for row in iterator:
                if row["notebook_hash"] != now or out is None:
                    now, notebooks = row["notebook_hash"], notebooks + 1
                    out = (target.open(now, row["bucket"]) if self.packed else target.open(now))
                out.write(row["json"].encode())
        finally:
            target.close()
        # Files of an attempt that is complete; another attempt of the task has the same bytes.
        for found in store.get_file_info(fs.FileSelector(attempt, allow_not_found=True, recursive=True)):
            if found.type == fs.FileType.File:
                end = posixpath.join(staging, "files", posixpath.relpath(found.path, attempt))
                store.create_dir(posixpath.dirname(end), recursive=True)
                store.move(found.path, end)
        return _Written(notebooks)

    def commit(self, messages) -> None:
        store, staging = _place(self.staging)
        files = posixpath.join(staging, "files")
        store.create_dir(files, recursive=True)  # also without a notebook
        _, end = _place(self.path)
        if store.get_file_info(end).type != fs.FileType.NotFound:
            store.delete_dir(end)
        store.create_dir(posixpath.dirname(end), recursive=True)
        store.move(files, end)
        store.delete_dir(staging)

    def abort(self, messages) -> None:
        store, staging = _place(self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class NotebookFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "notebook_hash string, json string, bucket int"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


def write_notebook_files(lines: DataFrame, directory: str, buckets: int | None = None,
                         overwrite: bool = False) -> None:
    """Lines (notebook_hash, line, json) as ``<name>.ipynb`` files, or packed into ``buckets`` archives.

    A target that is there is an error unless ``overwrite``; it is replaced when the job commits.
    """
    spark = lines.sparkSession
    store, path = _place(directory)
    if not overwrite and store.get_file_info(path).type != fs.FileType.NotFound:
        raise FileExistsError(directory)
    spark.dataSource.register(NotebookFiles)
    bucket = F.lit(0) if buckets is None else F.pmod(F.xxhash64("notebook_hash"), F.lit(buckets))
    rows = lines.select("notebook_hash", "line", "json", bucket.cast("int").alias("bucket"))
    together = (rows.repartition("notebook_hash") if buckets is None
                else rows.repartition(buckets, "bucket"))
    (together.sortWithinPartitions("bucket", "notebook_hash", "line")
     .select("notebook_hash", "json", "bucket").write.format(FORMAT).mode("append")
     .option("path", directory).option("packed", str(buckets is not None).lower())
     .option("job", uuid.uuid4().hex).save())


def scan_packed(spark: SparkSession, directory: str) -> DataFrame:
    """(notebook_hash, content) of every notebook in the archives below ``directory``."""
    def unpack(batches):
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                    for member in archive.infolist():
                        yield pa.RecordBatch.from_pydict({
                            "notebook_hash": [member.filename], "content": [archive.read(member)]})

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option(
        "recursiveFileLookup", "true").load(directory)
    return archives.select("content").mapInArrow(unpack, "notebook_hash string, content binary")
