"""Folders of many small files.

Spark lists a folder on its driver, plans each file there and takes some milliseconds for each one it writes or opens. Here tasks list, read and write
files through Arrow's file systems, and the driver sees none of them, so executors need access to the folder. What Arrow can't open (a store it
doesn't know, a path with wildcards) is left to Spark's own source and writer.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasswatch.session import new_path

_LISTED = "path string, modificationTime timestamp, length long"
_LISTED_ARROW = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())])
#: In place of a length: a folder still to be listed.
_FOLDER = -1
_ROWS, _BYTES = 10_000, 4 << 20
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _system(root: str) -> tuple[fs.FileSystem, str]:
    # Spark's paths aren't escaped, URIs are
    system, base = fs.FileSystem.from_uri(quote(root.replace("s3a://", "s3://", 1), safe="/:"))
    return system, base.rstrip("/")


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _found(root: str) -> fs.FileInfo | None:
    """What Arrow finds there, None if it can't open the store."""
    try:
        system, base = _system(root)
        return system.get_file_info(base or "/")
    except (pa.ArrowException, OSError):
        return None


def _tasks(spark: SparkSession) -> int:
    """Paths are few bytes for much work, so their number isn't left to sizes. A task for each file would outnumber the work by far."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _hidden(name: str) -> bool:
    """Names that Spark's sources skip."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _skipped(below: str) -> bool:
    return ("/_" in below or "/." in below or "._COPYING_" in below) and any(map(_hidden, below.split("/")[1:]))


def _chunks(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), _LISTED_ARROW, strict=True)], schema=_LISTED_ARROW)

    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) >= _ROWS:
            yield batch()
            some = []
    if some:
        yield batch()


def _lister(root: str, deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(root)

        def entries(folders: list[str]) -> Iterator[tuple]:
            for folder in folders:
                at = base + folder[len(root) :]
                for x in system.get_file_info(fs.FileSelector(at or "/", recursive=deep)):
                    path, is_file = x.path, x.type == fs.FileType.File
                    # Spark skips files without a byte
                    if _skipped(path[len(at) :]) or not (x.size if is_file else not deep and x.type == fs.FileType.Directory):
                        continue
                    yield root + path[len(base) :], (x.mtime_ns or 0) // 1_000_000 * 1000, x.size if is_file else _FOLDER

        for batch in batches:
            folder = pc.equal(batch.column("length"), _FOLDER)
            if (files := batch.filter(pc.invert(folder))).num_rows:
                yield files
            yield from _chunks(entries(batch.filter(folder).column("path").to_pylist()))

    return listing


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """``path, modificationTime, length`` of all files below a folder. Like Spark, hidden names and files without a byte are skipped.

    Two levels of folders are listed one by one, each dealt to all tasks, and what lies deeper with its folder.
    """
    root = _qualified(spark, folder)
    info = _found(root)
    if info is None or info.type not in (fs.FileType.File, fs.FileType.Directory):
        return _by_spark(spark, folder).drop("content")
    length = _FOLDER if info.type == fs.FileType.Directory else info.size
    at = F.timestamp_millis(F.lit((info.mtime_ns or 0) // 1_000_000))
    found = spark.range(0, 1, 1, 1).select(F.lit(root).alias("path"), at.alias("modificationTime"), F.lit(length).cast("long").alias("length"))
    found = found.filter("length <> 0").mapInArrow(_lister(root, False), _LISTED)
    for deep in (False, True):
        found = found.repartition(_tasks(spark), "path").mapInArrow(_lister(root, deep), _LISTED)
    return found


def _by_spark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def _sha256(system: fs.FileSystem, name: str) -> str:
    found = hashlib.sha256()
    with system.open_input_stream(name, compression=None) as f:
        while some := f.read(_BYTES):
            found.update(some)
    return found.hexdigest()


def _content(system: fs.FileSystem, name: str) -> bytes:
    with system.open_input_stream(name, compression=None) as f:
        return f.read()


def _document(system: fs.FileSystem, name: str) -> str:
    with system.open_input_stream(name) as f:  # unpacked, if its name says so
        content = f.read()
    try:
        return content.decode(json.detect_encoding(content))
    except UnicodeDecodeError:
        return ""


def _read(spark: SparkSession, files: DataFrame, root: str, one: Callable[[fs.FileSystem, str], object], name: str, kind: str) -> DataFrame:
    """``files`` with a column more: what ``one`` makes of each file."""

    def reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(root)
        arrow = {"string": pa.string(), "binary": pa.binary()}[kind]
        for batch in batches:
            begun, size, some = 0, 0, []
            for path in batch.column("path").to_pylist():
                some.append(one(system, base + path[len(root) :]))
                size += len(some[-1])
                if size >= _BYTES:
                    yield pa.RecordBatch.from_arrays([*batch.slice(begun, len(some)).columns, pa.array(some, arrow)], names=[*batch.schema.names, name])
                    begun, size, some = begun + len(some), 0, []
            if some:
                yield pa.RecordBatch.from_arrays([*batch.slice(begun, len(some)).columns, pa.array(some, arrow)], names=[*batch.schema.names, name])

    return files.repartition(_tasks(spark), "path").mapInArrow(reading, f"{_LISTED}, {name} {kind}")


def _opens(spark: SparkSession, folder: str) -> str | None:
    root = _qualified(spark, folder)
    info = _found(root)
    return root if info is not None and info.type in (fs.FileType.File, fs.FileType.Directory) else None


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """The files of ``listed`` with their bytes as ``content``."""
    root = _opens(spark, folder)
    return _by_spark(spark, folder) if root is None else _read(spark, listed(spark, folder), root, _content, "content", "binary")


def hashes(spark: SparkSession, folder: str) -> DataFrame:
    """The files of ``listed`` with their ``sha256``; of a large file, a few megabytes are held at a time."""
    root = _opens(spark, folder)
    if root is None:
        return _by_spark(spark, folder).withColumn("sha256", F.sha2("content", 256)).drop("content")
    return _read(spark, listed(spark, folder), root, _sha256, "sha256", "string")


def documents(spark: SparkSession, folder: str) -> DataFrame | None:
    """One text per file as ``path, modificationTime, length, text``, decoded as JSON is; None if only Spark can open the folder.

    Folders below count as Spark's tables have it: those named ``key=value`` belong to it, others don't.
    """
    root = _opens(spark, folder)
    if root is None:
        return None
    within = F.regexp_like(F.substr("path", F.lit(len(root) + 1)), F.lit("^(/[^/]*=[^/]*)*(/[^/]*)?$"))
    return _read(spark, listed(spark, folder).filter(within), root, _document, "text", "string")


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a run wrote for itself, through the file system it lies in. Tasks delete the folders in it."""
    root = _opens(spark, folder)
    if root is not None:

        def deleting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, base = _system(root)
            for batch in batches:
                for name in batch.column("path").to_pylist():
                    if system.get_file_info(at := base + name[len(root) :]).type == fs.FileType.Directory:
                        system.delete_dir(at)
                yield batch

        at = spark.range(0, 1, 1, 1).select(F.lit(root).alias("path"), F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(_FOLDER).cast("long").alias("length"))
        folders = at.mapInArrow(_lister(root, False), _LISTED).filter(F.col("length") == _FOLDER).repartition(_tasks(spark), "path")
        folders.mapInArrow(deleting, _LISTED).agg(F.count(F.lit(1))).collect()
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_each(rows: DataFrame, folder: str) -> None:
    """Write a file for each value of the first column, with the second as its lines, below a new folder.

    The file is named ``column=value``, in a folder per task; Spark's own writer makes it a folder of that name. A file is written aside and
    renamed, so that a task that is run again leaves it whole. Only values are counted over a shuffle, and lines moved only of those that
    come again, unless one task has more than twice its share of the rows.
    """
    spark, (key, line) = rows.sparkSession, rows.columns
    root = _qualified(spark, folder)
    info = _found(root)
    if info is None:
        rows.repartition(key).write.option("lineSep", "\n").partitionBy(key).text(folder)
        return
    if info.type != fs.FileType.NotFound:
        raise FileExistsError(folder)
    rows, path = rows.select(F.col(key).cast("string").alias(key), line), new_path(spark, "files_again")
    rows.groupBy(F.col(key).alias("_again")).count().filter("count > 1").select("_again").write.parquet(path)
    again = spark.read.schema("_again string").parquet(path)
    once, several = rows, None
    if not again.isEmpty():
        met = F.col(key).eqNullSafe(F.col("_again"))
        once, several = rows.join(again, met, "left_anti"), rows.join(again, met, "left_semi").repartition(_tasks(spark), key).sortWithinPartitions(key)
    most, n = rows.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count"), F.sum("count")).first()
    if n and most * spark.sparkContext.defaultParallelism > 2 * n:
        once = once.repartition(_tasks(spark), key)
    system, base = _system(root)
    system.create_dir(base)
    for dealt, part in ((once, "part"), (several, "again")):
        if dealt is not None:
            dealt.mapInArrow(_writer(root, key, line, part), "n long").agg(F.sum("n")).collect()


def _writer(root: str, key: str, line: str, part: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes a file for each run of equal values."""

    def writing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(root)
        own = f"{base}/{part}={TaskContext.get().partitionId():05d}"
        names, last, out, n = (None, None), None, None, 0

        def close() -> None:
            out.close()
            if names[0] != names[1]:
                system.move(*names)

        for batch in batches:
            for value, text in zip(batch.column(key).to_pylist(), batch.column(line).cast(pa.binary()).to_pylist(), strict=True):
                if out is None or value != last:
                    if out is None:
                        system.create_dir(own)
                    else:
                        close()
                    name = f"{key}={_NULL if value is None else quote(value, safe='')}"
                    # an object store shows a file when it is closed, and renames by copying
                    names = f"{own}/.{name}.{uuid.uuid4().hex[:8]}" if system.type_name in ("local", "hdfs") else f"{own}/{name}", f"{own}/{name}"
                    out, last, n = system.open_output_stream(names[0], compression=None), value, n + 1
                out.write((text or b"") + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    return writing
