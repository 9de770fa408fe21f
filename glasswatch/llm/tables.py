"""Intermediate tables in the shared folder, and the package itself on the executors."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import glasswatch
from glasswatch.session import new_path

_shipped: set[str] = set()
#: By application: the work folder of the stage that is being planned, and those of earlier ones.
_current: dict[str, str] = {}
_earlier: dict[str, list[str]] = {}


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, through the file system it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def work_folder(spark: SparkSession, docs: DataFrame) -> Iterator[None]:
    """Let ``stored`` write to a folder of its own, and first delete the folders of earlier stages that ``docs`` doesn't read.

    For jobs in stages, whose results are written before the next stage begins: nothing needs the earlier tables any more. Frames that
    nobody holds go with them, and with these Spark drops their shuffle files.
    """
    app = spark.sparkContext.applicationId
    earlier = _earlier.setdefault(app, [])
    if earlier:
        read = docs.inputFiles()
        for folder in [e for e in earlier if not any(e in f for f in read)]:
            delete(spark, folder)
            earlier.remove(folder)
        gc.collect()
        spark._jvm.System.gc()
    _current[app] = new_path(spark, "llm-stage")
    try:
        yield
    finally:
        earlier.append(_current.pop(app))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a new path under ``spark.checkpoint.dir`` and read it back: lineage ends here, and a lost executor costs a re-read."""
    spark = df.sparkSession
    folder = _current.get(spark.sparkContext.applicationId)
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_path(spark, f"llm-{name}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package, once per application; they may start in any folder."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(glasswatch.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="glasswatch-")) / "glasswatch.zip"  # the driver's copy, which Spark serves
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, Path("glasswatch") / f.relative_to(root))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark


def give_back() -> None:
    """Return memory that earlier tasks of this Python worker freed. Workers live on, and Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
