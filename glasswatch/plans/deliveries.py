"""Delivered files: which ones changed since the last run, and whether their schemas keep the contract.

Files are listed and read by tasks (``sources.files``); contents are read only where they are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.plans.publish import latest, publish_set, read_set
from glasswatch.sources import files
from glasswatch.sources.ingest import header_drift

MANIFEST = "manifest"
_MANIFEST_SCHEMA = "file string, sha256 string, length long"


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder: ``path, modificationTime, length, content``. Files without a byte are skipped: they count as not delivered."""
    return files.contents(spark, folder)


def file_hashes(spark: SparkSession, folder: str, file: Column | None = None) -> DataFrame:
    """``file, sha256, length`` of each file. ``file`` names it, by default with its path below the folder."""
    uri = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = uri.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(uri).toString()
    name = F.substr("path", F.lit(len(root) + 2)) if file is None else file
    return files.hashes(spark, folder).select(name.alias("file"), "sha256", "length")


def check_delivery(spark: SparkSession, folder: str, manifests: str, file: Column | None = None) -> DataFrame:
    """Hash all files of ``folder``, compare them with the manifest of the last run and publish the new manifest.

    Returns ``file, sha256, previous_sha256, status``: ``new``, ``changed``, ``same`` or ``gone``. The files are read once: what is compared is the
    manifest just written. A run that breaks before its manifest is published leaves the last one, so its repetition finds the same
    changes; two runs at a time end in a ``Conflict`` of the second.
    """
    before = latest(spark, manifests)
    publish_set(spark, {MANIFEST: file_hashes(spark, folder, file)}, manifests, {}, based_on=before)
    return changes(spark, manifests, before + 1)


def changes(spark: SparkSession, manifests: str, number: int) -> DataFrame:
    """What run ``number`` found against the run before it."""
    now = read_set(spark, manifests, number)[MANIFEST]
    last = read_set(spark, manifests, number - 1)[MANIFEST] if number > 1 else spark.createDataFrame([], _MANIFEST_SCHEMA)
    old = last.select("file", F.col("sha256").alias("previous_sha256"))
    status = (
        F.when(F.col("sha256").isNull(), "gone")
        .when(F.col("previous_sha256").isNull(), "new")
        .when(F.col("sha256") == F.col("previous_sha256"), "same")
        .otherwise("changed")
    )
    return now.select("file", "sha256").join(old, "file", "full").withColumn("status", status)


def described(schema: T.StructType) -> list[str]:
    """A schema as one text per column: its name and type."""
    return [f"{f.name} {f.dataType.simpleString()}" for f in schema]


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from urllib.parse import quote

    from pyarrow import fs, parquet
    from pyspark.sql.pandas.types import from_arrow_type

    for batch in batches:
        paths = batch.column("path").to_pylist()
        headers = []
        for path in paths:
            # Spark's paths aren't escaped, URIs are
            system, name = fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe="/:"))
            with system.open_input_file(name) as f:  # reads the end of the file only
                fields = parquet.read_schema(f)
            headers.append([f"{c.name} {from_arrow_type(c.type, prefer_timestamp_ntz=True).simpleString()}" for c in fields])
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(headers, pa.list_(pa.string()))], names=["source", "header"])


def footers(spark: SparkSession, folder: str) -> DataFrame:
    """``source`` (path) and ``header`` (name and type of each column) of every Parquet file below a folder.

    Tasks open the files' ends through Arrow's file systems, so executors need access to the folder; the driver sees no footer.
    """
    paths = files.listed(spark, folder).select("path").filter(F.col("path").endswith(".parquet"))
    # a task for each file would outnumber the work by far
    return paths.coalesce(4 * spark.sparkContext.defaultParallelism).mapInArrow(_footers, "source string, header array<string>")


def contract_breaches(spark: SparkSession, folder: str, contract: T.StructType) -> DataFrame:
    """``source, position, got, want`` for each column in which a delivered file departs from the contract; none if all keep it.

    Files that keep one contract have one schema, so this also is the test that all inputs of a table agree.
    """
    return header_drift(footers(spark, folder), described(contract))


def require_contract(spark: SparkSession, folder: str, contract: T.StructType, shown: int = 20) -> None:
    """Fail with the first ``shown`` breaches, before anything of the folder is loaded."""
    breaches = contract_breaches(spark, folder, contract).orderBy("source", "position").limit(shown).collect()
    if breaches:
        lines = [f"{r['source']} column {r['position']}: got {r['got']}, want {r['want']}" for r in breaches]
        raise ValueError("delivered files break the contract:\n" + "\n".join(lines))
