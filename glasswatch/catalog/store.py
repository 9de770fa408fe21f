"""Tables that Spark derives from the driver's and that many queries read: written once per session and input folder.

Plays, report sheets and marts are stored tables wherever this is used for real. Writing them cuts the joins of the
driver's tables off the queries proper, and a lost executor costs a re-read instead of the whole lineage.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from glasswatch.session import new_path

_lock = threading.RLock()
_written: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}
_schemas: dict[tuple[str, str], T.StructType] = {}


def stored(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[SparkSession, str], DataFrame],
    write: Callable[[DataFrame, str], None] = lambda df, path: df.write.parquet(path),
    *added: T.StructField,
) -> DataFrame:
    """The table ``build`` makes, as ``write`` stores it; ``added`` are columns that the layout adds."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _written:
            df = build(spark, sf_dir)
            path = new_path(spark, name)
            write(df, path)
            _written[key] = (path, T.StructType([*df.schema, *added]))
        path, schema = _written[key]
    return spark.read.schema(schema).parquet(path)


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a Parquet table, looked up once per session."""
    key = (spark.sparkContext.applicationId, path)
    with _lock:
        if key not in _schemas:
            _schemas[key] = spark.read.parquet(path).schema
        return _schemas[key]
