"""Writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.sources.ingest import require_same_schema
from glasswatch.sources.readers import union_by_name


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value in few tasks, so that each writes few files. Values that are too large for a task are
    split at run time, small ones merged."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def truncate_reload(inputs: dict[str, DataFrame], path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table by all inputs in one write. With partition columns only the delivered partitions are replaced."""
    require_same_schema(inputs)
    writer = clustered(union_by_name(*inputs.values()), partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def lists_to_json(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, the form the bronze tables keep them in."""
    return df.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def write_sorted(df: DataFrame, path: str, order: str | None = None) -> None:
    """Write Parquet in the order of one column (the first by default), times as microseconds, lists as JSON text.

    Ranges go to different files, so the order costs one range shuffle and no single-task sort. The ranges are cut by
    the column and then by a hash of the row: a value that fills the table is spread over several files.
    """
    key = df.columns[0] if order is None else order
    flat = lists_to_json(df)
    ordered = flat.repartitionByRange(F.col(key), F.xxhash64(*flat.columns)).sortWithinPartitions(key)
    ordered.write.mode("overwrite").option("compression", "snappy").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append rows to an audit table."""
    df.write.mode("append").parquet(path)


def write_mart(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Store a mart, one file set per partition value."""
    writer = clustered(df, partition_by).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_by_day(df: DataFrame, path: str, time: str = "streamed_at", day: str = "play_day", mode: str = "error") -> None:
    """Store rows in a folder per day of ``time``, sorted by time within a file. Rows without a time get a folder of their own.

    ``mode="overwrite"`` replaces only the days that ``df`` brings. A day's rows meet in few tasks; a day too large for a task is split at run
    time, so it has several files.
    """
    by_day = clustered(df.withColumn(day, F.to_date(time)), [day]).sortWithinPartitions(day, time)
    by_day.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
