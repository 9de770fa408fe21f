"""Row history (type 2) as a stored table that a delivery changes only where it differs.

Open rows lie in buckets of their key's hash, a folder per bucket; closed rows lie in a folder per delivery. Closed rows never change, so a
delivery adds a folder and reads none of the earlier ones. It meets the open rows twice: once as key and row hash, which tells the buckets
with a difference, and once whole, in these buckets only. The other buckets keep their folders.

Which folders make up the history is an entry of the log that ``publish`` keeps: readers see a delivery whole or not at all, of two deliveries
at a time the second one fails with ``Conflict``, and a delivery that comes again changes nothing. The entry names a folder per bucket and
delivery, so it grows with these and not with the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.operators.history import apply_snapshot, first_snapshot
from glasswatch.plans.publish import add_entry, entry_folders, latest
from glasswatch.sources.sinks import clustered

#: Names of the layout's own columns, which only make folders.
_BUCKET, _STATE = "_bucket", "_state"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    # NULL leaves a hash as it is, so NULL keys have a bucket like all others
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, entry: dict[str, str], kinds: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    folders = [f"{path}/{folder}" for name, folder in entry.items() if name.split("/")[0] in kinds]
    if not folders:
        return spark.createDataFrame([], schema)
    # names of folders are no columns here
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)


def _write(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> str:
    """Rows in a new folder: open ones by bucket, closed ones together. Gives the folder, relative to ``path``."""
    folder = f"versions/{uuid.uuid4().hex}"
    placed = rows.select(
        "*", F.when(F.col("is_current"), "open").otherwise("closed").alias(_STATE), F.when(F.col("is_current"), _bucket(keys, buckets)).otherwise(0).alias(_BUCKET)
    )
    clustered(placed, [_STATE, _BUCKET]).write.partitionBy(_STATE, _BUCKET).parquet(f"{path}/{folder}")
    return folder


def _written(spark: SparkSession, path: str, folder: str) -> tuple[list[int], bool]:
    """Buckets that have open rows in a folder, and whether there are closed rows. Only names of folders are read."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    here = hadoop(f"{path}/{folder}/{_STATE}=open")
    names = [f.getPath().getName() for f in system.listStatus(here)] if system.exists(here) else []
    return sorted(int(n.split("=")[1]) for n in names), system.exists(hadoop(f"{path}/{folder}/{_STATE}=closed"))


def _require_unique(delivery: DataFrame, keys: Sequence[str]) -> None:
    twice = delivery.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"keys that a delivery brings several times, such as {[tuple(r)[:-1] for r in twice]}")


def start(spark: SparkSession, path: str, current: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: Column, buckets: int = 256) -> int:
    """Store the first delivery below ``path``, which must hold no history yet. Keys must be unique; NULL is a key like others."""
    _require_unique(current, keys)
    rows = first_snapshot(current, tracked, at)
    folder = _write(rows, path, keys, buckets)
    entry = {"schema": rows.schema.json(), "keys": json.dumps(list(keys)), "tracked": json.dumps(list(tracked)), "buckets": str(buckets)}
    entry |= {f"open/{b}": f"{folder}/{_STATE}=open/{_BUCKET}={b}" for b in _written(spark, path, folder)[0]}
    add_entry(spark, path, 1, entry)
    return 1


def differing_buckets(spark: SparkSession, path: str, entry: dict[str, str], delivery: DataFrame) -> DataFrame:
    """``(_bucket)`` of every bucket in which a key is new, gone or has another row hash; at most one row per bucket.

    Open rows give their keys and hashes only, each key is counted on both sides in one aggregate.
    """
    keys, buckets = json.loads(entry["keys"]), int(entry["buckets"])
    fresh = first_snapshot(delivery, json.loads(entry["tracked"]), F.lit(None).cast("timestamp_ntz"))
    sides = _read(spark, path, entry, ["open"]).select(*keys, "row_hash", F.lit(0).alias("_new")).unionByName(fresh.select(*keys, "row_hash", F.lit(1).alias("_new")))
    met = sides.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.sum("_new").alias("_brought"), F.min("row_hash").alias("_least"), F.max("row_hash").alias("_most")
    )
    same = (F.col("_n") == 2) & (F.col("_brought") == 1) & (F.col("_least") == F.col("_most"))
    return met.filter(~same).select(_bucket(keys, buckets).alias(_BUCKET)).distinct()


def deliver(spark: SparkSession, path: str, delivery: DataFrame, at: Column, based_on: int | None = None) -> int:
    """Apply the whole state as delivered at ``at``: changed and vanished rows are closed, changed and new ones opened.

    ``based_on`` is the number the delivery was made for, by default the last one. Gives the number readers now see, which stays the same if
    the delivery brings nothing new.
    """
    base = latest(spark, path) if based_on is None else based_on
    entry = entry_folders(spark, path, base)
    keys, tracked, buckets = json.loads(entry["keys"]), json.loads(entry["tracked"]), int(entry["buckets"])
    _require_unique(delivery, keys)
    touched = sorted(r[0] for r in differing_buckets(spark, path, entry, delivery).collect())
    if not touched:
        return base
    open_names = {f"open/{b}" for b in touched}
    old = _read(spark, path, {k: v for k, v in entry.items() if k in open_names or k == "schema"}, ["open"])
    rows = apply_snapshot(old, delivery.filter(_bucket(keys, buckets).isin(touched)), keys, tracked, at)
    folder = _write(rows, path, keys, buckets)
    filled, closed = _written(spark, path, folder)
    kept = {k: v for k, v in entry.items() if k not in open_names}
    kept |= {f"open/{b}": f"{folder}/{_STATE}=open/{_BUCKET}={b}" for b in filled}
    if closed:
        kept[f"closed/{base + 1}"] = f"{folder}/{_STATE}=closed"
    add_entry(spark, path, base + 1, kept)
    return base + 1


def read_history(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Open and closed rows after a delivery, by default the last one."""
    return _read(spark, path, entry_folders(spark, path, latest(spark, path) if number is None else number), ["open", "closed"])


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Open rows only; closed ones aren't opened."""
    return _read(spark, path, entry_folders(spark, path, latest(spark, path)), ["open"])
