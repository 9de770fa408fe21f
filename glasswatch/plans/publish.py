"""Write, audit, publish: marts become visible only if all checks pass, several of them at once.

Every version of a table is written once, to a folder of its own, and never touched again. Publishing adds one numbered entry to a log, which
names the folder of every table of the set. Readers follow the entry with the highest number, so they see a set of marts whole or not at
all, and a publication that fails half-way leaves the last good set in place.

An entry is written aside and renamed to the number after the one its publisher started from. A name can be taken only once: of two
publishers that started from the same set the second one fails with ``Conflict`` and shows nothing. This is as safe as the file system's
rename without overwriting (atomic on HDFS; on a local disk, as in tests, it checks first). No clock is involved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasswatch.sources.sinks import write_mart

Check = Callable[[DataFrame], DataFrame]
Tables = dict[str, DataFrame]
SetCheck = Callable[[Tables], DataFrame]
#: The name of the only table of a set that ``publish`` makes.
ONLY = "table"
_ENTRY = "number long, tables map<string,string>"


class Conflict(RuntimeError):
    """Another publisher has published since the set this one is based on."""


@dataclass(frozen=True)
class Outcome:
    """Failing rows per check, whether the set was published, and under which number."""

    failures: dict[str, int]
    published: bool
    number: int | None = None


def count_failures(table: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """One row per check with its number of failing rows. All checks run as one job."""
    return _counted({name: check(table) for name, check in checks.items()})


def _counted(failing: Tables) -> DataFrame:
    counted = [rows.agg(F.count(F.lit(1)).alias("n_failures")).select(F.lit(name).alias("check_name"), "n_failures") for name, rows in failing.items()]
    return reduce(DataFrame.unionByName, counted)


def _entries(spark: SparkSession, path: str) -> str | None:
    """The log's folder, if anything was published."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    return f"{path}/log" if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log) else None


def latest(spark: SparkSession, path: str) -> int:
    """Number of the set that readers see, 0 before the first one."""
    log = _entries(spark, path)
    return (spark.read.schema(_ENTRY).json(log).agg(F.max("number")).first()[0] or 0) if log else 0


def add_entry(spark: SparkSession, path: str, number: int, folders: dict[str, str]) -> None:
    """Take a number. The entry is written under a name that readers skip, then renamed."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/log/{number:012d}.json")
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}/log/_{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = aside.getFileSystem(conf).create(aside, False)
    out.write(bytearray(json.dumps({"number": number, "tables": folders}).encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, target, nothing)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            files.delete(aside, False)
            raise Conflict(f"set {number} of {path} was published by someone else") from None
        raise


def publish_set(
    spark: SparkSession,
    tables: Tables,
    path: str,
    checks: dict[str, SetCheck],
    partition_by: dict[str, Sequence[str]] | None = None,
    based_on: int | None = None,
) -> Outcome:
    """Write ``tables`` below ``path``, run the checks on what was written and show all of them at once if no check fails.

    A check gets the written tables by name and returns failing rows, so it may compare them. ``based_on`` is the set that the tables
    were computed from, by default the one that readers see now. Tables of that set that aren't given stay as they are.
    """
    base = latest(spark, path) if based_on is None else based_on
    folders = entry_folders(spark, path, base) if base else {}
    written = {}
    for name, df in tables.items():
        folders[name] = f"versions/{name}/{uuid.uuid4().hex}"
        write_mart(df, f"{path}/{folders[name]}", (partition_by or {}).get(name, ()))
        written[name] = spark.read.schema(df.schema).parquet(f"{path}/{folders[name]}")
    # one row per check comes back
    failures = {r["check_name"]: r["n_failures"] for r in _counted({n: c(written) for n, c in checks.items()}).collect()} if checks else {}
    if any(failures.values()):
        return Outcome(failures, False)
    add_entry(spark, path, base + 1, folders)
    return Outcome(failures, True, base + 1)


def entry_folders(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    entry = spark.read.schema(_ENTRY).json(f"{path}/log").filter(F.col("number") == number).first()
    if entry is None:
        raise ValueError(f"{path} has no set {number}")
    return dict(entry["tables"])


def read_set(spark: SparkSession, path: str, number: int | None = None) -> Tables:
    """All tables of a published set, by default of the last one. The set is chosen once, so its tables belong together."""
    number = latest(spark, path) if number is None else number
    return {name: spark.read.parquet(f"{path}/{folder}") for name, folder in entry_folders(spark, path, number).items()}


def publish(df: DataFrame, path: str, checks: dict[str, Check], partition_by: Sequence[str] = ()) -> Outcome:
    """The same for a single table."""
    named = {name: (lambda tables, check=check: check(tables[ONLY])) for name, check in checks.items()}
    return publish_set(df.sparkSession, {ONLY: df}, path, named, {ONLY: partition_by})


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version below ``path`` that was published last."""
    return read_set(spark, path)[ONLY]
