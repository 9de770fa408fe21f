"""Stored history against the history computed in one go, and what a delivery leaves alone."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from glasswatch.operators import history
from glasswatch.plans import history_store as hs
from glasswatch.plans.publish import Conflict, entry_folders, latest

SCHEMA = "k1 string, k2 int, a long, b string"
KEYS, TRACKED = ["k1", "k2"], ["a", "b"]


def _at(day):
    return F.lit(datetime(2026, 1, day)).cast("timestamp_ntz")


def _states(n, seed=5):
    """Deliveries in which keys come, go, come back and change, NULL keys and values among them."""
    r = random.Random(seed)
    keys = [(k, i) for k in ("x", "y", "", None) for i in (*range(8), None)]
    return [[(*k, r.choice([1, 2, None]), r.choice(["p", "", None])) for k in keys if r.random() < 0.8] for _ in range(n)]


def test_same_rows_as_in_one_go(spark, rows, tmp_path):
    path, states = str(tmp_path / "h"), _states(4)
    frames = [spark.createDataFrame(s, SCHEMA) for s in states]
    assert hs.start(spark, path, frames[0], KEYS, TRACKED, _at(1), buckets=5) == 1
    want = history.first_snapshot(frames[0], TRACKED, _at(1))
    for day, frame in enumerate(frames[1:], 2):
        assert hs.deliver(spark, path, frame, _at(day)) == day
        want = history.apply_snapshot(want, frame, KEYS, TRACKED, _at(day))
        assert rows(hs.read_history(spark, path)) == rows(want)
        assert rows(hs.read_open(spark, path)) == rows(want.filter("is_current"))
    assert rows(hs.read_history(spark, path, 1)) == rows(history.first_snapshot(frames[0], TRACKED, _at(1)))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "h")
    base = spark.range(2000).select(F.col("id").cast("string").alias("k1"), F.lit(0).alias("k2"), F.col("id").alias("a"), F.lit("p").alias("b"))
    hs.start(spark, path, base, KEYS, TRACKED, _at(1), buckets=16)
    first = entry_folders(spark, path, 1)
    assert sum(k.startswith("open/") for k in first) == 16
    # nothing new: nothing written
    assert hs.deliver(spark, path, base, _at(2)) == 1 == latest(spark, path)
    changed = base.withColumn("a", F.when(F.col("k1") == "7", 99).otherwise(F.col("a")))
    assert hs.deliver(spark, path, changed, _at(2)) == 2
    second = entry_folders(spark, path, 2)
    assert sum(first[k] != second[k] for k in first) == 1 and second.keys() - first.keys() == {"closed/2"}
    # closed rows are neither read nor moved by the next delivery
    entry = {k: v for k, v in second.items()}
    read = hs._read(spark, path, entry, ["open"]).inputFiles()
    assert read and not any("_state=closed" in f for f in read)
    plan = hs.differing_buckets(spark, path, second, base)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "row_hash" in line)
    assert "ReadSchema: struct<k1:string,k2:int,row_hash:string>" in scan
    plain = hs.read_history(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plain


def test_races_repeated_keys_and_empty_deliveries(spark, rows, tmp_path):
    path = str(tmp_path / "h")
    empty = spark.createDataFrame([], SCHEMA)
    assert hs.start(spark, path, empty, KEYS, TRACKED, _at(1)) == 1
    assert hs.read_history(spark, path).count() == 0
    one = spark.createDataFrame([("x", 1, 1, "p")], SCHEMA)
    assert hs.deliver(spark, path, one, _at(2), based_on=1) == 2
    with pytest.raises(Conflict):
        hs.deliver(spark, path, one, _at(2), based_on=1)
    with pytest.raises(ValueError, match="several times"):
        hs.deliver(spark, path, one.union(one), _at(3))
    assert hs.deliver(spark, path, empty, _at(3)) == 3
    assert rows(hs.read_history(spark, path), "k1", "is_current", "valid_to") == [("x", False, datetime(2026, 1, 3))]
    assert hs.read_open(spark, path).count() == 0
    with pytest.raises(Conflict):
        hs.start(spark, path, one, KEYS, TRACKED, _at(4))
