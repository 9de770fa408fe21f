"""Delivered files, sets of published tables, plays by day."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.config import SignalConfig
from glasswatch.operators import signals
from glasswatch.plans import deliveries
from glasswatch.plans.publish import Conflict, latest, publish_set, read_set
from glasswatch.sources import sinks


def _status(df):
    return {r["file"]: r["status"] for r in df.collect()}


def test_files_of_two_deliveries(spark, tmp_path):
    folder, manifests = tmp_path / "in", str(tmp_path / "manifests")
    (folder / "sub dir").mkdir(parents=True)
    for name in ("same", "edited", "emptied", "gone", "sub dir/x=1"):
        (folder / name).write_bytes(name.encode())
    assert set(_status(deliveries.check_delivery(spark, str(folder), manifests)).values()) == {"new"}
    (folder / "edited").write_bytes(b"other")
    (folder / "emptied").write_bytes(b"")
    (folder / "gone").unlink()
    (folder / "late").write_bytes(b"late")
    found = deliveries.check_delivery(spark, str(folder), manifests)
    assert _status(found) == {"same": "same", "edited": "changed", "gone": "gone", "emptied": "gone", "late": "new", "sub dir/x=1": "same"}
    assert set(_status(deliveries.check_delivery(spark, str(folder), manifests)).values()) == {"same"}  # "emptied" and "gone" are forgotten
    # an earlier run can be asked for again
    assert _status(deliveries.changes(spark, manifests, 2)) == _status(found)


def test_contract_of_files(spark, tmp_path):
    folder = str(tmp_path / "parquet")
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("tags", T.ArrayType(T.StringType()))])
    good = spark.createDataFrame([(1, datetime(2025, 1, 1), ["a"])], contract)
    good.write.parquet(f"{folder}/a")
    good.limit(0).write.parquet(f"{folder}/b #%41")
    assert deliveries.contract_breaches(spark, folder, contract).count() == 0
    deliveries.require_contract(spark, folder, contract)
    good.select("id", F.col("at").cast("date").alias("at")).coalesce(1).write.parquet(f"{folder}/c")
    rows = deliveries.contract_breaches(spark, folder, contract).collect()
    assert {(r["position"], r["got"], r["want"]) for r in rows} == {(1, "at date", "at timestamp_ntz"), (2, None, "tags array<string>")}
    assert all("/c/part-" in r["source"] for r in rows)
    with pytest.raises(ValueError, match="column 1: got at date, want at timestamp_ntz"):
        deliveries.require_contract(spark, folder, contract)


def test_sets_are_seen_whole_and_races_fail(spark, tmp_path):
    path = str(tmp_path / "marts")
    keys = lambda n: spark.range(n).withColumnRenamed("id", "k")
    checks = {"facts_have_dim": lambda t: t["fact"].join(t["dim"], "k", "left_anti")}
    assert latest(spark, path) == 0
    assert publish_set(spark, {"fact": keys(2), "dim": keys(3)}, path, checks).number == 1
    refused = publish_set(spark, {"fact": keys(5), "dim": keys(3)}, path, checks)
    assert not refused.published and refused.failures == {"facts_have_dim": 2}
    counts = lambda n=None: {name: df.count() for name, df in read_set(spark, path, n).items()}
    assert counts() == {"fact": 2, "dim": 3}
    # two publishers start from set 1; the first wins, and what it didn't bring stays
    assert publish_set(spark, {"dim": keys(4)}, path, {}, based_on=1).number == 2
    with pytest.raises(Conflict):
        publish_set(spark, {"fact": keys(1)}, path, {}, based_on=1)
    assert latest(spark, path) == 2 and counts() == {"fact": 2, "dim": 4} and counts(1) == {"fact": 2, "dim": 3}
    with pytest.raises(ValueError, match="no set 9"):
        read_set(spark, path, 9)


def test_spike_opens_the_days_of_its_window_only(spark, tmp_path):
    cfg = SignalConfig()
    start = F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00"))
    hours = F.make_dt_interval(F.lit(0), (F.col("id") * 48).cast("int"))
    plays = spark.range(300).select(F.when(F.col("id") % 7 > 0, start + hours).alias("streamed_at"), F.concat(F.lit("t"), F.col("id") % 3).alias("track_id"), F.lit("DE").alias("stream_country_iso2"))
    path = str(tmp_path / "plays")
    sinks.write_by_day(plays, path)
    stored = spark.read.parquet(path)
    ours, plain = signals.listen_spike(stored, cfg), signals.listen_spike(plays, cfg)
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect())) and plain.count() > 0
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(play_day" in plan and str(cfg.window_from.date()) in plan
    # a delivery replaces the days it brings, no others
    sinks.write_by_day(plays.filter("id = 1"), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 300
    days = spark.createDataFrame([(datetime(2025, 1, 3).date(), "x"), (datetime(2025, 1, 5).date(), "y")], "play_day date, kind string")
    days.write.parquet(str(tmp_path / "days"))
    picked = signals.plays_of_days(spark.read.parquet(path), spark.read.parquet(str(tmp_path / "days")).filter("kind = 'x'"))
    assert "dynamicpruning" in picked._jdf.queryExecution().executedPlan().toString()
    assert [r["streamed_at"] for r in picked.collect()] == [datetime(2025, 1, 3)]
