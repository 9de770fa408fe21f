"""Sliding windows of the request log, stored as counts per key and minute: the same as Spark's own windows, without its state."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from glasswatch.config import RateLimit
from glasswatch.streaming import requests as rq

SCHEMA = "key_id string, requested_at timestamp_ntz"
LIMIT = RateLimit(requests=3, minutes=3)
START = datetime(2026, 1, 1, 23, 50)


def _log(*at):
    return [(k, None if m is None else START + timedelta(minutes=m)) for k, m in at]


def _add(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder, files=1):
    return rq.read_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, max_files=files)


def _by_spark(log, out, checkpoint):
    """Spark's sliding windows in update mode."""
    windows = (
        log.withColumn("requested_at", F.col("requested_at").cast("timestamp")).withWatermark("requested_at", "2 minutes")
        .groupBy("key_id", F.window("requested_at", "3 minutes", "1 minute")).agg(F.count(F.lit(1)).alias("n"))
        .select("key_id", F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n")
    )
    store = lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch_id={i}")
    windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store).trigger(availableNow=True).start().awaitTermination()


def test_latest_windows_are_sparks_with_late_requests_over_batches_and_runs(spark, tmp_path):
    folder, ours, theirs, c1, c2 = (str(tmp_path / n) for n in ("in", "ours", "theirs", "c1", "c2"))
    runs = (
        (_log(("a", 0), ("a", 0.5), ("b", 3), (None, 4), ("b", None), ("a", 10)), _log(("a", 1), ("c", 7.5), ("a", 20))),
        (_log(("a", 14), ("a", 15), ("a", 16.2), (None, 17), ("b", 30)), _log(("a", 15), ("b", 21), ("b", 27), ("a", 17.9)), _log(("d", 27), ("d", 28.5), ("d", 31))),
    )
    for files in runs:
        for rows in files:
            _add(spark, rows, folder)
        rq.latest_windows_to(rq.rate_windows(_stream(spark, folder), LIMIT), ours, c1).awaitTermination()
        _by_spark(_stream(spark, folder), theirs, c2)
        want = spark.read.parquet(theirs).groupBy("key_id", "window_start").agg(F.max("n").alias("n")).collect()
        got = rq.read_latest_windows(spark, ours, LIMIT)
        assert got.columns == ["key_id", "window_start", "window_end", "n", "over_limit"]
        got = got.collect()
        assert sorted(map(str, [(r["key_id"], r["window_start"], r["n"]) for r in got])) == sorted(map(str, [tuple(r) for r in want]))
        assert all(r["window_end"] - r["window_start"] == timedelta(minutes=3) and r["over_limit"] == (r["n"] >= 3) for r in got)
    # some came too late for all of their windows, some for a few
    assert spark.read.parquet(f"{ours}/counts").filter("windows < 3").count() > 0


def test_a_request_is_stored_once_not_per_window_and_no_state_is_kept(spark, tmp_path):
    folder, latest, closed, c1, c2 = (str(tmp_path / n) for n in ("in", "latest", "closed", "c1", "c2"))
    _add(spark, _log(*[(f"k{i % 7}", 40 * i) for i in range(50)]), folder)
    log = lambda: rq.rate_windows(_stream(spark, folder))
    rq.latest_windows_to(log(), latest, c1).awaitTermination()
    rq.closed_windows_to(log(), closed, c2).awaitTermination()
    assert not os.path.exists(f"{c1}/state") and not os.path.exists(f"{c2}/state")
    assert spark.read.parquet(f"{latest}/counts").count() == spark.read.parquet(f"{closed}/counts").count() == 50
    assert rq.read_latest_windows(spark, latest).count() == 750 and rq.read_closed_windows(spark, closed).count() == 735
    assert rq.read_closed_windows(spark, closed, runs=True).count() == 49


def test_closed_and_late_counts_add_up_over_batches_of_a_run(spark, tmp_path):
    folder, out, days, checkpoint = (str(tmp_path / n) for n in ("in", "out", "days", "checkpoint"))
    everything = []
    for rows in (_log(("a", 0), ("a", 9.5), ("b", 12)), _log(("a", 1), ("a", 9), ("a", 8), (None, 10.5), ("b", 25)), _log(("c", 21), ("a", 22.5), ("d", 40), ("d", None))):
        _add(spark, rows, folder)
        everything += rows
    rq.closed_windows_to(rq.rate_windows(_stream(spark, folder), LIMIT), out, checkpoint).awaitTermination()
    before = sorted(map(str, rq.read_closed_windows(spark, out).collect()))
    rq.compact_windows(spark, out, days)
    total = {}
    for key, at in everything:
        for back in range(3):
            if at is not None and (first := at.replace(second=0) - timedelta(minutes=back)) + timedelta(minutes=3) <= START + timedelta(minutes=38):
                total[key, first] = total.get((key, first), 0) + 1
    windows, runs = (rq.read_closed_windows(spark, out, days, runs=r) for r in (False, True))
    assert sorted(map(str, windows.collect())) == before and windows.count() == windows.select("key_id", "window_start").distinct().count()
    assert {str(r[0]) for r in spark.read.parquet(days).select("window_day").distinct().collect()} == {"2026-01-01"}
    last = max(r["window_start"] for r in windows.collect())
    for closed in (windows, runs):
        rows = rq.late_requests(spark.read.parquet(folder), closed, LIMIT, every=True).collect()
        assert {(r["key_id"], r["window_start"]): r["n"] + r["n_late"] for r in rows} == {k: n for k, n in total.items() if k[1] <= last}
        assert len(rows) == len({(r["key_id"], r["window_start"]) for r in rows}) and sum(r["n_late"] for r in rows) > 0
