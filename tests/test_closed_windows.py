"""Closed windows of the request log: each once, late requests counted, copies by day."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from glasswatch.config import RateLimit
from glasswatch.streaming import requests as rq

SCHEMA = "key_id string, requested_at timestamp_ntz"
LIMIT = RateLimit(requests=3, minutes=3)


def _brute(log, through):
    """Per key and window that ends by ``through``: how many requests."""
    counts = {}
    for key, at in log:
        if at is None:
            continue
        minute = at.replace(second=0, microsecond=0)
        for back in range(LIMIT.minutes):
            start = minute - timedelta(minutes=back)
            if start + timedelta(minutes=LIMIT.minutes) <= through:
                counts[key, start] = counts.get((key, start), 0) + 1
    return counts


def test_each_window_once_over_restarts_with_late_requests(spark, tmp_path):
    folder, out, days, checkpoint = (str(tmp_path / n) for n in ("in", "out", "days", "checkpoint"))
    start = datetime(2026, 1, 1, 23, 40)
    first = [("a", start + timedelta(seconds=20 * i)) for i in range(30)] + [(None, start + timedelta(minutes=2, seconds=5)), ("b", None)]
    second = [("a", start + timedelta(minutes=20, seconds=7 * i)) for i in range(30)] + [("b", start + timedelta(minutes=24))]
    late = [("a", start + timedelta(minutes=1)), ("c", start + timedelta(minutes=3)), (None, start + timedelta(minutes=2))]
    third = [*late, ("d", start + timedelta(minutes=40))]
    seen = []
    for part in (first, second, third, []):
        if part:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = rq.rate_windows(rq.read_files(spark, folder, spark.createDataFrame([], SCHEMA).schema), LIMIT)
        rq.closed_windows_to(stream, out, checkpoint).awaitTermination()
        rq.compact_windows(spark, out, days)
        seen.append(rq.read_closed_windows(spark, out, days).count())
    closed = rq.read_closed_windows(spark, out, days)
    got = {(r["key_id"], r["window_start"]): r["n"] for r in closed.collect()}
    mark = start + timedelta(minutes=38)
    assert len(got) == closed.count() == rq.read_closed_windows(spark, out).count()
    assert got == _brute(first + second, mark) and 0 < seen[0] < seen[1] < seen[2] == seen[3]
    lost = {(r["key_id"], r["window_start"]): r["n_late"] for r in rq.late_requests(spark.read.parquet(folder), closed, LIMIT).collect()}
    assert lost == _brute(late, mark)
    # the first day is copied, the second may still grow
    copied = spark.read.parquet(days).select(F.col("window_day").cast("string")).distinct().collect()
    assert [r[0] for r in copied] == ["2026-01-01"]


def test_late_requests_move_the_log_by_minutes_not_by_windows(spark):
    start = datetime(2026, 1, 1, 23, 50)
    in_time = [("a", start + timedelta(seconds=50 * i)) for i in range(40)] + [(None, start + timedelta(minutes=9, seconds=59)), ("b", None)]
    late = [("a", start + timedelta(minutes=8)), ("a", start + timedelta(minutes=8, seconds=1)), ("c", start + timedelta(minutes=11)), (None, start + timedelta(minutes=10))]
    through = start + timedelta(minutes=30)
    rows = [(k, at, at + timedelta(minutes=LIMIT.minutes), n) for (k, at), n in _brute(in_time, through).items()]
    closed = spark.createDataFrame(rows, "key_id string, window_start timestamp_ntz, window_end timestamp_ntz, n long")
    log = spark.createDataFrame(in_time + late + [("z", through)], SCHEMA)
    found = rq.late_requests(log, closed, LIMIT)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortMergeJoin" not in plan
    last = max(r[2] for r in rows)
    lost = _brute(late, last)
    assert {(r["key_id"], r["window_start"]): r["n_late"] for r in found.collect()} == lost
    assert found.columns == ["key_id", "window_start", "window_end", "n_late"]
    every = rq.late_requests(log, closed, LIMIT, every=True).collect()
    kept = _brute(in_time, last)
    assert {(r["key_id"], r["window_start"]): (r["n"], r["n_late"]) for r in every} == {k: (kept.get(k, 0), lost.get(k, 0)) for k in kept | lost}
    assert len(every) == len(kept | lost) and all(r["window_end"] - r["window_start"] == timedelta(minutes=LIMIT.minutes) for r in every)
