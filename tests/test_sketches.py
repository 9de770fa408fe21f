"""Merged sketches against exact figures, however the rows are split into days and deliveries."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from glasswatch.operators import sketches, verdicts

VERDICTS = "provider string, model_name string, status string, latency_ms long, requested_at timestamp_ntz"


@pytest.fixture(scope="module")
def calls(spark):
    r = random.Random(8)
    rows = []
    for i in range(30_000):
        at = datetime(2026, 1, 1) + timedelta(days=r.randrange(60), seconds=r.randrange(86_400))
        # two providers in three are the hot one; some rows have no time, provider or latency
        rows.append((
            r.choice(["a", "a", "b", None]), "m", r.choice(["ok"] * 9 + ["api_error"]), r.choice([None, 0, *[int(r.expovariate(0.002)) + 1] * 20]),
            r.choice([at] * 20 + [None]),
        ))
    return spark.createDataFrame(rows, VERDICTS).cache()


def _stored(spark, path, parts, build):
    for i, part in enumerate(parts):
        sketches.store_delivery(build(part), path, f"d{i}")
    sketches.store_delivery(build(parts[-1]), path, f"d{len(parts) - 1}")  # loaded again
    return spark.read.parquet(path)


@pytest.mark.parametrize("k", [64, sketches.LATENCY_K])
def test_latency_within_the_stated_error(spark, calls, rows, tmp_path, k):
    days = _stored(spark, str(tmp_path / "s"), calls.randomSplit([0.5, 0.3, 0.2], seed=1), lambda p: sketches.latency_by_day(p, k))
    report = sketches.latency_report(days, k)
    plain = ["provider", "n_ok_verdicts", "latency_ms_min", "latency_ms_max"]
    assert rows(report, *plain) == rows(verdicts.latency_distribution(calls), *plain)
    for r in sketches.latency_ranks(report, calls).collect():
        # the bound holds for 99 of 100 sketches; twice as much is as good as never passed
        assert r["latency_ms_p50_off"] <= 2 * r["rank_error"] and r["latency_ms_p95_off"] <= 2 * r["rank_error"]
    # a sketch doesn't grow with its rows
    longest = days.agg(F.max(F.length("sketch"))).first()[0]
    assert longest < 60 * k


def test_distinct_counts(spark, rows, tmp_path):
    r = random.Random(2)
    plays = [(r.choice(["hot", "hot", "t1", None]), r.choice([f"u{r.randrange(9000)}", "", None]), datetime(2026, 1, 1 + r.randrange(20))) for _ in range(40_000)]
    plays.append(("quiet", None, None))
    frame = spark.createDataFrame(plays, "track_id string, user_id string, at timestamp_ntz")
    days = _stored(spark, str(tmp_path / "s"), frame.randomSplit([0.6, 0.4], seed=1), lambda p: sketches.distinct_by_day(p, ["track_id"], "user_id", "at"))
    got = {x["track_id"]: x for x in sketches.distinct_report(days, ["track_id"], "listeners").collect()}
    want = {x["track_id"]: x for x in frame.groupBy("track_id").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("listeners")).collect()}
    assert got.keys() == want.keys() and want["hot"]["listeners"] > 4096 > want["t1"]["listeners"] > 1
    for key, w in want.items():
        g = got[key]
        assert g["n"] == w["n"] and abs(g["listeners"] - w["listeners"]) <= 5 * g["relative_error"] * w["listeners"]
    assert got["hot"]["relative_error"] > 0 == got["t1"]["relative_error"] == got["quiet"]["listeners"]
    cut = F.lit(datetime(2026, 1, 11)).cast("date")
    kept = {x[0]: x[1] for x in sketches.common_values(days, ["track_id"], F.col("day") < cut, F.col("day") >= cut, "n").collect()}
    both = {k: {u for t, u, at in plays if t == k and u is not None and at and (at < datetime(2026, 1, 11))} & {u for t, u, at in plays if t == k and u is not None and at and at >= datetime(2026, 1, 11)} for k in want}
    assert kept["t1"] == len(both["t1"]) and abs(kept["hot"] - len(both["hot"])) < 0.2 * len(both["hot"]) and kept["quiet"] == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], VERDICTS)
    assert sketches.latency_report(sketches.latency_by_day(empty)).count() == 0
    assert sketches.distinct_report(sketches.distinct_by_day(empty, ["provider"], "status", "requested_at"), ["provider"], "n_status").count() == 0
