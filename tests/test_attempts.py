"""The rate limit over raw attempts against a loop over them, in a batch and as a stream with restarts."""

import random
from datetime import datetime, timedelta

import pytest

from glasswatch.config import RateLimit
from glasswatch.operators import attempts
from glasswatch.streaming import requests as rq

LIMIT = RateLimit(requests=3, minutes=15)
SCHEMA = "query_id string, key_id string, requested_at timestamp_ntz, `c0.x` string"


def made_log():
    r = random.Random(8)
    start, out = datetime(2026, 4, 1), []
    for i in range(900):
        key = r.choice(["hot"] * 4 + ["a", "b", "c", None])
        at = start + timedelta(seconds=r.choice([0, 60, 900]) + 30 * r.randrange(400))
        out.append((f"q{i:04d}", key, at if r.random() < 0.97 else None, "x"))
    return out


def brute(log):
    out = {}
    held: dict = {}
    for q, key, at, _ in sorted(log, key=lambda x: (x[2] is not None, x[2] or datetime.min, x[0])):
        mine = held.setdefault(key, [])
        n = 0 if at is None else sum(t >= at - timedelta(minutes=LIMIT.minutes) for t in mine)
        if at is not None and n < LIMIT.requests:
            mine.append(at)
        out[q] = (n, n >= LIMIT.requests)
    return out


def as_dict(rows):
    got = {r["query_id"]: (r["n_recent"], r["is_rejected"]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_batch(spark):
    log = made_log()
    out = attempts.decided(spark.createDataFrame(log, SCHEMA).repartition(5), LIMIT)
    assert out.columns == ["query_id", "key_id", "requested_at", "c0.x", "n_recent", "is_rejected"]
    got = as_dict(out.collect())
    assert got == brute(log) and 100 < sum(x[1] for x in got.values()) < len(got)
    assert attempts.decided(spark.createDataFrame([], SCHEMA), LIMIT).collect() == []


@pytest.mark.parametrize("cuts", [(), (1500, 4000, 4001, 9000)])
def test_stream_with_restarts(spark, tmp_path, cuts):
    log = [x[:3] for x in made_log() if x[2] is not None]
    schema = "query_id string, key_id string, requested_at timestamp_ntz"
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    edges = [datetime.min, *(datetime(2026, 4, 1) + timedelta(seconds=c) for c in cuts), datetime.max]
    for lo, hi in zip(edges, edges[1:], strict=False):
        part = [x for x in log if lo <= x[2] < hi]
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        stream = rq.read_files(spark, folder, spark.createDataFrame([], schema).schema)
        rq.append_to(attempts.decided_stream(stream, LIMIT), out, checkpoint).awaitTermination()
    got = spark.read.parquet(out)
    assert got.columns == ["query_id", "key_id", "requested_at", "n_recent", "is_rejected"]
    rows = got.collect()
    assert as_dict(rows) == brute([(*x, "x") for x in log])
    assert {(r["query_id"], r["key_id"], r["requested_at"]) for r in rows} == set(log)


def test_state_stays_as_small_as_the_limit():
    held: list[int] = []
    counts = [attempts.admit(t, held, 10, 2) for t in [1, 1, 2, 11, 11, 12, 12, None, 30]]
    assert counts == [0, 1, 2, 2, 2, 0, 1, 0, 0] and held == [30]


def test_stream_hands_over_many_keys_at_once(spark, tmp_path, monkeypatch):
    """Keys that share a group keep apart, the empty one and the missing one too; the function is called per group, not per key."""
    monkeypatch.setattr(attempts, "KEY_GROUPS", 3)
    r = random.Random(4)
    keys = ["", None, "=", "?", *[f"k{i}" for i in range(40)]]
    log = [(f"q{i:03d}", r.choice(keys), datetime(2026, 4, 1) + timedelta(seconds=20 * r.randrange(300))) for i in range(600)]
    schema = "query_id string, key_id string, requested_at timestamp_ntz"
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    cut = datetime(2026, 4, 1) + timedelta(seconds=3000)
    for part in ([x for x in log if x[2] < cut], [x for x in log if x[2] >= cut]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        stream = rq.read_files(spark, folder, spark.createDataFrame([], schema).schema)
        query = rq.append_to(attempts.decided_stream(stream, LIMIT), out, checkpoint)
        query.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
    got = spark.read.parquet(out).collect()
    assert as_dict(got) == brute([(*x, "x") for x in log])
    assert {(r["query_id"], r["key_id"], r["requested_at"]) for r in got} == set(log)
