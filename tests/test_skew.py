"""One key with a third of all rows: results stay whole, and no plan gathers the key in one place."""

import bisect
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from glasswatch.config import RateLimit, SignalConfig, VerdictConfig
from glasswatch.functions.joins import spread_join
from glasswatch.functions.prefix import exact_quantiles, running_total
from glasswatch.operators import quality, verdict_prep
from glasswatch.operators import signals as sg
from glasswatch.operators.researcher import rate_limit_decision
from glasswatch.operators.verdict_prep import budget_gate

T0 = datetime(2026, 1, 1)


def _keyed(rng, n):
    return "hot" if rng.random() < 0.34 else rng.choice(["a", "b", None])


def test_running_total_equals_a_plain_loop(spark):
    rng = random.Random(1)
    data = [(i, _keyed(rng, i), rng.randrange(200), rng.randrange(-5, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, k string, t long, v long")
    got = {r["id"]: r["running_total"] for r in running_total(df, "v", "t", F.floor(F.col("t") / 16), ["k"]).collect()}
    for i, k, t, _ in rng.sample(data, 200):
        assert got[i] == sum(v for _, k2, t2, v in data if k2 == k and t2 <= t)
    assert len(got) == len(data)


def test_exact_quantiles_equal_sorting(spark):
    rng = random.Random(2)
    data = [(_keyed(rng, i), rng.randrange(5000)) for i in range(4001)] + [("one", 7), ("two", 1), ("two", 4), ("a", None)]
    df = spark.createDataFrame(data, "k string, v long")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}, 100).collect()}
    groups = defaultdict(list)
    for k, v in data:
        if v is not None:
            groups[k].append(v)
    for k, values in groups.items():
        values.sort()
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p0", 0.0), ("p100", 1.0)):
            at = p * (len(values) - 1)
            lo, hi = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert got[k][name] == pytest.approx(lo + (hi - lo) * (at - int(at)))


def test_rate_limit_equals_a_plain_loop(spark):
    rng = random.Random(3)
    log = []
    for i in range(3000):
        at = T0 + timedelta(seconds=rng.randrange(4 * 3600))
        log.append((f"q{i}", _keyed(rng, i), at))
    # exactly fifteen minutes apart still counts, a microsecond more does not
    log += [("e1", "edge", T0), ("e2", "edge", T0 + timedelta(minutes=15)),
            ("f1", "far", T0), ("f2", "far", T0 + timedelta(minutes=15, microseconds=1)), ("n", "edge", None)]
    df = spark.createDataFrame(log, "query_id string, key_id string, requested_at timestamp_ntz")
    got = {r["query_id"]: r for r in rate_limit_decision(df, RateLimit(requests=40)).collect()}
    assert len(got) == len(log)
    times = defaultdict(list)
    for _, k, at in log:
        if at is not None:
            times[k].append(at)
    for values in times.values():
        values.sort()
    for q, k, at in log:
        if at is None:
            assert got[q]["n_recent"] == 0
            continue
        n = bisect.bisect_right(times[k], at) - bisect.bisect_left(times[k], at - timedelta(minutes=15)) - 1
        assert (got[q]["n_recent"], got[q]["is_rejected"]) == (n, n >= 40)
    assert got["e2"]["n_recent"] == 1 and got["f2"]["n_recent"] == 0


def test_rate_limit_of_one_key_within_a_window(spark):
    """One key makes all requests within minutes: slots are narrower than that, and their width changes nothing."""
    log = [(f"q{i}", "hot", T0 + timedelta(milliseconds=37 * i)) for i in range(9000)]
    df = spark.createDataFrame(log, "query_id string, key_id string, requested_at timestamp_ntz")
    for seconds in (0.5, 60, 3600):
        got = {r["query_id"]: r["n_recent"] for r in rate_limit_decision(df, RateLimit(requests=40), seconds).collect()}
        assert got == {f"q{i}": i for i in range(9000)}


def test_budget_gate_equals_a_plain_loop(spark):
    rng = random.Random(4)
    costs = [rng.choice([0.0, 0.01, 0.25]) for _ in range(500)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(costs)], "call_seq long, cost_usd double")
    got = {r["call_seq"]: r for r in budget_gate(df, slot_width=16, cfg=VerdictConfig(budget_usd=10.0)).collect()}
    spent = 0.0
    for i, c in enumerate(costs):
        skipped = round(spent, 9) >= 10.0
        assert (got[i]["gate_reason"] == "budget_cap") == skipped
        assert got[i]["charged_usd"] == (0.0 if skipped else c)
        spent += 0.0 if skipped else c
    assert 0 < sum(r["gate_reason"] is not None for r in got.values()) < 500


def _hot_plays(spark, n=60000):
    """A third of all plays on one track, by one user, in one session and from one country each."""

    def pick(name, size, shift):
        other = F.concat(F.lit(name), (F.xxhash64("id", F.lit(shift)) % size).cast("string"))
        return F.when((F.col("id") + shift) % 3 == 0, f"{name}0").otherwise(other)

    return spark.range(n).select(
        pick("t", 500, 0).alias("track_id"),
        pick("u", 900, 1).alias("user_id"),
        (F.lit(T0) + F.make_dt_interval(hours=(F.col("id") % 3000).cast("int"))).cast("timestamp_ntz").alias("streamed_at"),
        pick("c", 30, 2).alias("stream_country_iso2"),
        pick("s", 4000, 0).alias("session_id"),
    )


def test_hot_track_user_and_session(spark):
    plays = _hot_plays(spark)
    users = plays.select("user_id").distinct().withColumn("household_id", F.abs(F.xxhash64("user_id")) % 50)
    tracks = plays.select("track_id").distinct().select(
        "track_id", F.lit("a").alias("artist_id"), (F.xxhash64("track_id") % 2 == 0).alias("ai_generated_label")
    )
    artists = spark.createDataFrame([("a", "c1")], "artist_id string, country_iso2 string")
    cfg = SignalConfig(reference_time=datetime(2026, 5, 1))
    flags = sg.artificial_streaming_flags(plays, users, tracks, artists, cfg)
    # by hand, in pandas
    p = plays.toPandas()
    hh = dict(users.toPandas().itertuples(index=False))
    got = {r["track_id"]: r for r in flags.collect()}
    assert set(got) == set(p.track_id)
    hot = p[p.track_id == "t0"]
    n = hot.user_id.map(hh).value_counts()
    hhi = float((n * n).sum()) / float(n.sum()) ** 2
    assert len(hot) >= 20000
    assert got["t0"]["repeat_listener_severity"] == pytest.approx(min(3.0, hhi / 0.2))
    assert got["t0"]["s2l_ratio_severity"] == pytest.approx(min(3.0, len(hot) / hot.user_id.nunique() / 4.0))
    share = hot.stream_country_iso2.value_counts().max() / len(hot)
    assert got["t0"]["geo_anomaly_severity"] == pytest.approx((share - 0.5) / 0.2)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_or_single_partitions(spark):
    plays = spark.createDataFrame(
        [("t", "u", T0, "SE", "s")] * 2,
        "track_id string, user_id string, streamed_at timestamp_ntz, stream_country_iso2 string, session_id string",
    )
    users = spark.createDataFrame([("u", "h")], "user_id string, household_id string")
    tracks = spark.createDataFrame([("t", "a", True)], "track_id string, artist_id string, ai_generated_label boolean")
    artists = spark.createDataFrame([("a", "SE")], "artist_id string, country_iso2 string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(sg.artificial_streaming_flags(plays, users, tracks, artists))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Window", "Python"):
        assert bad not in plan
    # nothing is broadcast by hint: with automatic broadcast off, every join shuffles
    assert "BroadcastExchange" not in plan
    # the three profiles meet on the partitioning their last aggregate left: no shuffle above the aggregates
    top = plan.split("HashAggregate")[0]
    assert "Exchange" not in top


def test_spread_join_keeps_rows_and_can_be_split_at_run_time(spark, rows):
    big = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), "id"
    )
    small = spark.range(400).select(F.col("id").alias("k"), F.lit("x").alias("v")).groupBy("k").agg(F.max("v").alias("v"))
    expected = rows(big.join(small, "k", "left").groupBy("v").agg(F.count("*"), F.sum("id")))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # two salts leave the hot key skewed, so that splitting has something to do
        joined = spread_join(big, small, ["k"], "left", spread_by=["id"], salts=2)
        counted = joined.groupBy("v").agg(F.count("*"), F.sum("id"))
        assert rows(counted) == expected
        assert "skew=true" in _plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError, match="power of two"):
        spread_join(big, small, ["k"], salts=3)


def test_spread_join_never_broadcasts_the_repeated_side(spark, rows):
    big = spark.range(2000).select((F.col("id") % 300).alias("k"), "id")
    small = spark.range(200).select(F.col("id").alias("k"), F.col("id").alias("v")).groupBy("k").agg(F.max("v").alias("v"))
    joined = spread_join(big, small, ["k"], "left", spread_by=["id"])
    assert rows(joined, "id", "k", "v") == rows(big.join(small, "k", "left"), "id", "k", "v")
    assert "BroadcastExchange" not in _plan(joined)


def test_tables_of_all_tracks_are_never_sent_through_the_driver(spark, rows):
    flags = spark.range(300).select(F.col("id").alias("track_id"), (F.col("id") % 7).cast("double").alias("composite_suspicion_score"))
    expected = spark.range(10, 310).select(
        (F.col("id") % 3).cast("string").alias("scenario_id"), F.col("id").alias("track_id"), F.lit(1).alias("expected_min_score")
    )
    tracks = spark.range(305).select(F.col("id").alias("track_id"))
    scores, picked = quality.scenario_scores(expected, flags), verdict_prep.picked_tracks(flags, expected, tracks)
    assert rows(scores) == rows(spark.createDataFrame([(str(i % 3), i, 1, float(i % 7) if i < 300 else 0.0) for i in range(10, 310)], scores.schema))
    assert rows(picked) == [("0", 27, 6.0), ("1", 13, 6.0), ("2", 20, 6.0)]
    assert "BroadcastExchange" not in _plan(scores) + _plan(picked)
