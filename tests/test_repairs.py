"""Cases that once went wrong: lost requests, doubled listeners, unmatched NULL keys, tied calls."""

from datetime import datetime

from pyspark.sql import functions as F

from glasswatch.config import SignalConfig, VerdictConfig
from glasswatch.functions.prefix import running_total
from glasswatch.operators import history, signals, verdict_prep
from glasswatch.operators.quality import scenario_scores
from glasswatch.schemas import BRONZE
from glasswatch.streaming import requests as rq


def test_requests_without_an_id_are_kept(spark, tmp_path):
    schema = BRONZE["researcher_queries"]
    base = spark.range(6).select(
        *[
            F.when(F.col("id") < 2, F.concat(F.lit("q"), F.col("id").cast("string"))).alias(f.name)
            if f.name == "query_id"
            else F.col("id").cast(f.dataType).alias(f.name) if f.name == "latency_ms"
            else F.lit(datetime(2026, 1, 1)).cast(f.dataType).alias(f.name) if f.name == "requested_at"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
    base.write.parquet(str(tmp_path / "in"))
    base.write.mode("append").parquet(str(tmp_path / "in"))
    rows = rq.audit_rows(rq.read_files(spark, str(tmp_path / "in"), schema))
    rq.append_to(rows, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_users_listed_twice_do_not_double_plays(spark):
    plays = spark.range(160).select(F.lit("t").alias("track_id"), (F.col("id") % 40).cast("string").alias("user_id"))
    users = spark.range(40).select(F.col("id").cast("string").alias("user_id"), F.col("id").cast("string").alias("household_id"))
    profile = lambda u: signals._listener_profile(signals.per_listener(plays), u, SignalConfig()).first()
    once, twice = profile(users), profile(users.union(users))
    assert once["s2l_ratio_severity"] == twice["s2l_ratio_severity"] and once["s2l_ratio_fires"] == twice["s2l_ratio_fires"] == 0


def test_null_keys_match_in_history(spark):
    now = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    at = lambda d: F.lit(datetime(2026, 1, d)).cast("timestamp_ntz")
    first = history.first_snapshot(now, ["v"], at(1))
    again = history.apply_snapshot(first, now, ["k"], ["v"], at(2))
    assert again.count() == 2 and again.filter("is_current").count() == 2


def test_tied_calls_do_not_see_each_other(spark):
    calls = spark.createDataFrame([(1, "x", 6.0), (1, "y", 6.0), (2, "z", 1.0)], "call_seq long, id string, cost_usd double")
    got = verdict_prep.budget_gate(calls, slot_width=10, cfg=VerdictConfig(budget_usd=100.0))
    assert sorted(r[0] for r in got.select("spent_before_usd").collect()) == [0.0, 6.0, 12.0]


def test_totals_of_slots_added_up_run_by_run(spark):
    df = spark.range(300).select("id", (F.col("id") % 7).alias("v"), (F.col("id") % 3).alias("k"))
    for keys in ([], ["k"]):
        plain, runs = (
            running_total(df, "v", "id", F.floor(F.col("id") / 5), keys, "t", slots_per_run=n).collect() for n in (None, 4)
        )
        assert sorted(map(tuple, plain)) == sorted(map(tuple, runs)) and len(plain) == 300


def test_evidence_needs_the_plays_of_picked_tracks_only(spark):
    plays = spark.createDataFrame([("a", "s1"), ("b", "s1"), ("b", "s2"), ("c", None), ("a", None)], "track_id string, session_id string")
    picked = spark.createDataFrame([("x", "a"), ("y", "a"), ("z", None)], "scenario_id string, track_id string")
    mine = verdict_prep.plays_of_tracks(plays, picked)
    assert sorted(map(str, (r["session_id"] for r in mine.collect()))) == ["None", "s1"]
    assert sorted(r["track_id"] for r in verdict_prep.plays_of_sessions(plays, mine).collect()) == ["a", "b"]


def test_verdicts_filter_the_flags_before_joining(spark):
    flags = spark.createDataFrame([("a", 1.0, "x", 1), ("b", 2.0, "y", 1)], "track_id string, composite_suspicion_score double, recommended_action string, n_signals_fired int")
    expected = spark.createDataFrame([("s", "a", 5), ("s", None, 5), ("t", "q", 1)], "scenario_id string, track_id string, expected_min_score int")
    got = {(r["scenario_id"], r["track_id"]): r["score"] for r in scenario_scores(expected, flags).collect()}
    assert got == {("s", "a"): 1.0, ("s", None): 0.0, ("t", "q"): 0.0}
