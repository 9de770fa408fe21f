from datetime import datetime, timedelta
import hashlib

import pytest
from pyspark.sql import functions as F

from glasswatch.config import VerdictConfig
from glasswatch.operators import signals as sg
from glasswatch.operators import verdict_prep as vp
from glasswatch.operators import verdicts as vd
from glasswatch.plans import serving
from glasswatch.schemas import BRONZE
from glasswatch.operators.staging import stage_table

T0 = datetime(2026, 5, 1)
R, L, N = "recommend_remove", "recommend_rank_lower", "recommend_no_action"


def verdicts(spark, items):
    """Staged verdicts from (scenario, provider, recommendation, status, latency, time offset in days)."""
    raw = []
    for i, (scenario, provider, rec, status, latency, days) in enumerate(items):
        at = T0 + timedelta(days=days)
        base = dict(verdict_id=f"v{i}", scenario_id=scenario, track_id=f"t_{scenario}", provider=provider, model="m",
                    recommendation=rec, requested_at=at, completed_at=at, latency_ms=latency, input_tokens=100,
                    output_tokens=10, cost_usd=0.001, prompt_hash="p", status=status, uncertainty_flags="[]")
        raw.append(tuple(base.get(c) for c in BRONZE["llm_verdicts"].names))
    return stage_table(spark.createDataFrame(raw, BRONZE["llm_verdicts"]), "llm_verdicts")


def flags(spark, pairs):
    return spark.createDataFrame(pairs, "track_id string, composite_suspicion_score double, recommended_action string, n_signals_fired int")


def test_agreement_flag(spark):
    v = verdicts(spark, [("a", "x", R, "ok", 5, 0), ("b", "x", N, "ok", 5, 0), ("c", "x", None, "api_error", 0, 0), ("d", "x", R, "ok", 1, 0)])
    f = flags(spark, [("t_a", 90.0, R, 2), ("t_b", 0.0, "no_action", 0)])
    agree = {r["scenario_id"]: r["llm_agrees_with_heuristic"] for r in vd.with_heuristic(v, f).collect()}
    # "no_action" and "recommend_no_action" differ; without a heuristic there is no agreement
    assert agree == {"a": 1, "b": 0, "c": None, "d": 0}
    agree = {r["scenario_id"]: r["llm_agrees_with_heuristic"] for r in vd.with_heuristic(v, f, normalize_no_action=True).collect()}
    assert agree["b"] == 1


def test_agreement_rate(spark):
    items = []
    for scenario, votes in {"unanimous": (R, R, R), "two": (L, L, N), "split": (R, L, N), "tie": (R, R, L, L), "failed": (R, None, None)}.items():
        items += [(scenario, f"p{i}", rec, "ok" if rec else "api_error", 1, 0) for i, rec in enumerate(votes)]
    f = flags(spark, [("t_unanimous", 90.0, R, 1), ("t_tie", 50.0, L, 1), ("t_two", 1.0, "no_action", 0)])
    got = {r["scenario_id"]: r for r in vd.agreement_rate(vd.with_heuristic(verdicts(spark, items), f)).collect()}
    shown = {k: (r["two_of_three_agree"], r["unanimous_agree"], r["plurality_recommendation"], r["llm_plurality_matches_heuristic"]) for k, r in got.items()}
    assert shown == {
        "unanimous": (1, 1, R, 1), "two": (1, 0, L, 0), "split": (0, 0, None, 0),
        # equal votes: the stronger action is shown, but the heuristic's is among the leading ones
        "tie": (1, 0, R, 1), "failed": (0, 0, None, 0),
    }
    assert (got["failed"]["n_verdicts_ok"], got["failed"]["n_verdicts_failed"], got["failed"]["n_null_rec"]) == (1, 2, 2)
    report = vd.agreement_rate(vd.with_heuristic(verdicts(spark, items), f))
    callout = serving.agreement_callout(report).collect()[0]
    assert (callout["n_two_of_three"], callout["n_unanimous"], callout["two_of_three_pct"]) == (3, 1, 60.0)
    labels = {r[0]: r[1] for r in serving.consensus_labels(report).collect()}
    assert labels["unanimous"] == "3 of 3 agree" and labels["two"] == "2 of 3 agree" and labels["split"] == "No majority"


def test_cost_latency_drift(spark):
    items = [("a", "p", R, "ok", n, 0) for n in (100, 200, 300, 400)] + [("a", "p", None, "api_error", 0, 0), ("a", "q", R, "ok", 7, 0)]
    fact = vd.with_heuristic(verdicts(spark, items), flags(spark, [("t_a", 90.0, R, 1)]))
    cost = {r["provider"]: r for r in vd.cost_breakdown(fact).collect()}["p"]
    assert (cost["n_verdicts"], cost["n_ok"], cost["total_input_tokens"], cost["total_cost_usd"]) == (5, 4, 500, 0.005)
    lat = {r["provider"]: r for r in vd.latency_distribution(fact).collect()}
    assert (lat["p"]["latency_ms_p50"], lat["p"]["latency_ms_p95"], lat["p"]["n_ok_verdicts"]) == (250.0, pytest.approx(385.0), 4)
    assert lat["q"]["latency_ms_p95"] == 7.0
    approx = {r["provider"]: r for r in vd.latency_distribution(fact, approximate=True).collect()}
    assert approx["p"]["latency_ms_p50"] in (200, 300)
    drift = {r["provider"]: r for r in vd.drift_score(fact).collect()}["p"]
    assert (drift["n_ok_current_window"], drift["n_remove"], drift["drift_score"], drift["drift_status"]) == (4, 4, None, "no_prior_snapshot")


def test_weekly_drift(spark):
    week = [("a", "p", R, "ok", 1, 0)] * 2 + [("a", "p", N, "ok", 1, 7)] * 2 + [("a", "p", N, "ok", 1, 14)] + [("a", "p", R, "ok", 1, 28)]
    fact = vd.with_heuristic(verdicts(spark, week), flags(spark, [("t", 1.0, R, 1)]))
    got = [(r["drift_status"], r["drift_score"]) for r in vd.drift_js(fact).orderBy("week_start").collect()]
    import math
    # fully different shares diverge by ln 2; a week that is missing breaks the chain
    assert got[0] == ("no_prior_snapshot", None) and got[1] == ("drift_detected", pytest.approx(math.log(2)))
    assert got[2] == ("within_tolerance", 0.0) and got[3] == ("no_prior_snapshot", None)


ANSWERS = [
    ('{"recommendation": "recommend_remove", "confidence": 0.9, "primary_signal": "none", "reasoning": "r", "uncertainty_flags": ["x"]}', "ok"),
    ('```json\n{"confidence": 1}\n```', "ok"),
    ('```\n{"confidence": 1}', "ok"),
    ("{}", "ok"),
    ('{"recommendation": null}', "ok"),
    ('{"confidence": "0.5"}', "ok"),
    ('{"uncertainty_flags": []}', "ok"),
    ('{"recommendation": "remove"}', "malformed_response"),
    ('{"confidence": 1.01}', "malformed_response"),
    ('{"confidence": "high"}', "malformed_response"),
    ('{"primary_signal": "vibes"}', "malformed_response"),
    ('{"uncertainty_flags": "x"}', "malformed_response"),
    ('{"uncertainty_flags": ["x", null]}', "malformed_response"),
    ('{"uncertainty_flags": ["x", 1]}', "malformed_response"),
    ('{"confidence": 1} and more', "malformed_response"),
    ('{"confidence": 1}] [', "malformed_response"),
    ('{"confidence": 1}, "x"', "malformed_response"),
    ('{"confidence": 1', "malformed_response"),
    ("[1]", "malformed_response"),
    ("", "malformed_response"),
    ("I cannot help", "malformed_response"),
]


def test_parse_responses(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ANSWERS)], "i int, response_text string")
    got = {r["i"]: r for r in vp.parse_responses(df).collect()}
    assert [got[i]["status"] for i in range(len(ANSWERS))] == [s for _, s in ANSWERS]
    assert (got[0]["recommendation"], got[0]["confidence"], got[0]["reasoning"], got[0]["uncertainty_flags"]) == (R, 0.9, "r", ["x"])
    assert got[7]["uncertainty_flags"] == [] and got[7]["reasoning"] is None
    assert got[0]["response_hash"] == hashlib.sha256(ANSWERS[0][0].encode()).hexdigest()
    long = spark.createDataFrame([('{"reasoning": "' + "y" * 1500 + '"}',)], "response_text string")
    assert len(vp.parse_responses(long).collect()[0]["reasoning"]) == 1500


def test_cost_cache_and_ids(spark):
    calls = spark.createDataFrame([("s", "anthropic", "h", 1_000_000, 100_000), ("s", "google", "h", 10, 0), ("s", "other", "h", 1, 1)],
                                  "scenario_id string, provider string, prompt_hash string, input_tokens long, output_tokens long")
    cost = {r["provider"]: r["cost_usd"] for r in vp.with_cost(calls).collect()}
    assert cost == {"anthropic": pytest.approx(4.5), "google": pytest.approx(3e-6), "other": None}
    cached = spark.createDataFrame([("v1", "s", "anthropic", "h", "ok"), ("v2", "s", "google", "h", "api_error"), ("v0", "s", "other", "h2", "ok")],
                                   "verdict_id string, scenario_id string, provider string, prompt_hash string, status string")
    assert {r["provider"]: r["cached_verdict_id"] for r in vp.reuse_cached(calls, cached).collect()} == {
        "anthropic": "v1", "google": None, "other": None}
    assert {r["provider"] for r in vp.work_list(calls, cached).collect()} == {"google", "other"}
    vid = calls.select(vp.verdict_id(F.col("provider"), F.col("prompt_hash"))).first()[0]
    assert vid == "v_" + hashlib.sha256(b"anthropic:h").hexdigest()[:16]


def test_status_summary(spark):
    v = verdicts(spark, [("a", "p", R, s, 1, 0) for s in ("ok", "ok", "skipped_no_key", "api_error", "malformed_response")])
    assert tuple(vp.status_summary(v).collect()[0]) == (5, 2, 1, 2)


def test_evidence_picks_the_best_listed_track(spark):
    plays = [("hit", f"u{i % 3}", T0 - timedelta(days=1), "JP", f"s{i}") for i in range(60)]
    plays += [("quiet", "u9", T0 - timedelta(days=100), "US", "sq")]
    streams = spark.createDataFrame(plays, "track_id string, user_id string, streamed_at timestamp_ntz, stream_country_iso2 string, session_id string")
    users = spark.createDataFrame([(f"u{i}", f"h{i}") for i in range(10)], "user_id string, household_id string")
    tracks = spark.createDataFrame([("hit", "a", True, "2026-01-01"), ("quiet", "a", None, None)],
                                   "track_id string, artist_id string, ai_generated_label boolean, release_date string")
    artists = spark.createDataFrame([("a", "US")], "artist_id string, country_iso2 string")
    expected = spark.createDataFrame([("s1", "hit", 80), ("s1", "quiet", 80), ("s2", "quiet", 80), ("s3", "never played", 80)],
                                     "scenario_id string, track_id string, expected_min_score int")
    fl = sg.artificial_streaming_flags(streams, users, tracks, artists)
    ev = vp.scenario_evidence(fl, expected, tracks, artists, sg.listen_spike(streams), sg.geo_anomaly(streams, tracks, artists),
                              sg.stream_to_listener_ratio(streams), sg.repeat_listener_concentration(streams, users),
                              sg.playlist_stuffing(streams, tracks))
    got = {r["scenario_id"]: r for r in ev.collect()}
    assert set(got) == {"s1", "s2"}
    assert (got["s1"]["track_id"], got["s1"]["top_country"], got["s1"]["top_country_share_pct"], got["s1"]["total_streams"]) == ("hit", "JP", "100.0", 60)
    # outside the spike window nothing is known about a track
    q = got["s2"]
    assert (q["total_streams"], q["top_country"], q["top_country_share_pct"], q["hhi_value"], q["session_ai_share"]) == (0, "unknown", "n/a", 0.0, "n/a")
    assert (q["ai_generated_label"], q["release_date"], q["artist_country"]) == ("None", "None", "US")
    prompts = {r["scenario_id"]: r for r in vp.render_prompt(ev).collect()}
    assert "Track hit, artist country US, generated by AI: True" in prompts["s1"]["prompt"]
    assert prompts["s1"]["prompt_hash"] == hashlib.sha256(prompts["s1"]["prompt"].encode()).hexdigest()


def test_fixed_prices():
    assert VerdictConfig().prices == {"anthropic": (3.0, 15.0), "openai": (2.5, 10.0), "google": (0.3, 2.5)}
    assert VerdictConfig().budget_usd == 10.0
