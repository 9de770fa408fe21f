"""Verdict reports and the batch jobs that prepare verdicts."""

import re
from dataclasses import replace

from pyspark.sql import functions as F

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import cte, register, round_sql
from glasswatch.catalog.store import stored
from glasswatch.operators import signals, sketches, verdict_prep, verdicts
from glasswatch.config import VerdictConfig
from glasswatch.plans import verdict_job
from glasswatch.session import new_path

cte(
    "verdict_fact",
    "SELECT v.* EXCLUDE (uncertainty_flags_json, recommendation, confidence, primary_signal, reasoning), "
    "v.recommendation AS llm_recommendation, v.confidence AS llm_confidence, v.primary_signal AS llm_primary_signal, "
    "v.reasoning AS llm_reasoning, f.composite_suspicion_score AS heuristic_score, f.recommended_action AS "
    "heuristic_action, f.n_signals_fired, CASE WHEN v.recommendation IS NULL THEN NULL WHEN v.recommendation = "
    "f.recommended_action THEN 1 ELSE 0 END AS llm_agrees_with_heuristic FROM verdicts v LEFT JOIN flags f "
    "ON CAST(f.track_id AS VARCHAR) = v.track_id",
    "verdicts", "flags",
)
_FACT = dict(rounded="llm_confidence heuristic_score cost_usd", times="requested_at completed_at")
register("int_llm_verdict_aggregates", t.verdict_fact, "SELECT * FROM verdict_fact", "verdict_fact", **_FACT)
register("fct_llm_verdicts", t.verdict_fact, "SELECT * FROM verdict_fact", "verdict_fact", **_FACT)
_VOTES = ", ".join(
    f"count(*) FILTER (llm_recommendation = '{rec}') AS {name}" for name, rec in verdicts.VOTES.items()
)
cte(
    "agreement",
    "SELECT *, CASE WHEN top >= 2 THEN 1 ELSE 0 END AS two_of_three_agree, CASE WHEN n_verdicts_ok = 3 AND top = 3 THEN "
    "1 ELSE 0 END AS unanimous_agree, CASE WHEN top < 2 THEN NULL WHEN n_remove = top THEN 'recommend_remove' "
    "WHEN n_rank_lower = top THEN 'recommend_rank_lower' ELSE 'recommend_no_action' END AS plurality_recommendation, "
    "CASE WHEN top >= 2 AND top = CASE heuristic_action WHEN 'recommend_remove' THEN n_remove WHEN "
    "'recommend_rank_lower' THEN n_rank_lower WHEN 'recommend_no_action' THEN n_no_action END THEN 1 ELSE 0 END AS "
    "llm_plurality_matches_heuristic FROM (SELECT scenario_id, max(heuristic_action) AS heuristic_action, count(*) "
    "FILTER (status = 'ok') AS n_verdicts_ok, count(*) FILTER (status <> 'ok') AS n_verdicts_failed, "
    f"{_VOTES}, count(*) FILTER (llm_recommendation IS NULL) AS n_null_rec, greatest(n_remove, n_rank_lower, n_no_action) "
    "AS top FROM verdict_fact GROUP BY scenario_id)",
    "verdict_fact",
)


def agreement(s, d):
    return verdicts.agreement_rate(t.verdict_fact(s, d))


def recommended(s, d):
    """The columns of the fact that drift reads; none comes from the flags."""
    return t.staged_verdicts(s, d).withColumnRenamed("recommendation", "llm_recommendation")


register("rpt_llm_agreement_rate", agreement, "SELECT * EXCLUDE (top) FROM agreement", "agreement")
register(
    "rpt_llm_cost_breakdown", lambda s, d: verdicts.cost_breakdown(t.staged_verdicts(s, d)),
    "SELECT provider, max(model_name) AS model_name, count(*) AS n_verdicts, count(*) FILTER (status = 'ok') AS n_ok, "
    "CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens, CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens, "
    f"{round_sql('sum(cost_usd)', 5)} AS total_cost_usd, {round_sql('avg(cost_usd) FILTER (status = $$ok$$)', 5)} AS "
    "mean_cost_per_ok_verdict FROM verdict_fact GROUP BY provider",
    "verdict_fact", rounded="total_cost_usd mean_cost_per_ok_verdict",
)
register(
    "rpt_llm_latency_distribution", lambda s, d: verdicts.latency_distribution(t.staged_verdicts(s, d)),
    "SELECT provider, max(model_name) AS model_name, count(*) AS n_ok_verdicts, min(latency_ms) AS latency_ms_min, "
    "avg(latency_ms) AS latency_ms_mean, max(latency_ms) AS latency_ms_max, quantile_cont(CAST(latency_ms AS DOUBLE), 0.5) "
    "AS latency_ms_p50, quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) AS latency_ms_p95 FROM verdict_fact "
    "WHERE status = 'ok' AND latency_ms > 0 GROUP BY provider",
    "verdict_fact", rounded="latency_ms_mean latency_ms_p50 latency_ms_p95",
)


def _sketched_latency(s, d):
    """Sketches stored by two deliveries that share days, merged on read, next to the exact quantiles."""
    calls = t.staged_verdicts(s, d)
    path = new_path(s, "latency-sketches")
    early = F.coalesce(F.hour("requested_at") < 12, F.lit(True))
    for name, part in (("morning", calls.filter(early)), ("afternoon", calls.filter(~early))):
        sketches.store_delivery(sketches.latency_by_day(part), path, name)
    report = sketches.latency_ranks(sketches.latency_report(s.read.parquet(path)), calls)
    exact = verdicts.latency_distribution(calls).select(F.col("provider").alias("_p"), *sketches.QUANTILES)
    met = report.drop(*sketches.QUANTILES).join(exact, F.col("provider").eqNullSafe(F.col("_p")))
    # the error is stated for 99 of 100 sketches; twice as much is as good as never passed
    within = [(F.col(f"{q}_off") <= 2 * F.col("rank_error")).alias(f"{q}_within") for q in sketches.QUANTILES]
    return met.select("provider", "model_name", "n_ok_verdicts", "latency_ms_mean", *sketches.QUANTILES, *within)


register(
    "rpt_llm_latency_sketched", _sketched_latency,
    "SELECT provider, max(model_name) AS model_name, count(*) AS n_ok_verdicts, avg(latency_ms) AS latency_ms_mean, "
    "quantile_cont(CAST(latency_ms AS DOUBLE), 0.5) AS latency_ms_p50, quantile_cont(CAST(latency_ms AS DOUBLE), 0.95) AS "
    "latency_ms_p95, true AS latency_ms_p50_within, true AS latency_ms_p95_within FROM verdict_fact "
    "WHERE status = 'ok' AND latency_ms > 0 GROUP BY provider",
    "verdict_fact", rounded="latency_ms_mean latency_ms_p50 latency_ms_p95",
)
register(
    "rpt_llm_drift_score", lambda s, d: verdicts.drift_score(recommended(s, d)),
    "SELECT provider, max(model_name) AS model_name, count(*) FILTER (status = 'ok') AS n_ok_current_window, "
    f"{_VOTES}, CAST(NULL AS DOUBLE) AS drift_score, CAST(NULL AS TIMESTAMP) AS prior_snapshot_at, 'no_prior_snapshot' "
    "AS drift_status FROM verdict_fact GROUP BY provider",
    "verdict_fact", rounded="drift_score", times="prior_snapshot_at",
)

cte(
    "weekly",
    f"SELECT provider, CAST(date_trunc('week', requested_at) AS TIMESTAMP) AS week_start, {_VOTES} FROM verdict_fact "
    "WHERE llm_recommendation IS NOT NULL GROUP BY ALL",
    "verdict_fact",
)


def _pull(v):
    m = f"((p_{v} + q_{v}) / 2)"
    return "(" + " + ".join(f"CASE WHEN {x}_{v} > 0 THEN {x}_{v} * ln({x}_{v} / {m}) ELSE 0 END" for x in "pq") + ") / 2"


_N = "(n_remove + n_rank_lower + n_no_action)"
_SCORE = " + ".join(_pull(v) for v in verdicts.VOTES)
register(
    "llm_drift_js", lambda s, d: verdicts.drift_js(recommended(s, d), tolerance=0.0005),
    "SELECT provider, week_start, n_remove, n_rank_lower, n_no_action, drift_score, prior_snapshot_at, CASE WHEN "
    "drift_score IS NULL THEN 'no_prior_snapshot' WHEN drift_score > CAST(0.0005 AS DOUBLE) THEN 'drift_detected' ELSE "
    "'within_tolerance' END AS drift_status FROM (SELECT c.*, p.week_start AS prior_snapshot_at, CASE WHEN p.week_start "
    f"IS NOT NULL THEN {_SCORE} END AS drift_score FROM (SELECT *, "
    + ", ".join(f"CAST({v} AS DOUBLE) / {_N} AS p_{v}" for v in verdicts.VOTES)
    + " FROM weekly) c LEFT JOIN (SELECT provider, week_start, "
    + ", ".join(f"CAST({v} AS DOUBLE) / {_N} AS q_{v}" for v in verdicts.VOTES)
    + " FROM weekly) p ON p.provider = c.provider AND p.week_start = c.week_start - INTERVAL 7 DAY)",
    "weekly", rounded="drift_score", times="week_start prior_snapshot_at",
)

# --- preparation -------------------------------------------------------------------------------------------------


def evidence(s, d):
    streams, users, tracks, artists = (f(s, d) for f in (t.streams, t.users, t.tracks, t.artists))
    # a track per scenario, its plays, and those of its sessions: all plays are read twice, for these two tables
    picked = stored(s, d, "scenario_tracks", lambda s, d: verdict_prep.picked_tracks(t.flags(s, d), t.expectations(s, d), tracks))
    plays = stored(s, d, "scenario_plays", lambda s, d: verdict_prep.plays_of_tracks(streams, picked))
    sessions = stored(s, d, "scenario_sessions", lambda s, d: verdict_prep.plays_of_sessions(streams, plays))
    return verdict_prep.scenario_evidence(
        picked.drop("scenario_id").distinct(),
        picked,
        tracks,
        artists,
        signals.listen_spike(plays, t.SIGNALS),
        signals.geo_anomaly(plays, tracks, artists, t.SIGNALS),
        signals.stream_to_listener_ratio(plays, t.SIGNALS),
        signals.repeat_listener_concentration(plays, users, t.SIGNALS),
        signals.playlist_stuffing(sessions, tracks, t.SIGNALS),
    )


_PARTS = ", ".join(f"p.{n}_fires, p.{n}_severity" for n in signals.SIGNAL_COLUMNS)
cte(
    "evidence",
    "SELECT p.scenario_id, p.track_id, coalesce(CAST(a.home AS VARCHAR), 'unknown') AS artist_country, "
    "CASE WHEN t.ai THEN 'True' ELSE 'False' END AS ai_generated_label, t.release_date, "
    "coalesce(m.recent_streams + m.baseline_streams, 0) AS total_streams, "
    "CASE WHEN m.track_id IS NULL THEN 'unknown' ELSE CAST(g.top_country AS VARCHAR) END AS top_country, "
    "CASE WHEN m.track_id IS NULL THEN 'n/a' ELSE printf('%.1f', 100 * g.top_country_share) END AS top_country_share_pct, "
    f"{_PARTS}, coalesce(m.spike_ratio, 0) AS spike_ratio, "
    "CASE WHEN m.track_id IS NULL THEN 0 ELSE g.top_country_share END AS top_country_share, "
    "CASE WHEN m.track_id IS NULL THEN 0 ELSE r.streams_per_listener END AS streams_per_listener, "
    "CASE WHEN m.track_id IS NULL THEN 0 ELSE h.hhi_value END AS hhi_value, "
    "CASE WHEN m.track_id IS NULL OR s.track_id IS NULL THEN 'n/a' ELSE printf('%.2f', s.session_ai_share) END "
    "AS session_ai_share, p.composite_suspicion_score, p.recommended_action AS heuristic_action "
    "FROM (SELECT * FROM flags JOIN expectations USING (track_id) QUALIFY row_number() OVER (PARTITION BY scenario_id "
    "ORDER BY composite_suspicion_score DESC, track_id) = 1) p JOIN tracks t USING (track_id) LEFT JOIN artists a USING "
    "(artist_id) LEFT JOIN sig_spike m USING (track_id) LEFT JOIN sig_geo g USING (track_id) LEFT JOIN sig_ratio r USING "
    "(track_id) LEFT JOIN sig_hhi h USING (track_id) LEFT JOIN sig_stuffing s USING (track_id)",
    "flags", "expectations", "tracks", "artists",
)
_EVIDENCE_ROUNDED = (
    "spike_ratio top_country_share streams_per_listener hhi_value composite_suspicion_score "
    + " ".join(f"{n}_severity" for n in signals.SIGNAL_COLUMNS)
)
register("llm_scenario_evidence", evidence, "SELECT * FROM evidence", "evidence", rounded=_EVIDENCE_ROUNDED)
# the prompt shows few digits, so the two engines' last-digit differences could only matter at an exact tie
def _printf(fmt, columns):
    if not columns:
        return f"'{fmt}'"
    types = {"f": "DOUBLE", "s": "VARCHAR", "d": "BIGINT"}
    kinds = re.findall(r"%(?:\.\d)?([sdf])", fmt)
    values = [f"CAST({c} AS {types[k]})" for c, k in zip(columns, kinds, strict=True)]
    return f"printf('{fmt}', {', '.join(values)})"


_PROMPT_SQL = " || chr(10) || ".join(_printf(*line) for line in verdict_prep.PROMPT_LINES)
register(
    "llm_render_prompt",
    lambda s, d: verdict_prep.render_prompt(evidence(s, d)).select("scenario_id", "track_id", "prompt", "prompt_hash"),
    f"SELECT *, sha256(prompt) AS prompt_hash FROM (SELECT scenario_id, CAST(track_id AS BIGINT) AS track_id, "
    f"{_PROMPT_SQL} AS prompt FROM evidence)",
    "evidence",
)


def _responses(s, d):
    """Model answers written from events: good ones, fenced ones and several kinds of broken ones."""
    k = F.col("k")
    good = F.concat(
        F.lit('{"recommendation": "recommend_remove", "confidence": '),
        F.format_string("%.2f", k / 100.0),
        F.lit(', "primary_signal": "geo_anomaly", "reasoning": "r'),
        k.cast("string"),
        F.lit('", "uncertainty_flags": ["a", "b"]}'),
    )
    text = (
        F.when(k < 30, good)
        .when(k < 50, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
        .when(k < 60, F.concat(good, F.lit(" trailing words")))
        .when(k < 70, F.lit('{"recommendation": "delete it", "confidence": 0.5}'))
        .when(k < 80, F.lit('{"recommendation": null, "confidence": 1.5}'))
        .when(k < 90, F.lit('{"confidence": 0.25}'))
        .otherwise(F.lit("[1, 2]"))
    )
    return t.events(s, d).select("event_id", text.alias("response_text"))


register(
    "llm_parse_response",
    lambda s, d: verdict_prep.parse_responses(_responses(s, d)).drop("response_text", "response_hash"),
    "SELECT event_id, CASE WHEN k < 50 THEN 'recommend_remove' END AS recommendation, CASE WHEN k < 50 THEN "
    "CAST(k AS DOUBLE) / 100 WHEN k BETWEEN 80 AND 89 THEN CAST(0.25 AS DOUBLE) END AS confidence, CASE WHEN k < 50 THEN "
    "'geo_anomaly' END AS primary_signal, CASE WHEN k < 50 THEN 'r' || k WHEN k BETWEEN 80 AND 89 THEN '' END AS "
    "reasoning, CASE WHEN k < 50 THEN 'a,b' ELSE '' END AS uncertainty_flags, CASE WHEN k < 50 OR k BETWEEN 80 AND 89 "
    "THEN 'ok' ELSE 'malformed_response' END AS status FROM ev",
    "ev", rounded="confidence",
)
_PRICES = {"click": (3.00, 15.00), "view": (2.50, 10.00)}
_PRICED = VerdictConfig(prices=_PRICES, budget_usd=1.0)
cte(
    "costed",
    "SELECT verdict_id, provider, status, input_tokens, output_tokens, CASE provider "
    + " ".join(
        f"WHEN '{p}' THEN input_tokens * CAST({i} AS DOUBLE) / 1000000 + output_tokens * CAST({o} AS DOUBLE) / 1000000"
        for p, (i, o) in _PRICES.items()
    )
    + " END AS cost_usd FROM verdicts",
    "verdicts",
)
register(
    "llm_cost",
    lambda s, d: verdict_prep.with_cost(
        t.staged_verdicts(s, d).select("verdict_id", "provider", "status", "input_tokens", "output_tokens"), _PRICED
    ),
    "SELECT * FROM costed", "costed", rounded="cost_usd",
)


def _wanted(s, d):
    """A call per user and provider, with the prompt hash of the user."""
    return t.events(s, d).select(
        F.col("user_id").cast("string").alias("scenario_id"),
        F.col("event_type").alias("provider"),
        F.sha2(F.col("user_id").cast("string"), 256).alias("prompt_hash"),
    ).distinct()


cte(
    "wanted",
    "SELECT DISTINCT CAST(user_id AS VARCHAR) AS scenario_id, event_type AS provider, "
    "sha256(CAST(user_id AS VARCHAR)) AS prompt_hash FROM events",
)
register(
    "llm_cache_reuse", lambda s, d: verdict_prep.reuse_cached(_wanted(s, d), t.staged_verdicts(s, d)),
    "SELECT w.*, c.id AS cached_verdict_id, c.id IS NOT NULL AS is_cached FROM wanted w LEFT JOIN (SELECT scenario_id, "
    "provider, prompt_hash, min(verdict_id) AS id FROM verdicts WHERE status = 'ok' GROUP BY ALL) c "
    "USING (scenario_id, provider, prompt_hash)",
    "wanted", "verdicts",
)
register(
    "llm_work_list", lambda s, d: verdict_prep.work_list(_wanted(s, d), t.staged_verdicts(s, d)),
    "SELECT * FROM wanted w WHERE NOT EXISTS (FROM verdicts v WHERE status = 'ok' AND v.scenario_id = w.scenario_id AND "
    "v.provider = w.provider AND v.prompt_hash = w.prompt_hash)",
    "wanted", "verdicts",
)


def _budget(s, d):
    calls = t.events(s, d).select(
        F.col("event_id").alias("call_seq"), (F.col("k") / 1000.0).alias("cost_usd"), F.lit("ok").alias("status")
    )
    return verdict_prep.budget_gate(calls, slot_width=1000, cfg=VerdictConfig(budget_usd=100.0))


register(
    "llm_budget_gate", _budget,
    "SELECT event_id AS call_seq, CAST(k AS DOUBLE) / 1000 AS cost_usd, 'ok' AS status, CAST(before AS DOUBLE) / 1000 AS "
    "spent_before_usd, CASE WHEN before >= 100000 THEN 0 ELSE CAST(k AS DOUBLE) / 1000 END AS charged_usd, CASE WHEN "
    "before >= 100000 THEN 'skipped_no_key' ELSE 'ok' END AS gated_status, CASE WHEN before >= 100000 THEN 'budget_cap' "
    "END AS gate_reason FROM (SELECT *, sum(k) OVER (ORDER BY event_id) - k AS before FROM ev)",
    "ev", rounded="cost_usd spent_before_usd charged_usd",
)
register(
    "llm_status_summary", lambda s, d: verdict_prep.status_summary(t.staged_verdicts(s, d)),
    "SELECT count(*) AS n_verdicts, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (starts_with(status, "
    "'skipped')) AS n_skipped, count(*) FILTER (status IN ('api_error', 'malformed_response')) AS n_errored FROM verdicts",
    "verdicts",
)


# a question per user, put to two providers; the cheapest units make costs whole numbers
_JOB_MODELS = {"click": "model-click", "view": "model-view"}
_JOB = VerdictConfig(prices={p: (1_000_000.0, 1_000_000.0) for p in _JOB_MODELS}, budget_usd=500.0)
_JOB_ANSWER = '{"recommendation": "recommend_rank_lower", "confidence": 0.5, "primary_signal": "none", "reasoning": "", "uncertainty_flags": []}'


def _job_answers(up):
    """A model's stand-in. Users whose id ends in 7 get no answer while the service isn't ``up``, those whose id ends in 3 get no JSON."""

    def ask(calls):
        fails = F.col("scenario_id").endswith("7") & F.lit(not up)
        at = F.to_timestamp_ntz(F.lit("2026-01-01 00:00:00"))
        text = F.when(F.col("scenario_id").endswith("3"), "no idea").otherwise(_JOB_ANSWER)
        return calls.withColumns({
            "response_text": F.when(~fails, text), "error_class": F.when(fails, "timeout"), "latency_ms": F.lit(5),
            "input_tokens": F.when(fails, 0).otherwise(F.octet_length("prompt") - 1), "output_tokens": F.when(fails, 0).otherwise(1),
            "requested_at": at, "completed_at": at,
        })

    return ask


def _job(s, d):
    """Two runs: one with a budget while the service has gaps, one without limits afterwards."""
    user = F.col("user_id").cast("string")
    prompts = t.events(s, d).select("user_id").distinct().select(
        F.col("user_id").alias("scenario_seq"), user.alias("scenario_id"), user.alias("track_id"), F.concat(F.lit("user "), user).alias("prompt"),
        F.sha2(F.concat(F.lit("user "), user), 256).alias("prompt_hash"),
    )
    path = new_path(s, "verdict-job")
    verdict_job.run(s, path, prompts, _JOB_MODELS, _job_answers(False), 1, _JOB)
    final = verdict_job.run(s, path, prompts, _JOB_MODELS, _job_answers(True), 1, replace(_JOB, budget_usd=float("inf")))
    asked = verdict_job.read_ledger(s, path).groupBy("verdict_id").agg(F.count(F.lit(1)).alias("n_asked"), F.sum("cost_usd").alias("total_usd"))
    return final.join(asked, "verdict_id", "left").select(
        "verdict_id", "scenario_id", "provider", "model", "recommendation", "status", "error_class", "input_tokens", "cost_usd", "n_asked", "total_usd"
    )


cte(
    "job_calls",
    "SELECT scenario_id, provider, length(scenario_id) + 4 AS input_tokens, 'v_' || substr(sha256(provider || ':' || sha256('user ' || "
    "scenario_id)), 1, 16) AS verdict_id, ends_with(scenario_id, '3') AS mute, ends_with(scenario_id, '7') AS gap, CASE WHEN gap THEN 0 ELSE "
    "input_tokens + 1 END AS first_cost, coalesce(sum(first_cost) OVER (ORDER BY CAST(scenario_id AS BIGINT), provider ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 500 AS in_first FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS scenario_id FROM "
    "events), (VALUES ('click'), ('view')) p(provider)",
)
register(
    "llm_verdict_job", _job,
    "SELECT verdict_id, scenario_id, provider, 'model-' || provider AS model, CASE WHEN NOT mute THEN 'recommend_rank_lower' END AS "
    "recommendation, CASE WHEN mute THEN 'malformed_response' ELSE 'ok' END AS status, CASE WHEN mute THEN 'malformed_response' END AS "
    "error_class, CAST(input_tokens AS BIGINT) AS input_tokens, CAST(input_tokens + 1 AS DOUBLE) AS cost_usd, CAST(CASE WHEN in_first AND "
    "(mute OR gap) THEN 2 ELSE 1 END AS BIGINT) AS n_asked, CAST((input_tokens + 1) * CASE WHEN in_first AND mute THEN 2 ELSE 1 END AS DOUBLE) "
    "AS total_usd FROM job_calls",
    "job_calls", rounded="cost_usd total_usd",
)
