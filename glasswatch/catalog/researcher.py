"""Researcher access and the parameterised reads."""

from pyspark.sql import functions as F

from glasswatch.catalog import tables as t
from glasswatch.catalog import transparency as trc
from glasswatch.catalog import verdicts as vc
from glasswatch.catalog.registry import cte, register, round_sql
from glasswatch.config import RateLimit
from glasswatch.operators import attempts
from glasswatch.operators import researcher as rs
from glasswatch.operators import sketches
from glasswatch.operators import transparency as tr
from glasswatch.plans import serving
from glasswatch.session import new_path


def _dim(s, d):
    return rs.dim_keys(t.keys(s, d), F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")))


def _fact(s, d):
    return rs.fct_queries(t.requests(s, d), _dim(s, d))


cte(
    "active_keys",
    "SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS dim_built_at FROM keys WHERE coalesce(status, 'active') = 'active'",
    "keys",
)
cte(
    "request_fact",
    "SELECT r.*, k.researcher_name, k.institution, CAST(r.requested_at AS DATE) AS query_date, "
    "CAST(hour(r.requested_at) AS INTEGER) AS query_hour_utc, CASE WHEN response_status_code BETWEEN 200 AND 299 THEN "
    "'success' WHEN response_status_code = 429 THEN 'rate_limited' WHEN response_status_code BETWEEN 400 AND 499 THEN "
    "'client_error' WHEN response_status_code BETWEEN 500 AND 599 THEN 'server_error' ELSE 'other' END AS outcome_class "
    "FROM requests r LEFT JOIN active_keys k USING (key_id)",
    "requests", "active_keys",
)
register("dim_researcher_keys", _dim, "SELECT * FROM active_keys", "active_keys", times="created_at dim_built_at")
register(
    "fct_researcher_queries", _fact, "SELECT * FROM request_fact", "request_fact", dates="query_date",
    times="requested_at",
)
_OUTCOMES = ("success", "rate_limited", "client_error", "server_error")
register(
    "rpt_researcher_query_audit", lambda s, d: rs.query_audit(_fact(s, d)),
    "SELECT key_id, researcher_name, institution, query_date, count(*) AS n_queries, "
    + ", ".join(f"count(*) FILTER (outcome_class = '{o}') AS n_{o}" for o in _OUTCOMES)
    + f", {round_sql('avg(latency_ms)', 1)} AS mean_latency_ms, CAST(sum(response_size_bytes) AS BIGINT) AS "
    "total_response_bytes, count(DISTINCT endpoint) AS distinct_endpoints_hit FROM request_fact GROUP BY ALL",
    "request_fact", dates="query_date", rounded="mean_latency_ms",
)


def _sketched_keys(s, d):
    """Keys and addresses per endpoint from stored days, with the exact counts next to them."""
    log = t.requests(s, d)
    exact = log.groupBy("endpoint").agg(F.countDistinct("key_id").alias("n_keys"))
    path = new_path(s, "key-sketches")
    sketches.store_delivery(sketches.distinct_by_day(log, ["endpoint"], "key_id", "requested_at"), path, "log")
    found = sketches.distinct_report(s.read.parquet(path), ["endpoint"], "estimate")
    met = exact.join(found.withColumnRenamed("endpoint", "_e"), F.col("endpoint").eqNullSafe(F.col("_e")), "left")
    # five standard errors; none at all up to the size of a sketch
    within = F.abs(F.col("estimate") - F.col("n_keys")) <= 5 * F.col("relative_error") * F.col("n_keys")
    return met.select("endpoint", F.col("n").alias("n_queries"), "n_keys", within.alias("keys_within"))


register(
    "rpt_researcher_keys_sketched", _sketched_keys,
    "SELECT endpoint, count(*) AS n_queries, count(DISTINCT key_id) AS n_keys, true AS keys_within FROM requests GROUP BY endpoint", "requests",
)
register(
    "rate_limit_decision",
    lambda s, d: rs.rate_limit_decision(
        t.requests(s, d).select("query_id", "key_id", "requested_at"), RateLimit(requests=1)
    ),
    "SELECT query_id, key_id, requested_at, n - 1 AS n_recent, n - 1 >= 1 AS is_rejected FROM (SELECT *, count(*) OVER "
    "(PARTITION BY key_id ORDER BY requested_at RANGE BETWEEN INTERVAL 15 MINUTE PRECEDING AND CURRENT ROW) AS n "
    "FROM requests)",
    "requests", times="requested_at",
)
#: wide enough for rejections among the given events
ATTEMPTS = RateLimit(requests=3, minutes=24 * 60)
ATTEMPTS_SQL = f"""SELECT * FROM (WITH RECURSIVE numbered AS (
    SELECT *, row_number() OVER (PARTITION BY key_id ORDER BY requested_at, query_id) AS i FROM requests
), run AS (
    SELECT query_id, key_id, requested_at, i, CAST(0 AS BIGINT) AS n_recent, [requested_at] AS held FROM numbered WHERE i = 1
    UNION ALL
    SELECT query_id, key_id, requested_at, i, CAST(len(kept) AS BIGINT),
        CASE WHEN len(kept) < {ATTEMPTS.requests} THEN list_append(kept, requested_at) ELSE kept END
    FROM (SELECT n.*, list_filter(r.held, lambda x: x >= n.requested_at - INTERVAL {ATTEMPTS.minutes} MINUTE) AS kept
        FROM run r JOIN numbered n ON n.key_id IS NOT DISTINCT FROM r.key_id AND n.i = r.i + 1)
)
SELECT query_id, key_id, requested_at, n_recent, n_recent >= {ATTEMPTS.requests} AS is_rejected FROM run)"""
register(
    "rate_limit_attempts",
    lambda s, d: attempts.decided(t.requests(s, d).select("query_id", "key_id", "requested_at"), ATTEMPTS),
    ATTEMPTS_SQL, "requests", times="requested_at",
)
register(
    "serve_key_check",
    lambda s, d: rs.key_check(t.requests(s, d).select("query_id", "key_id"), t.keys(s, d)),
    "SELECT r.query_id, r.key_id, k.status AS key_status, k.researcher_name, CASE WHEN k.key_id IS NULL THEN "
    "'unknown_key' WHEN coalesce(k.status, 'active') = 'active' THEN 'accepted' ELSE 'forbidden' END AS decision "
    "FROM requests r LEFT JOIN keys k USING (key_id)",
    "requests", "keys",
)

# --- reads -------------------------------------------------------------------------------------------------------

register(
    "serve_cross_product", lambda s, d: serving.cross_product(t.summary(s, d), "BUILDING"),
    "SELECT * FROM summary WHERE product_line = 'BUILDING' ORDER BY product_line", "summary",
    dates=trc._DATES, rounded=trc._SUMMARY_ROUNDED,
)
register(
    "serve_time_series",
    lambda s, d: serving.time_series(tr.period_trends(t.summary(s, d)), "automated_share_pct"),
    "SELECT product_line, reporting_period_canonical, reporting_period_start, reporting_period_end, period_seq, "
    "n_periods_available, automated_share_pct AS value FROM trends ORDER BY product_line, period_seq",
    "trends", dates=trc._DATES, rounded="value",
)
register(
    "serve_member_state", lambda s, d: serving.member_state(trc.breakdown(s, d)),
    "SELECT * FROM breakdown ORDER BY product_line, member_state_id", "breakdown", rounded=trc._BREAKDOWN_ROUNDED,
)
register(
    "serve_categories", lambda s, d: serving.categories(t.categories_dim(s, d)),
    "SELECT category_label, category_description, category_code, category_level FROM categories_dim "
    "ORDER BY category_label",
    "categories_dim",
)
_PUBLISHER, _URL = "Sample", "https://example.org/data"
register(
    "serve_citation", lambda s, d: serving.citations(t.requests(s, d), _PUBLISHER, _URL, 2026),
    "SELECT *, '@misc{annual_2025_' || model || ', author={Sample}, title={Transparency data via Sample (' || model || "
    "')}, year={2026}, howpublished={\\url{https://example.org/data}}}' AS suggested_bibtex FROM (SELECT query_id, key_id, "
    "endpoint, requested_at AS queried_at, CASE endpoint WHEN '/dsa/cross_product' THEN 'rpt_cross_product_summary' WHEN "
    "'/dsa/time_series' THEN 'rpt_quarter_over_quarter_trends' WHEN '/dsa/member_state' THEN 'rpt_member_state_breakdown' "
    "WHEN '/dsa/categories' THEN 'dim_dsa_categories' ELSE 'unknown' END AS model FROM requests)",
    "requests", times="queried_at",
)


def _one_citation(s, d):
    """The citation of the request with the smallest id, asked for by its own key."""
    log = t.requests(s, d)
    asked = log.agg(F.min(F.struct("query_id", "key_id")).alias("x")).select("x.*").first()
    return serving.citation(log, asked["query_id"], asked["key_id"], _PUBLISHER, _URL, 2026)


register(
    "serve_citation_lookup", _one_citation,
    "SELECT query_id, key_id, endpoint, ts AS queried_at, model, '@misc{annual_2025_' || model || ', author={Sample}, "
    "title={Transparency data via Sample (' || model || ')}, year={2026}, howpublished={\\url{https://example.org/data}}}' AS "
    "suggested_bibtex FROM (SELECT query_id, key_id, endpoint, requested_at AS ts, CASE endpoint WHEN '/dsa/cross_product' "
    "THEN 'rpt_cross_product_summary' WHEN '/dsa/time_series' THEN 'rpt_quarter_over_quarter_trends' WHEN "
    "'/dsa/member_state' THEN 'rpt_member_state_breakdown' WHEN '/dsa/categories' THEN 'dim_dsa_categories' ELSE 'unknown' "
    "END AS model FROM requests ORDER BY query_id, key_id LIMIT 1)",
    "requests", times="queried_at",
)
register(
    "serve_my_queries", lambda s, d: serving.my_queries(t.requests(s, d), "rk_7", 1000),
    "SELECT query_id, endpoint, requested_at, response_status_code, latency_ms FROM requests WHERE key_id = 'rk_7' "
    "ORDER BY requested_at DESC, query_id LIMIT 1000",
    "requests", times="requested_at",
)
register(
    "serve_top_flagged",
    lambda s, d: serving.top_flagged(t.flags(s, d), t.expectations(s, d), "Brand#11"),
    "SELECT track_id, listen_spike_fires, geo_anomaly_fires, s2l_ratio_fires, repeat_listener_fires, "
    "playlist_stuffing_fires, n_signals_fired, composite_suspicion_score, recommended_action FROM flags "
    "JOIN expectations USING (track_id) WHERE scenario_id = 'Brand#11' ORDER BY round(composite_suspicion_score, 8) DESC, "
    "track_id LIMIT 10",
    "flags", "expectations", rounded="composite_suspicion_score",
)
cte(
    "scenario_scores",
    "SELECT e.*, coalesce(f.composite_suspicion_score, 0) AS score FROM expectations e LEFT JOIN flags f USING (track_id)",
    "expectations", "flags",
)
register(
    "serve_scenario_summaries", lambda s, d: serving.scenario_summaries(t.expectations(s, d), t.flags(s, d)),
    "SELECT scenario_id, min(expected_min_score) AS expected_min, count(DISTINCT track_id) AS n_tracks, "
    f"{round_sql('max(score)', 1)} AS max_score, {round_sql('avg(score)', 1)} AS avg_score FROM scenario_scores "
    "GROUP BY scenario_id",
    "scenario_scores", rounded="max_score avg_score",
)
register(
    "serve_verdicts_for_scenario", lambda s, d: serving.verdicts_for_scenario(t.verdict_fact(s, d), "3"),
    "SELECT verdict_id, scenario_id, track_id, provider, model_name, status, llm_recommendation, llm_confidence, "
    "llm_primary_signal, llm_reasoning, latency_ms, cost_usd, heuristic_action, llm_agrees_with_heuristic "
    "FROM verdict_fact WHERE scenario_id = '3' ORDER BY provider",
    "verdict_fact", rounded="llm_confidence cost_usd",
)
register(
    "serve_agreement_rates", lambda s, d: serving.agreement_rates(vc.agreement(s, d)),
    "SELECT scenario_id, heuristic_action, n_verdicts_ok, n_remove, n_rank_lower, n_no_action, two_of_three_agree, "
    "unanimous_agree, plurality_recommendation FROM agreement ORDER BY scenario_id",
    "agreement",
)
register(
    "serve_automation_posture", lambda s, d: serving.automation_posture(tr.automated_vs_human(t.summary(s, d))),
    "SELECT product_line, automated_share_pct, automated_accuracy_pct, automated_precision_pct, automated_recall_pct, "
    "automation_posture FROM posture ORDER BY product_line",
    "posture", rounded="automated_share_pct automated_accuracy_pct automated_precision_pct automated_recall_pct",
)
register(
    "serve_home_stats",
    lambda s, d: serving.home_stats(t.staged(s, d, "notices"), t.staged_verdicts(s, d)),
    "SELECT (SELECT count(*) FROM notices) AS n_notice_rows, count(*) AS n_verdicts, count(*) FILTER (status = 'ok') AS "
    "n_verdicts_ok FROM verdicts",
    "notices", "verdicts",
)
register(
    "serve_agreement_callout", lambda s, d: serving.agreement_callout(vc.agreement(s, d)),
    "SELECT count(*) AS n_scenarios, count(*) FILTER (two_of_three_agree = 1) AS n_two_of_three, count(*) FILTER "
    "(unanimous_agree = 1) AS n_unanimous, round(CAST(100 AS DOUBLE) * count(*) FILTER (two_of_three_agree = 1) / count(*), "
    "0) AS two_of_three_pct FROM agreement",
    "agreement", rounded="two_of_three_pct",
)
register(
    "serve_consensus_labels", lambda s, d: serving.consensus_labels(vc.agreement(s, d)),
    "SELECT scenario_id, CASE WHEN unanimous_agree = 1 THEN '3 of 3 agree' WHEN two_of_three_agree = 1 THEN '2 of 3 agree' "
    "ELSE 'No majority' END AS consensus FROM agreement",
    "agreement",
)
register(
    "serve_posture_gap", lambda s, d: serving.posture_gap(tr.automated_vs_human(t.summary(s, d))),
    "SELECT product_line, reporting_period_canonical, "
    "round(coalesce(automated_accuracy_pct, 0) - coalesce(automated_recall_pct, 0), 1) AS accuracy_over_recall_pp "
    "FROM posture",
    "posture", rounded="accuracy_over_recall_pp",
)
