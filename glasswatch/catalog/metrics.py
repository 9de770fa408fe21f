"""Metric layer."""

from pyspark.sql import functions as F

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import register
from glasswatch.plans.metrics import cross_product, detection_overview, fill_days, metric_query
from glasswatch.sources.readers import date_spine


def _spine(s, d):
    """The days with orders, from the first to the last."""
    return date_spine(
        t.table(s, d, "orders").agg(
            F.min("o_orderdate").alias("start"), F.date_add(F.max("o_orderdate").cast("date"), 1).alias("end")
        )
    )


_SPINE_SQL = (
    "SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date_day "
    "FROM orders"
)
register("metricflow_time_spine", _spine, _SPINE_SQL, dates="date_day")

register(
    "sem_artificial_streaming_signals",
    lambda s, d: metric_query(
        t.flags(s, d),
        "artificial_streaming_signals",
        ["composite_suspicion_score_avg", "composite_suspicion_score_max", "n_flagged_tracks"],
        ["recommended_action", "n_signals_fired"],
        grain="day",
    ),
    "SELECT recommended_action, n_signals_fired, CAST(built_at AS DATE) AS metric_time, avg(composite_suspicion_score) AS "
    "composite_suspicion_score_avg, max(composite_suspicion_score) AS composite_suspicion_score_max, count(track_id) AS "
    "n_flagged_tracks FROM flags GROUP BY ALL",
    "flags", dates="metric_time", rounded="composite_suspicion_score_avg composite_suspicion_score_max",
)
register(
    "sem_llm_verdicts",
    lambda s, d: metric_query(
        t.verdict_fact(s, d),
        "llm_verdicts",
        ["n_verdicts", "total_cost_usd", "mean_latency_ms", "agreement_count_with_heuristic"],
        ["provider", "llm_recommendation", "heuristic_action"],
    ),
    "SELECT provider, llm_recommendation, heuristic_action, count(verdict_id) AS n_verdicts, sum(cost_usd) AS "
    "total_cost_usd, avg(latency_ms) AS mean_latency_ms, CAST(sum(llm_agrees_with_heuristic) AS BIGINT) AS "
    "agreement_count_with_heuristic FROM verdict_fact GROUP BY ALL",
    "verdict_fact", rounded="total_cost_usd mean_latency_ms",
)
register(
    "sem_dsa_decisions",
    lambda s, d: metric_query(
        t.decisions(s, d),
        "dsa_decisions",
        ["total_decisions", "automated_decisions", "notices_received_total", "actions_on_notice_total"],
        ["product_line", "category_code"],
    ),
    "SELECT product_line, category_code, CAST(sum(total_decisions) AS BIGINT) AS total_decisions, "
    "CAST(sum(automated_decisions) AS BIGINT) AS automated_decisions, CAST(sum(notices_received) AS BIGINT) AS "
    "notices_received_total, CAST(sum(actions_on_notice_total) AS BIGINT) AS actions_on_notice_total FROM decisions "
    "GROUP BY ALL",
    "decisions",
)
register(
    "sem_dsa_appeals",
    lambda s, d: metric_query(t.appeals_fact(s, d), "dsa_appeals", ["complaints_submitted_total"], ["product_line"]),
    "SELECT product_line, sum(complaints_submitted) AS complaints_submitted_total FROM appeals GROUP BY ALL",
    "appeals", rounded="complaints_submitted_total",
)


def _no_total():
    return F.col("category_code") != "TOTAL"


_SIMPLE = (
    "llm_total_cost_usd", "llm_mean_latency_ms", "llm_heuristic_agreement_count", "two_of_three_agree_sum",
    "scenario_count", "ok_verdict_count", "total_verdict_count",
)
register(
    "metric_simple",
    lambda s, d: metric_query(t.verdict_fact(s, d), "llm_verdicts", _SIMPLE, ["provider"]),
    "SELECT provider, sum(cost_usd) AS llm_total_cost_usd, avg(latency_ms) FILTER (status = 'ok') AS llm_mean_latency_ms, "
    "CAST(sum(llm_agrees_with_heuristic) AS BIGINT) AS llm_heuristic_agreement_count, "
    "CAST(sum(llm_agrees_with_heuristic) AS BIGINT) AS two_of_three_agree_sum, count(verdict_id) AS scenario_count, "
    "count(*) FILTER (status = 'ok') AS ok_verdict_count, count(*) AS total_verdict_count FROM verdict_fact GROUP BY ALL",
    "verdict_fact", rounded="llm_total_cost_usd llm_mean_latency_ms",
)
register(
    "metric_simple_composite_score",
    lambda s, d: metric_query(
        t.flags(s, d), "artificial_streaming_signals", ["composite_suspicion_score"], ["recommended_action"]
    ),
    "SELECT recommended_action, avg(composite_suspicion_score) AS composite_suspicion_score FROM flags GROUP BY ALL",
    "flags", rounded="composite_suspicion_score",
)
register(
    "metric_simple_dsa",
    lambda s, d: metric_query(
        t.decisions(s, d),
        "dsa_decisions",
        ["dsa_decisions_total", "dsa_automated_decisions", "dsa_notices_received"],
        ["reporting_period_canonical"],
        _no_total(),
    ),
    "SELECT reporting_period_canonical, CAST(sum(total_decisions) AS BIGINT) AS dsa_decisions_total, "
    "CAST(sum(automated_decisions) AS BIGINT) AS dsa_automated_decisions, CAST(sum(notices_received) AS BIGINT) AS "
    "dsa_notices_received FROM decisions WHERE category_code <> 'TOTAL' GROUP BY ALL",
    "decisions",
)
register(
    "metric_simple_complaints",
    lambda s, d: metric_query(
        t.appeals_fact(s, d), "dsa_appeals", ["dsa_complaints_submitted"], ["reporting_period_canonical"]
    ),
    "SELECT reporting_period_canonical, sum(complaints_submitted) AS dsa_complaints_submitted FROM appeals GROUP BY ALL",
    "appeals", rounded="dsa_complaints_submitted",
)
register(
    "metric_ratio",
    lambda s, d: metric_query(t.decisions(s, d), "dsa_decisions", ["dsa_automated_share"], ["product_line"], _no_total()),
    "SELECT product_line, CAST(sum(automated_decisions) AS DOUBLE) / nullif(sum(total_decisions), 0) AS "
    "dsa_automated_share FROM decisions WHERE category_code <> 'TOTAL' GROUP BY ALL",
    "decisions", rounded="dsa_automated_share",
)
register(
    "metric_derived",
    lambda s, d: metric_query(
        t.verdict_fact(s, d), "llm_verdicts", ["llm_verdict_agreement_rate", "llm_provider_uptime"], ["provider"]
    ),
    "SELECT provider, CAST(sum(llm_agrees_with_heuristic) AS DOUBLE) / count(*) AS llm_verdict_agreement_rate, "
    "CAST(count(*) FILTER (status = 'ok') AS DOUBLE) / count(*) AS llm_provider_uptime FROM verdict_fact GROUP BY ALL",
    "verdict_fact", rounded="llm_verdict_agreement_rate llm_provider_uptime",
)
register(
    "metric_filtered_measure",
    lambda s, d: metric_query(t.verdict_fact(s, d), "llm_verdicts", ["llm_mean_latency_ms", "mean_latency_ms"], ["scenario_id"]),
    "SELECT scenario_id, avg(latency_ms) FILTER (status = 'ok') AS llm_mean_latency_ms, avg(latency_ms) AS mean_latency_ms "
    "FROM verdict_fact GROUP BY ALL",
    "verdict_fact", rounded="llm_mean_latency_ms mean_latency_ms",
)


def _grains(s, d):
    """The same metric at all five grains."""
    fact, out = t.staged_verdicts(s, d).withColumnRenamed("recommendation", "llm_recommendation"), None
    for grain in ("day", "week", "month", "quarter", "year"):
        one = metric_query(fact, "llm_verdicts", ["n_verdicts"], grain=grain).withColumn("grain", F.lit(grain))
        out = one if out is None else out.unionByName(one)
    return out


register(
    "metric_time_grain", _grains,
    " UNION ALL ".join(
        f"SELECT CAST(date_trunc('{g}', requested_at) AS DATE) AS metric_time, count(verdict_id) AS n_verdicts, '{g}' AS "
        "grain FROM verdicts GROUP BY ALL"
        for g in ("day", "week", "month", "quarter", "year")
    ),
    "verdicts", dates="metric_time",
)


def _filled(s, d):
    """Verdicts per day of one year of days, most of them empty."""
    bounds = t.table(s, d, "events").agg(
        F.date_trunc("year", F.min("ts")).alias("start"),
        F.date_add(F.date_trunc("year", F.max("ts")).cast("date"), 366).alias("end"),
    )
    daily = metric_query(
        t.staged_verdicts(s, d), "llm_verdicts", ["n_verdicts", "total_cost_usd"], grain="day"
    )
    return fill_days(date_spine(bounds), daily, ["n_verdicts"])


register(
    "metric_spine_fill", _filled,
    "SELECT s.date_day, coalesce(n_verdicts, 0) AS n_verdicts, total_cost_usd FROM (SELECT CAST(unnest(generate_series("
    "date_trunc('year', min(ts)), date_trunc('year', max(ts)) + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day "
    "FROM events) s LEFT JOIN (SELECT CAST(requested_at AS DATE) AS date_day, count(*) AS n_verdicts, sum(cost_usd) AS "
    "total_cost_usd FROM verdicts GROUP BY ALL) USING (date_day)",
    "verdicts", dates="date_day", rounded="total_cost_usd",
)
register(
    "explore_cross_product",
    lambda s, d: cross_product(t.decisions(s, d), t.appeals_fact(s, d), _no_total()),
    "SELECT *, CAST(dsa_automated_decisions AS DOUBLE) / nullif(dsa_decisions_total, 0) AS dsa_automated_share FROM "
    "(SELECT product_line, reporting_period_canonical, CAST(sum(total_decisions) AS BIGINT) AS dsa_decisions_total, "
    "CAST(sum(automated_decisions) AS BIGINT) AS dsa_automated_decisions, CAST(sum(notices_received) AS BIGINT) AS "
    "dsa_notices_received FROM decisions WHERE category_code <> 'TOTAL' GROUP BY ALL) LEFT JOIN (SELECT product_line, "
    "reporting_period_canonical, sum(complaints_submitted) AS dsa_complaints_submitted FROM appeals GROUP BY ALL) "
    "USING (product_line, reporting_period_canonical)",
    "decisions", "appeals", rounded="dsa_automated_share dsa_complaints_submitted",
)


def _overview(s, d):
    fact = t.verdict_fact(s, d)
    scored = t.flags(s, d).withColumn("track_id", F.col("track_id").cast("string"))
    return detection_overview(scored, fact)


register(
    "explore_detection_lab", _overview,
    "SELECT CAST(f.track_id AS VARCHAR) AS track_id, composite_suspicion_score, recommended_action, coalesce(n, 0) AS "
    "n_verdicts, a AS llm_heuristic_agreement_count FROM flags f LEFT JOIN (SELECT track_id, count(*) AS n, "
    "CAST(sum(llm_agrees_with_heuristic) AS BIGINT) AS a FROM verdict_fact GROUP BY ALL) v "
    "ON v.track_id = CAST(f.track_id AS VARCHAR)",
    "flags", "verdict_fact", rounded="composite_suspicion_score",
)
