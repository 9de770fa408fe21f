"""Parameterised reads of the marts, as a service or a page would ask for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasswatch.functions.expressions import ladder, sum_when
from glasswatch.operators.quality import scenario_scores

# fixed values: metrics a time series may show
TIME_SERIES_METRICS = (
    "total_decisions",
    "automated_decisions",
    "automated_share_pct",
    "notices_received",
    "complaints_submitted",
)

# fixed values: endpoint -> table it serves
ENDPOINT_TABLES = {
    "/dsa/cross_product": "rpt_cross_product_summary",
    "/dsa/time_series": "rpt_quarter_over_quarter_trends",
    "/dsa/member_state": "rpt_member_state_breakdown",
    "/dsa/categories": "dim_dsa_categories",
}


def _of_product(df: DataFrame, product_line: str | None) -> DataFrame:
    return df if product_line is None else df.filter(F.col("product_line") == product_line)


def cross_product(summary: DataFrame, product_line: str | None = None) -> DataFrame:
    return _of_product(summary, product_line).orderBy("product_line")


def time_series(trends: DataFrame, metric: str = "total_decisions", product_line: str | None = None) -> DataFrame:
    if metric not in TIME_SERIES_METRICS:
        raise ValueError(f"metric must be one of {', '.join(sorted(TIME_SERIES_METRICS))}")
    return (
        _of_product(trends, product_line)
        .select(
            "product_line",
            "reporting_period_canonical",
            "reporting_period_start",
            "reporting_period_end",
            "period_seq",
            "n_periods_available",
            F.col(metric).alias("value"),
        )
        .orderBy("product_line", "period_seq")
    )


def member_state(breakdown: DataFrame, product_line: str | None = None) -> DataFrame:
    return _of_product(breakdown, product_line).orderBy("product_line", "member_state_id")


def categories(dim: DataFrame) -> DataFrame:
    return dim.select("category_label", "category_description", "category_code", "category_level").orderBy(
        "category_label"
    )


def citations(queries: DataFrame, publisher: str, url: str, year: int, period: str = "annual_2025") -> DataFrame:
    """Citation of every audited query: the table its endpoint serves (``unknown`` for others) and a BibTeX entry."""
    table = ladder([(F.col("endpoint") == e, t) for e, t in ENDPOINT_TABLES.items()], "unknown")
    title = F.format_string("Transparency data via %s (%s)", F.lit(publisher), F.col("model"))
    entry = F.format_string(
        "@misc{%s_%s, author={%s}, title={%s}, year={%d}, howpublished={\\url{%s}}}",
        F.lit(period), F.col("model"), F.lit(publisher), title, F.lit(year), F.lit(url),
    )
    return (
        queries.select("query_id", "key_id", "endpoint", F.col("requested_at").alias("queried_at"))
        .withColumn("model", table)
        .withColumn("suggested_bibtex", entry)
    )


def citation(queries: DataFrame, query_id: str, key_id: str, publisher: str, url: str, year: int) -> DataFrame:
    """The citation of one query, if it belongs to the caller."""
    mine = queries.filter((F.col("query_id") == query_id) & (F.col("key_id") == key_id)).limit(1)
    return citations(mine, publisher, url, year)


def my_queries(log: DataFrame, key_id: str, limit: int = 50) -> DataFrame:
    """A caller's own requests, newest first."""
    return (
        log.filter(F.col("key_id") == key_id)
        .select("query_id", "endpoint", "requested_at", "response_status_code", "latency_ms")
        .orderBy(F.desc("requested_at"), "query_id")
        .limit(limit)
    )


def top_flagged(flags: DataFrame, expectations: DataFrame, scenario_id: str, limit: int = 10) -> DataFrame:
    """The tracks of one scenario with the highest scores."""
    expected = expectations.filter(F.col("scenario_id") == scenario_id).select("track_id")
    return (
        flags.join(expected, "track_id")
        .select(
            "track_id",
            "listen_spike_fires",
            "geo_anomaly_fires",
            "s2l_ratio_fires",
            "repeat_listener_fires",
            "playlist_stuffing_fires",
            "n_signals_fired",
            "composite_suspicion_score",
            "recommended_action",
        )
        .orderBy(F.desc("composite_suspicion_score"), "track_id")
        .limit(limit)
    )


def scenario_summaries(expectations: DataFrame, flags: DataFrame) -> DataFrame:
    return (
        scenario_scores(expectations, flags)
        .groupBy("scenario_id")
        .agg(
            F.min("expected_min_score").alias("expected_min"),
            F.countDistinct("track_id").alias("n_tracks"),
            F.round(F.max("score"), 1).alias("max_score"),
            F.round(F.avg("score"), 1).alias("avg_score"),
        )
        .orderBy("scenario_id")
    )


def verdicts_for_scenario(fact: DataFrame, scenario_id: str) -> DataFrame:
    return (
        fact.filter(F.col("scenario_id") == scenario_id)
        .select(
            "verdict_id", "scenario_id", "track_id", "provider", "model_name", "status", "llm_recommendation",
            "llm_confidence", "llm_primary_signal", "llm_reasoning", "latency_ms", "cost_usd", "heuristic_action",
            "llm_agrees_with_heuristic",
        )
        .orderBy("provider")
    )


def agreement_rates(report: DataFrame) -> DataFrame:
    return report.select(
        "scenario_id", "heuristic_action", "n_verdicts_ok", "n_remove", "n_rank_lower", "n_no_action",
        "two_of_three_agree", "unanimous_agree", "plurality_recommendation",
    ).orderBy("scenario_id")


def automation_posture(report: DataFrame) -> DataFrame:
    return report.select(
        "product_line", "automated_share_pct", "automated_accuracy_pct", "automated_precision_pct",
        "automated_recall_pct", "automation_posture",
    ).orderBy("product_line")


def home_stats(notices: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row: notice rows, verdicts and successful verdicts."""
    n = notices.agg(F.count(F.lit(1)).alias("n_notice_rows"))
    v = verdicts.agg(
        F.count(F.lit(1)).alias("n_verdicts"), sum_when(F.col("status") == "ok").alias("n_verdicts_ok")
    )
    both = n.unionByName(v, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def agreement_callout(report: DataFrame) -> DataFrame:
    """One row: scenarios, how many have two-of-three and unanimous agreement, and the first as a whole percentage."""
    two, n = F.col("n_two_of_three"), F.col("n_scenarios")
    return report.agg(
        F.count(F.lit(1)).alias("n_scenarios"),
        sum_when(F.col("two_of_three_agree") == 1).alias("n_two_of_three"),
        sum_when(F.col("unanimous_agree") == 1).alias("n_unanimous"),
    ).withColumn("two_of_three_pct", F.round(F.try_divide(100.0 * two, n), 0))


def consensus_labels(report: DataFrame) -> DataFrame:
    return report.select(
        "scenario_id",
        ladder(
            [(F.col("unanimous_agree") == 1, "3 of 3 agree"), (F.col("two_of_three_agree") == 1, "2 of 3 agree")],
            "No majority",
        ).alias("consensus"),
    )


def posture_gap(report: DataFrame) -> DataFrame:
    """Accuracy minus recall in percentage points; a missing value counts as 0."""
    accuracy = F.coalesce(F.col("automated_accuracy_pct"), F.lit(0.0))
    recall = F.coalesce(F.col("automated_recall_pct"), F.lit(0.0))
    return report.select(
        "product_line", "reporting_period_canonical", F.round(accuracy - recall, 1).alias("accuracy_over_recall_pp")
    )
