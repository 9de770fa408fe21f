"""Metric registry: named measures over the facts, grouped by any of the fact's dimensions.

A metric is an aggregate, optionally followed by an expression over other metrics. ``metric_query`` runs any set of
metrics of one fact as a single ``groupBy().agg()``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.functions.expressions import count_when, safe_ratio


@dataclass(frozen=True)
class SemanticModel:
    """Which columns of a fact may be grouped by, and what its metrics are."""

    time: str
    dimensions: tuple[str, ...]
    measures: dict[str, Column]
    # name -> (needed measures, expression over them after aggregation)
    derived: dict[str, tuple[tuple[str, ...], Column]] = field(default_factory=dict)

    def metrics(self) -> list[str]:
        return [*self.measures, *self.derived]


def models() -> dict[str, SemanticModel]:
    """The four semantic models. Built on call: expressions need a running session."""
    ok = F.col("status") == "ok"
    return {
        "artificial_streaming_signals": SemanticModel(
            time="built_at",
            dimensions=("recommended_action", "n_signals_fired", "built_at"),
            measures={
                "composite_suspicion_score_avg": F.avg("composite_suspicion_score"),
                "composite_suspicion_score_max": F.max("composite_suspicion_score"),
                "n_flagged_tracks": F.count("track_id"),
                "composite_suspicion_score": F.avg("composite_suspicion_score"),
            },
        ),
        "llm_verdicts": SemanticModel(
            time="requested_at",
            dimensions=("scenario_id", "provider", "llm_recommendation", "status", "heuristic_action", "requested_at"),
            measures={
                "n_verdicts": F.count("verdict_id"),
                "total_cost_usd": F.sum("cost_usd"),
                "mean_latency_ms": F.avg("latency_ms"),
                "agreement_count_with_heuristic": F.sum("llm_agrees_with_heuristic"),
                "llm_total_cost_usd": F.sum("cost_usd"),
                "llm_mean_latency_ms": F.avg(F.when(ok, F.col("latency_ms"))),
                "llm_heuristic_agreement_count": F.sum("llm_agrees_with_heuristic"),
                "two_of_three_agree_sum": F.sum("llm_agrees_with_heuristic"),
                "scenario_count": F.count("verdict_id"),
                "ok_verdict_count": count_when(ok),
                "total_verdict_count": F.count(F.lit(1)),
            },
            derived={
                "llm_verdict_agreement_rate": (
                    ("llm_heuristic_agreement_count", "total_verdict_count"),
                    safe_ratio(F.col("llm_heuristic_agreement_count"), F.col("total_verdict_count")),
                ),
                "llm_provider_uptime": (
                    ("ok_verdict_count", "total_verdict_count"),
                    safe_ratio(F.col("ok_verdict_count"), F.col("total_verdict_count")),
                ),
            },
        ),
        "dsa_decisions": SemanticModel(
            time="reporting_period_start",
            dimensions=("product_line", "reporting_period_canonical", "category_code", "reporting_period_start"),
            measures={
                "total_decisions": F.sum("total_decisions"),
                "automated_decisions": F.sum("automated_decisions"),
                "notices_received_total": F.sum("notices_received"),
                "actions_on_notice_total": F.sum("actions_on_notice_total"),
                "dsa_decisions_total": F.sum("total_decisions"),
                "dsa_automated_decisions": F.sum("automated_decisions"),
                "dsa_notices_received": F.sum("notices_received"),
            },
            derived={
                "dsa_automated_share": (
                    ("dsa_automated_decisions", "dsa_decisions_total"),
                    safe_ratio(F.col("dsa_automated_decisions"), F.col("dsa_decisions_total")),
                )
            },
        ),
        "dsa_appeals": SemanticModel(
            time="reporting_period_start",
            dimensions=("product_line", "reporting_period_canonical", "reporting_period_start"),
            measures={
                "complaints_submitted_total": F.sum("complaints_submitted"),
                "dsa_complaints_submitted": F.sum("complaints_submitted"),
            },
        ),
    }


# fixed values: time grains
GRAINS = ("day", "week", "month", "quarter", "year")


def metric_query(
    fact: DataFrame,
    model: str,
    metrics: Sequence[str],
    dims: Sequence[str] = (),
    where: Column | None = None,
    grain: str | None = None,
) -> DataFrame:
    """Metrics of one fact by dimensions. ``grain`` groups by the model's time column cut to it (``metric_time``)."""
    m = models()[model]
    unknown = [n for n in metrics if n not in m.metrics()] + [d for d in dims if d not in m.dimensions]
    if unknown:
        raise ValueError(f"{model} has no {', '.join(unknown)}")
    if grain is not None and grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}")
    needed: list[str] = []
    for name in metrics:
        needed += [n for n in (m.derived[name][0] if name in m.derived else (name,)) if n not in needed]
    keys: list[Column] = [F.col(d) for d in dims]
    if grain is not None:
        keys.append(F.date_trunc(grain, F.col(m.time)).cast("date").alias("metric_time"))
    rows = fact if where is None else fact.filter(where)
    out = rows.groupBy(*keys).agg(*[m.measures[n].alias(n) for n in needed])
    names = [*dims, *(["metric_time"] if grain is not None else [])]
    return out.select(*names, *[(m.derived[n][1] if n in m.derived else F.col(n)).alias(n) for n in metrics])


def fill_days(spine: DataFrame, daily: DataFrame, zeros: Sequence[str]) -> DataFrame:
    """A daily metric with a row for every day of the spine; the listed metrics become 0 where nothing happened."""
    joined = spine.join(daily.withColumnRenamed("metric_time", "date_day"), "date_day", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros})


def cross_product(decisions: DataFrame, appeals: DataFrame, where: Column | None = None) -> DataFrame:
    """Decision and complaint metrics per product and period.

    Both facts are added up before they meet, so complaints are not repeated for every category.
    """
    keys = ["product_line", "reporting_period_canonical"]
    left = metric_query(
        decisions,
        "dsa_decisions",
        ["dsa_decisions_total", "dsa_automated_decisions", "dsa_automated_share", "dsa_notices_received"],
        keys,
        where,
    )
    right = metric_query(appeals, "dsa_appeals", ["dsa_complaints_submitted"], keys)
    return left.join(right, keys, "left")


def detection_overview(flags: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every scored track with the number of verdicts on it and how many agree with the heuristic."""
    per_track = verdicts.groupBy("track_id").agg(
        F.count("verdict_id").alias("n_verdicts"),
        F.sum("llm_agrees_with_heuristic").alias("llm_heuristic_agreement_count"),
    )
    return flags.select("track_id", "composite_suspicion_score", "recommended_action").join(
        per_track, "track_id", "left"
    ).withColumn("n_verdicts", F.coalesce(F.col("n_verdicts"), F.lit(0)))
