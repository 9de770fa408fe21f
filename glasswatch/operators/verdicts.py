"""Model verdicts as data: comparison with the heuristic, agreement, cost, latency and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.functions.expressions import flag, ladder, sum_when
from glasswatch.functions.prefix import counted_quantiles

# fixed values: vote column -> recommendation, in the order that decides a tie
VOTES = {
    "n_remove": "recommend_remove",
    "n_rank_lower": "recommend_rank_lower",
    "n_no_action": "recommend_no_action",
}


def with_heuristic(verdicts: DataFrame, flags: DataFrame, normalize_no_action: bool = False) -> DataFrame:
    """Each verdict next to the score and action the signals gave the same track.

    The heuristic says ``no_action`` where a model says ``recommend_no_action``, so those two never agree unless
    ``normalize_no_action`` is set.
    """
    heuristic = flags.select(
        "track_id",
        F.col("composite_suspicion_score").alias("heuristic_score"),
        F.col("recommended_action").alias("heuristic_action"),
        "n_signals_fired",
    )
    # only tracks with a verdict are needed: their ids are few, so the flags of all tracks are filtered, not shuffled
    heuristic = heuristic.join(verdicts.select("track_id").distinct(), "track_id", "left_semi")
    said, found = F.col("recommendation"), F.col("heuristic_action")
    if normalize_no_action:
        found = F.when(found == "no_action", "recommend_no_action").otherwise(found)
    return verdicts.join(heuristic, "track_id", "left").select(
        "verdict_id",
        "scenario_id",
        "track_id",
        "provider",
        "model_name",
        "status",
        "error_class",
        said.alias("llm_recommendation"),
        F.col("confidence").alias("llm_confidence"),
        F.col("primary_signal").alias("llm_primary_signal"),
        F.col("reasoning").alias("llm_reasoning"),
        "heuristic_score",
        "heuristic_action",
        "n_signals_fired",
        F.when(said.isNotNull(), flag(said == found)).alias("llm_agrees_with_heuristic"),
        "requested_at",
        "completed_at",
        "latency_ms",
        "input_tokens",
        "output_tokens",
        "cost_usd",
        "prompt_hash",
        "response_hash",
    )


def _tallies() -> list[Column]:
    return [sum_when(F.col("llm_recommendation") == rec).alias(name) for name, rec in VOTES.items()]


def agreement_rate(fact: DataFrame) -> DataFrame:
    """Votes per scenario, two-of-three and unanimous agreement, and the plurality against the heuristic."""
    ok = F.col("status") == "ok"
    most = F.greatest(*VOTES)
    counted = fact.groupBy("scenario_id").agg(
        F.max("heuristic_action").alias("heuristic_action"),
        sum_when(ok).alias("n_verdicts_ok"),
        sum_when(~ok).alias("n_verdicts_failed"),
        *_tallies(),
        sum_when(F.col("llm_recommendation").isNull()).alias("n_null_rec"),
    )
    led = {rec: (F.col(name) == most) & (F.col(name) >= 2) for name, rec in VOTES.items()}
    # a tie counts as a match if any of the leading answers is the heuristic's
    matches = F.lit(False)
    for rec, leads in led.items():
        matches = matches | (leads & (F.col("heuristic_action") == rec))
    return counted.select(
        *counted.columns,
        flag(most >= 2).alias("two_of_three_agree"),
        flag((F.col("n_verdicts_ok") == 3) & (most == 3)).alias("unanimous_agree"),
        ladder([(leads, rec) for rec, leads in led.items()]).alias("plurality_recommendation"),
        flag(matches).alias("llm_plurality_matches_heuristic"),
    )


def cost_breakdown(fact: DataFrame) -> DataFrame:
    ok = F.col("status") == "ok"
    return fact.groupBy("provider").agg(
        F.max("model_name").alias("model_name"),
        F.count(F.lit(1)).alias("n_verdicts"),
        sum_when(ok).alias("n_ok"),
        F.sum("input_tokens").alias("total_input_tokens"),
        F.sum("output_tokens").alias("total_output_tokens"),
        F.round(F.sum("cost_usd"), 5).alias("total_cost_usd"),
        F.round(F.avg(F.when(ok, F.col("cost_usd"))), 5).alias("mean_cost_per_ok_verdict"),
    )


def latency_distribution(fact: DataFrame, approximate: bool = False, slot_ms: float = 1000.0) -> DataFrame:
    """Latency of successful verdicts per provider. Quantiles interpolate; ``approximate`` uses the built-in sketch."""
    base = fact.filter((F.col("status") == "ok") & (F.col("latency_ms") > 0))
    probs = {"latency_ms_p50": 0.50, "latency_ms_p95": 0.95}
    if approximate:
        return base.groupBy("provider").agg(
            F.max("model_name").alias("model_name"),
            F.count(F.lit(1)).alias("n_ok_verdicts"),
            F.min("latency_ms").alias("latency_ms_min"),
            F.avg("latency_ms").alias("latency_ms_mean"),
            F.max("latency_ms").alias("latency_ms_max"),
            *[F.percentile_approx("latency_ms", F.lit(p)).alias(name) for name, p in probs.items()],
        )
    # one pass counts the distinct latencies; everything else is read off the counts
    counts = base.groupBy("provider", "model_name", "latency_ms").agg(F.count(F.lit(1)).alias("_n"))
    exact = counted_quantiles(counts, ["provider"], "latency_ms", probs, slot_ms)
    renamed = exact.withColumnRenamed("provider", "_provider")
    stats = counts.groupBy("provider").agg(
        F.max("model_name").alias("model_name"),
        F.sum("_n").alias("n_ok_verdicts"),
        F.min("latency_ms").alias("latency_ms_min"),
        (F.sum(F.col("latency_ms") * F.col("_n")) / F.sum("_n")).alias("latency_ms_mean"),
        F.max("latency_ms").alias("latency_ms_max"),
    )
    return stats.join(renamed, stats["provider"].eqNullSafe(renamed["_provider"])).drop("_provider")


def drift_score(fact: DataFrame) -> DataFrame:
    """Recommendation counts per provider. One snapshot has nothing to be compared with, so the score is NULL."""
    return (
        fact.groupBy("provider")
        .agg(
            F.max("model_name").alias("model_name"),
            sum_when(F.col("status") == "ok").alias("n_ok_current_window"),
            *_tallies(),
        )
        .select(
            "*",
            F.lit(None).cast("double").alias("drift_score"),
            F.lit(None).cast("timestamp_ntz").alias("prior_snapshot_at"),
            F.lit("no_prior_snapshot").alias("drift_status"),
        )
    )


def drift_js(fact: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Jensen-Shannon divergence (natural log) of the recommendation shares of a provider, week against the week before.

    A week counts only if the one exactly seven days earlier has recommendations too; otherwise there is no prior
    snapshot. The window spans the weeks of one provider.
    """
    weekly = (
        fact.filter(F.col("llm_recommendation").isNotNull())
        .groupBy("provider", F.date_trunc("week", F.col("requested_at")).cast("timestamp_ntz").alias("week_start"))
        .agg(*_tallies())
    )
    n = sum((F.col(v) for v in list(VOTES)[1:]), F.col("n_remove"))
    order = Window.partitionBy("provider").orderBy("week_start")
    prior_week = F.lag("week_start").over(order)
    adjacent = prior_week == F.col("week_start") - F.expr("INTERVAL 7 DAYS")
    shares = weekly.select(
        "*",
        F.when(adjacent, prior_week).alias("prior_snapshot_at"),
        *[F.try_divide(F.col(v).cast("double"), n).alias(f"p_{v}") for v in VOTES],
    )
    for v in VOTES:
        shares = shares.withColumn(f"q_{v}", F.lag(f"p_{v}").over(order))

    def pull(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.ln(a / ((a + b) / 2))).otherwise(F.lit(0.0))

    halves = [(pull(F.col(f"p_{v}"), F.col(f"q_{v}")) + pull(F.col(f"q_{v}"), F.col(f"p_{v}"))) / 2 for v in VOTES]
    score = F.when(F.col("prior_snapshot_at").isNotNull(), sum(halves[1:], halves[0]))
    return shares.withColumn("drift_score", score).select(
        "provider",
        "week_start",
        *VOTES,
        "drift_score",
        "prior_snapshot_at",
        ladder(
            [
                (F.col("drift_score").isNull(), "no_prior_snapshot"),
                (F.col("drift_score") > tolerance, "drift_detected"),
            ],
            "within_tolerance",
        ).alias("drift_status"),
    )
