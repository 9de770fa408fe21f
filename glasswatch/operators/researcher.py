"""Researcher access: active keys, the request log, daily audit and the rate limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.config import RateLimit
from glasswatch.functions.expressions import ladder, sum_when
from glasswatch.functions.joins import join_null_safe, spread_join
from glasswatch.functions.prefix import running_total


def outcome_class(code: Column) -> Column:
    """Class of an HTTP status code; 429 is tested before the other 4xx."""
    return ladder(
        [
            (code.between(200, 299), "success"),
            (code == 429, "rate_limited"),
            (code.between(400, 499), "client_error"),
            (code.between(500, 599), "server_error"),
        ],
        "other",
    )


def dim_keys(keys: DataFrame, built_at: Column | None = None) -> DataFrame:
    """Keys that may be used: active ones and those from before keys had a status."""
    stamp = F.current_timestamp() if built_at is None else built_at
    return keys.filter((F.col("status") == "active") | F.col("status").isNull()).withColumn("dim_built_at", stamp)


def fct_queries(queries: DataFrame, active_keys: DataFrame) -> DataFrame:
    """The request log with the researcher behind the key (NULL for a revoked key), day, hour and outcome."""
    who = active_keys.select("key_id", "researcher_name", "institution")
    return queries.join(who, "key_id", "left").select(
        "query_id",
        "key_id",
        "researcher_name",
        "institution",
        "endpoint",
        "query_params_json",
        "response_size_bytes",
        "response_status_code",
        "latency_ms",
        "requested_at",
        "client_ip_hash",
        F.to_date("requested_at").alias("query_date"),
        F.hour("requested_at").alias("query_hour_utc"),
        outcome_class(F.col("response_status_code")).alias("outcome_class"),
    )


def query_audit(fact: DataFrame) -> DataFrame:
    """Calls, outcomes, mean latency and volume per researcher key and day."""
    outcomes = ("success", "rate_limited", "client_error", "server_error")
    return fact.groupBy("key_id", "researcher_name", "institution", "query_date").agg(
        F.count(F.lit(1)).alias("n_queries"),
        *[sum_when(F.col("outcome_class") == o).alias(f"n_{o}") for o in outcomes],
        F.round(F.avg("latency_ms"), 1).alias("mean_latency_ms"),
        F.sum("response_size_bytes").alias("total_response_bytes"),
        F.countDistinct("endpoint").alias("distinct_endpoints_hit"),
    )


def rate_limit_decision(log: DataFrame, limit: RateLimit = RateLimit(), slot_seconds: float = 60) -> DataFrame:
    """For every request: how many others the key made in the trailing window (both ends included), and whether the
    limit was reached.

    A request adds one to the count of its key at its own time and takes it back just after the window ends, so the
    count at any moment is a running total of these steps. Steps at one moment are merged first and the total is taken
    slot by slot: a key with a third of all requests is spread over its time slots, and no frame is re-summed per row.
    Slots are narrower than the window: one slot of the busiest key has to fit a task, so set ``slot_seconds`` by its rate.
    Totals of slots are themselves added up 1,000 at a time, so narrow slots don't pile up in one task either.
    Exact over a log of admitted requests.
    """
    window = limit.minutes * 60 * 1_000_000
    timed = log.withColumn("_at", F.unix_micros(F.col("requested_at").cast("timestamp")))
    steps = (
        timed.groupBy("key_id", "_at")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "key_id",
            F.explode(
                F.array(
                    F.struct(F.col("_at").alias("at"), F.col("n").alias("step")),
                    F.struct((F.col("_at") + window + 1).alias("at"), (-F.col("n")).alias("step")),
                )
            ).alias("s"),
        )
        .groupBy("key_id", F.col("s.at").alias("_at"))
        .agg(F.sum("s.step").alias("step"))
    )
    levels = running_total(
        steps, "step", "_at", F.floor(F.col("_at") / F.lit(int(slot_seconds * 1_000_000))), ["key_id"], "_in_window", slots_per_run=1000
    ).drop("step")
    # at least 0: a request without a time sees nothing
    n_recent = F.greatest(F.col("_in_window") - 1, F.lit(0))
    return (
        join_null_safe(timed, levels, ["key_id", "_at"], "left")
        .withColumn("n_recent", n_recent)
        .withColumn("is_rejected", F.col("n_recent") >= limit.requests)
        .drop("_at", "_in_window")
    )


def key_check(requests: DataFrame, keys: DataFrame) -> DataFrame:
    """Decide for every request whether its key may be used: ``accepted``, ``unknown_key`` or ``forbidden``."""
    known = keys.groupBy("key_id").agg(
        F.max("status").alias("key_status"), F.max("researcher_name").alias("researcher_name"), F.lit(True).alias("_hit")
    )
    status = F.col("key_status")
    return (
        spread_join(requests, known, ["key_id"], "left")
        .withColumn(
            "decision",
            ladder(
                [(F.col("_hit").isNull(), "unknown_key"), (status.isNull() | (status == "active"), "accepted")],
                "forbidden",
            ),
        )
        .drop("_hit")
    )
