"""Summaries per day that merge: latency quantiles (KLL) and distinct counts (theta).

A day is read once, by the delivery that brings it. What is stored is a few kilobytes per group and day, whatever the number of rows; a report over
any days merges these and reads no rows. Both kinds are aggregates with partial sums, so a group with a third of all rows costs a
sketch per task. Every figure comes with the error it may have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.sources.sinks import clustered

#: Size of a KLL sketch; its rank error falls with about 1 / K.
LATENCY_K = 800
#: Binary logarithm of the values a theta sketch keeps; it is exact up to that many distinct ones.
DISTINCT_LG_K = 12
QUANTILES = {"latency_ms_p50": 0.50, "latency_ms_p95": 0.95}


def rank_error(k: int = LATENCY_K) -> float:
    """Rank error of one quantile at 99 % confidence, the bound published for KLL sketches: 0.55 % for K = 800."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """Relative standard error of a theta estimate: 1.6 % for 4,096 kept values."""
    return 1 / (2**lg_k - 1) ** 0.5


def latency_by_day(verdicts: DataFrame, k: int = LATENCY_K) -> DataFrame:
    """Sketch, count, sum, least and greatest latency of the successful verdicts, per provider and day (NULL without a time)."""
    ok = verdicts.filter((F.col("status") == "ok") & (F.col("latency_ms") > 0))
    return ok.groupBy("provider", F.to_date("requested_at").alias("day")).agg(
        F.max("model_name").alias("model_name"),
        F.count(F.lit(1)).alias("n"),
        F.sum("latency_ms").alias("total_ms"),
        F.min("latency_ms").alias("least_ms"),
        F.max("latency_ms").alias("most_ms"),
        F.kll_sketch_agg_bigint("latency_ms", k).alias("sketch"),
    )


def latency_report(days: DataFrame, k: int = LATENCY_K) -> DataFrame:
    """The latency distribution of each provider over ``days``. Quantiles are latencies that occur; all other columns are exact."""
    merged = days.groupBy("provider").agg(
        F.max("model_name").alias("model_name"),
        F.sum("n").alias("n_ok_verdicts"),
        F.min("least_ms").alias("latency_ms_min"),
        (F.sum("total_ms") / F.sum("n")).alias("latency_ms_mean"),
        F.max("most_ms").alias("latency_ms_max"),
        F.kll_merge_agg_bigint("sketch", k).alias("_sketch"),
    )
    found = [F.kll_sketch_get_quantile_bigint("_sketch", F.lit(p)).alias(name) for name, p in QUANTILES.items()]
    return merged.select("*", *found, F.lit(rank_error(k)).alias("rank_error")).drop("_sketch")


def latency_ranks(report: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``report`` with ``<quantile>_off``: how far the share of verdicts below (or up to) the found latency misses the quantile, 0 if it
    lies between both. This reads the verdicts, so it is for audits of the sketches."""
    ok = verdicts.filter((F.col("status") == "ok") & (F.col("latency_ms") > 0)).select(F.col("provider").alias("_p"), F.col("latency_ms").alias("_ms"))
    joined = report.join(ok.groupBy("_p", "_ms").agg(F.count(F.lit(1)).alias("_n")), F.col("provider").eqNullSafe(F.col("_p")))
    shares = joined.groupBy("provider").agg(
        *[(F.sum(F.when(F.col("_ms") < F.col(q), F.col("_n")).otherwise(0)) / F.sum("_n")).alias(f"{q}_below") for q in QUANTILES],
        *[(F.sum(F.when(F.col("_ms") <= F.col(q), F.col("_n")).otherwise(0)) / F.sum("_n")).alias(f"{q}_up_to") for q in QUANTILES],
    )
    off = [F.greatest(F.col(f"{q}_below") - p, p - F.col(f"{q}_up_to"), F.lit(0.0)).alias(f"{q}_off") for q, p in QUANTILES.items()]
    shares = shares.select(F.col("provider").alias("_p"), *off)
    return report.join(shares, F.col("provider").eqNullSafe(F.col("_p")), "left").drop("_p")


def distinct_by_day(rows: DataFrame, keys: Sequence[str], values: str, time: str, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """Rows and a sketch of the distinct ``values`` per ``keys`` and day. NULL is no value, empty text is one."""
    # the sketch itself would leave out empty text
    value = F.concat(F.lit("="), F.col(values).cast("string"))
    return rows.groupBy(*keys, F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.theta_sketch_agg(value, lg_k).alias("sketch"))


def distinct_report(days: DataFrame, keys: Sequence[str], name: str, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """Rows and estimated distinct values per ``keys`` over ``days``, exact up to 2 ** ``lg_k``; ``relative_error`` is a standard error, then 0."""
    merged = days.groupBy(*keys).agg(F.sum("n").alias("n"), F.theta_sketch_estimate(F.theta_union_agg("sketch", lg_k)).alias(name))
    return merged.withColumn("relative_error", F.when(F.col(name) < 2**lg_k, 0.0).otherwise(distinct_error(lg_k)))


def common_values(days: DataFrame, keys: Sequence[str], early: Column, late: Column, name: str, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """Estimated distinct values per ``keys`` that occur both on days for which ``early`` holds and on days for which ``late`` does."""
    both = days.groupBy(*keys).agg(
        F.theta_union_agg(F.when(early, F.col("sketch")), lg_k).alias("_early"), F.theta_union_agg(F.when(late, F.col("sketch")), lg_k).alias("_late")
    )
    return both.select(*keys, F.theta_sketch_estimate(F.theta_intersection("_early", "_late")).alias(name))


def store_delivery(days: DataFrame, path: str, delivery: str) -> None:
    """Keep the days that a delivery brings. Days may be split over deliveries; one that is loaded again replaces its own rows, except on
    days it no longer holds."""
    rows = clustered(days.withColumn("delivery", F.lit(delivery)), ["day"])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "delivery").parquet(path)
