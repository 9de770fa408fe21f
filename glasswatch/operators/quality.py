"""Data-quality checks. Every check returns the failing rows or counts them; nothing is sampled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.functions.expressions import count_when


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, one row per column, counted in a single pass."""
    counts = df.agg(*[count_when(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_failures")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[object], where: Column | None = None) -> DataFrame:
    """Values outside the list, with their number of rows. NULL is left to ``not_null``."""
    rows = df if where is None else df.filter(where)
    return rows.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent. Values are made distinct first, so a value filling the child joins once."""
    values = child.select(F.col(column).alias("value")).filter("value is not null").distinct()
    parents = parent.select(F.col(parent_column).alias("value"))
    return values.join(parents, "value", "left_anti")


def between(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Rows outside the closed range. NULL is left to ``not_null``."""
    return df.filter(~F.col(column).between(low, high))


def categories_consistent(decisions: DataFrame, categories: DataFrame) -> DataFrame:
    """Category codes of the fact that the taxonomy does not have."""
    return relationships(decisions, "category_code", categories, "category_code").withColumnRenamed(
        "value", "category_code"
    )


def period_continuity(summary: DataFrame, periods: DataFrame) -> DataFrame:
    """Products that report different periods, and periods that end before they start."""
    period = F.col("reporting_period_canonical")
    # a set of periods is known by its size and the sum of its hashes
    hashes = F.sum(F.when(period.isNotNull(), F.xxhash64(period)).cast("decimal(38,0)"))
    sets = (
        summary.select("product_line", period).distinct()
        .groupBy("product_line")
        .agg(F.count(period).alias("_size"), F.coalesce(hashes, F.lit(0)).alias("_sum"))
        .agg(F.countDistinct("_size", "_sum").alias("n"))
        .filter("n > 1")
        .select(F.lit("period_set_mismatch").alias("failure_kind"), F.col("n").cast("string").alias("detail"))
    )
    invalid = periods.filter(
        (F.col("reporting_period_start") >= F.col("reporting_period_end")) | (F.col("period_days") <= 0)
    ).select(F.lit("invalid_period").alias("failure_kind"), F.col("reporting_period_id").alias("detail"))
    return sets.unionByName(invalid)


def period_gaps(reported: DataFrame) -> DataFrame:
    """Days between a product's successive reporting periods that no period covers, and days that two of them cover.

    ``reported`` has ``product_line, reporting_period_canonical, reporting_period_start, reporting_period_end`` in any number of rows; what is
    ordered are the distinct periods of one product. ``days`` is how many days are missing (``gap``) or covered twice (``overlap``).
    Periods without a start or end are left to the check for NULLs.
    """
    start, end = F.col("reporting_period_start"), F.col("reporting_period_end")
    periods = reported.filter(start.isNotNull() & end.isNotNull()).select("product_line", F.col("reporting_period_canonical").alias("period"), start.alias("start"), end.alias("end")).distinct()
    order = Window.partitionBy("product_line").orderBy("start", "end", "period")
    # a long period may reach beyond the ones that start after it
    covered = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    step = F.datediff("start", covered) - 1
    return (
        periods.select("product_line", "period", F.lag("period").over(order).alias("period_before"), step.alias("step"))
        .filter("step <> 0")
        .select("product_line", "period_before", "period", F.when(F.col("step") > 0, "gap").otherwise("overlap").alias("failure_kind"), F.abs("step").alias("days"))
    )


def totals_reconciled(parts: DataFrame, totals: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Measures whose parts don't add up to the disclosed total: ``*keys, measure, added_up, disclosed``.

    A total that nothing was reported for and parts without a total are failures too, with a NULL on that side; NULL keys are keys like
    others. Totals that are disclosed several times are added. Both sides are aggregated before they meet.
    """
    sides = parts.select(*keys, *measures, F.lit(True).alias("_part")).unionByName(totals.select(*keys, *measures, F.lit(False).alias("_part")))
    both = sides.groupBy(*keys).agg(
        *[F.sum(F.when(side, F.col(m))).alias(f"_{name}_{m}") for m in measures for name, side in (("got", F.col("_part")), ("want", ~F.col("_part")))]
    )
    each = both.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"_got_{m}").alias("added_up"), F.col(f"_want_{m}").alias("disclosed")) for m in measures])).alias("m"))
    off = F.coalesce(F.abs(F.col("added_up") - F.col("disclosed")) > tolerance, ~F.col("added_up").eqNullSafe(F.col("disclosed")))
    return each.select(*keys, "m.*").filter(off)


def scenario_scores(expectations: DataFrame, flags: DataFrame) -> DataFrame:
    """Expected tracks of each scenario with the score they got (0 if not streamed)."""
    # Both sides are shuffled: stored flags are mostly zeros, a small file that would be sent to all tasks as rows of all tracks.
    scores = flags.select("track_id", F.col("composite_suspicion_score").alias("_score"))
    return expectations.join(scores.hint("merge"), "track_id", "left").select(
        "scenario_id", "track_id", "expected_min_score", F.coalesce(F.col("_score"), F.lit(0.0)).alias("score")
    )


def fraud_caught(expectations: DataFrame, flags: DataFrame) -> DataFrame:
    """Scenarios whose best score stays below what is expected of them."""
    hit = F.when(F.col("score") >= F.col("expected_min_score"), F.col("track_id"))
    return (
        scenario_scores(expectations, flags)
        .groupBy("scenario_id")
        .agg(
            F.min("expected_min_score").alias("expected_min_score"),
            F.countDistinct("track_id").alias("expected_track_count"),
            F.max("score").alias("actual_max_score"),
            F.countDistinct(hit).alias("tracks_at_or_above_threshold"),
        )
        .filter("actual_max_score < expected_min_score")
        .withColumn("failure_reason", F.lit("best score of the expected tracks is too low"))
    )
