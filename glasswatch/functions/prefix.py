"""Running totals and exact quantiles without putting a whole group into one task.

A plain ``sum().over(partitionBy(key).orderBy(t))`` sorts all rows of a key in one task. Here the order axis is cut
into slots. Totals per slot are few and can be summed per key; the running sum over single rows then only spans one
(key, slot). A key holding a third of all rows is thus spread over its slots, and rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.functions.joins import join_null_safe


def running_total(
    df: DataFrame,
    value: str,
    order: str,
    slot: Column,
    keys: Sequence[str] = (),
    out: str = "running_total",
    slots_per_run: int | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all rows of the same keys whose ``order`` is not greater (ties included).

    ``slot`` must be a non-decreasing function of ``order``, narrow enough that one slot of one key fits a task. With
    ``slots_per_run`` slots are whole numbers whose totals are themselves added up run by run: a key, or a table without
    keys, may then have more slots than fit a task.
    """
    slotted = df.withColumn("_slot", slot)
    totals = slotted.groupBy(*keys, "_slot").agg(F.coalesce(F.sum(value), F.lit(0)).alias("_total"))
    if slots_per_run is None:
        earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        before = totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    else:
        runs = F.floor(F.col("_at") / slots_per_run)
        upto = running_total(totals.withColumnRenamed("_slot", "_at"), "_total", "_at", runs, keys, "_upto")
        before = upto.withColumnRenamed("_at", "_slot").withColumn("_before", F.col("_upto") - F.col("_total"))
    # what came before a slot enters it as one more row, ahead of all others: its order is NULL
    carried = before.select(*keys, "_slot", F.col("_before").alias(value), F.lit(True).alias("_carried"))
    upto = Window.partitionBy(*keys, "_slot").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slotted.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.sum(value).over(upto))
        .filter(~F.col("_carried"))
        .drop("_slot", "_carried")
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], slot_width: float
) -> DataFrame:
    """Interpolated quantiles per key, one column per entry of ``probs`` (name -> probability); NULLs are ignored.

    Values are counted first, so no task ever holds more than the distinct values of one slot.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted_quantiles(counts, keys, value, probs, slot_width)


def counted_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], slot_width: float
) -> DataFrame:
    """The same from values with their number of rows, ``_n``; a value may be listed several times."""
    ranked = running_total(counts, "_n", value, F.floor(F.col(value) / F.lit(slot_width)), keys, "_upto")
    sizes = counts.groupBy(*keys).agg((F.sum("_n") - 1).alias("_last"))
    placed = join_null_safe(ranked, sizes, keys, "left")
    bounds, finals = [], []
    for name, p in probs.items():
        position = F.lit(p) * F.col("_last")
        bounds += [
            F.min(F.when(F.col("_upto") > F.floor(position), F.col(value))).cast("double").alias(f"_lo_{name}"),
            F.min(F.when(F.col("_upto") > F.ceil(position), F.col(value))).cast("double").alias(f"_hi_{name}"),
        ]
        part = position - F.floor(position)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        finals.append((lo + (hi - lo) * part).alias(name))
    return placed.groupBy(*keys, "_last").agg(*bounds).select(*keys, *finals)
