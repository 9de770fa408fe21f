"""History of republished rows (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fingerprint(columns: Sequence[str]) -> Column:
    # to_json tells NULL from '' and keeps fields apart
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def first_snapshot(current: DataFrame, tracked: Sequence[str], at: Column) -> DataFrame:
    return current.select(
        "*",
        _fingerprint(tracked).alias("row_hash"),
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def apply_snapshot(
    history: DataFrame, current: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: Column
) -> DataFrame:
    """History after another delivery: changed and vanished rows are closed, changed and new ones opened.

    One full outer join of the open rows with the delivery on the keys, in which NULL equals NULL; closed rows pass through.
    """
    is_open = F.col("is_current")
    fresh = first_snapshot(current, tracked, at)
    old = history.filter(is_open).select(F.struct(*history.columns).alias("old"), *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)])
    new = fresh.select(F.struct(*history.columns).alias("new"), *[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)])
    same_key = F.lit(True)
    for i in range(len(keys)):
        same_key = same_key & F.col(f"_o{i}").eqNullSafe(F.col(f"_n{i}"))
    joined = old.join(new, same_key, "full")
    gone, added = F.col("new").isNull(), F.col("old").isNull()
    same = F.col("old.row_hash") == F.col("new.row_hash")
    closed = F.col("old").withField("valid_to", at).withField("is_current", F.lit(False))
    rows = (
        F.when(added, F.array("new"))
        .when(gone, F.array(closed))
        .when(same, F.array("old"))
        .otherwise(F.array(closed, F.col("new")))
    )
    return history.filter(~is_open).unionByName(joined.select(F.explode(rows).alias("r")).select("r.*"))
