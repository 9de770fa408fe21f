"""Join helpers for keys that may be NULL or very unevenly filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on the keys in which NULL equals NULL; the keys are kept from the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    salts: int = 8,
) -> DataFrame:
    """Join a large side, in which one key may hold a third of all rows, with a small side that was aggregated by key.

    Rows of one key go to ``salts`` partitions by a hash of ``spread_by`` (all columns by default), and the small side
    is repeated for each. An aggregated side is already partitioned by the key, so a plain join would not shuffle it,
    and AQE only splits skewed partitions below a join if both sides were shuffled for it. The salt makes sure they
    are; what is still too large after salting is split at run time. Both sides are always shuffled: Spark takes the
    repeated side for as small as it was before, and would broadcast ``salts`` times what it measured.
    """
    if salts & (salts - 1):
        raise ValueError("salts must be a power of two")
    # a bit mask is never NULL, so no NULL filter is pushed below an exchange that could be reused
    salt = F.xxhash64(*(spread_by or big.columns)).bitwiseAND(F.lit(salts - 1).cast("bigint"))
    copies = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)]))
    repeated = small.withColumn("_salt", copies).hint("merge")
    return big.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
