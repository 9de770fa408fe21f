"""The aggregates behind the signals, kept per day and folded, so that a new day of plays costs that day only.

Three tables below one folder, partitioned by the delivery a row came with and by ``month``, so that a fold over a window opens
its months only:

* ``listeners``: ``day, track_id, user_id, n``
* ``countries``: ``day, track_id, stream_country_iso2, n``
* ``pairs``: distinct ``day, session_id, track_id``

Counts of several deliveries of a day add up, pairs unite, so plays may be split over deliveries in any way, late ones included. A delivery
that is loaded again replaces itself. ``roll_up`` merges the days before a date into one, which has one row a track and
listener however many days it stands for; the spike needs single days only within its window.

Spike boundaries must be midnights, since a day's plays are not told apart any more.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasswatch.config import SignalConfig
from glasswatch.operators.signals import PlayCounts
from glasswatch.sources.sinks import clustered

KEYS = {
    "listeners": ("track_id", "user_id"),
    "countries": ("track_id", "stream_country_iso2"),
    "pairs": ("session_id", "track_id"),
}
#: The day that stands for all days rolled up. Plays without a time belong there from the start: no window has them.
ROLLED_UP = date(1000, 1, 1)


def day_counts(streams: DataFrame) -> dict[str, DataFrame]:
    """The three tables of some plays, with their ``day``."""
    day = F.coalesce(F.to_date("streamed_at"), F.lit(ROLLED_UP)).alias("day")
    n = F.count(F.lit(1)).alias("n")
    known = streams.filter("session_id is not null and track_id is not null")
    return {
        "listeners": streams.groupBy(day, *KEYS["listeners"]).agg(n),
        "countries": streams.groupBy(day, *KEYS["countries"]).agg(n),
        "pairs": known.select(day, *KEYS["pairs"]).distinct(),
    }


def add_delivery(streams: DataFrame, root: str, delivery: str) -> None:
    """Add the plays of a delivery to the tables below ``root``; loading it again replaces what it brought before."""
    for name, df in day_counts(streams).items():
        _write(df, f"{root}/{name}/delivery={delivery}", "overwrite")


def _write(df: DataFrame, path: str, mode: str = "error") -> None:
    by_month = df.withColumn("month", F.trunc("day", "month"))
    clustered(by_month, ["month"]).write.mode(mode).partitionBy("month").parquet(path)


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}").drop("delivery", "month")


def fold(spark: SparkSession, root: str, cfg: SignalConfig = SignalConfig()) -> PlayCounts:
    """The aggregates that the signals take, from all deliveries."""
    for boundary in (cfg.recent_from, cfg.window_from):
        if datetime.combine(boundary, time()) != boundary:
            raise ValueError(f"{boundary} isn't a midnight: plays are counted per day")
    recent = F.col("day") >= F.lit(cfg.recent_from.date())
    before = (F.col("day") >= F.lit(cfg.window_from.date())) & ~recent
    total = lambda c=None: F.sum("n" if c is None else F.when(c, F.col("n")).otherwise(0))
    return PlayCounts(
        _read(spark, root, "listeners").groupBy(*KEYS["listeners"]).agg(total().alias("n")),
        _read(spark, root, "countries")
        .groupBy(*KEYS["countries"])
        .agg(total().alias("n"), total(recent).alias("recent"), total(before).alias("baseline")),
        _read(spark, root, "pairs").select(*KEYS["pairs"]).distinct(),
    )


def roll_up(spark: SparkSession, root: str, into: str, before: date) -> None:
    """Write the tables to the new folder ``into`` with all days before ``before`` merged, and the deliveries of a day too.

    The old folder stays as it is, so readers aren't disturbed and a broken run is simply repeated. The merged rows are a delivery of their own.
    """
    delivery = f"rolled-{uuid.uuid4().hex}"
    for name, keys in KEYS.items():
        day = F.when(F.col("day") < F.lit(before), F.lit(ROLLED_UP)).otherwise(F.col("day")).alias("day")
        rows = _read(spark, root, name)
        merged = rows.select(day, *keys).distinct() if name == "pairs" else rows.groupBy(day, *keys).agg(F.sum("n").alias("n"))
        _write(merged, f"{into}/{name}/delivery={delivery}")


def recent_listens(spark: SparkSession, root: str, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Plays per track and day of the spike's window; other months aren't opened."""
    from_day = cfg.window_from.date()
    rows = spark.read.parquet(f"{root}/countries").filter((F.col("month") >= F.lit(from_day.replace(day=1))) & (F.col("day") >= F.lit(from_day)))
    return rows.groupBy("track_id", "day").agg(F.sum("n").alias("n"))
