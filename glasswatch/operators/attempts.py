"""The rate limit over raw attempts, of which rejected ones don't count against later ones.

Whether an attempt is admitted depends on the decisions before it, so a key's attempts are gone through in the order of time, then of
``query_id``. All that is kept of a key are the times of its admitted attempts within the window: no more than the limit allows,
however many attempts there are. ``decided`` streams sorted attempts past that state, so a key with a third of the log never sits in
memory; ``decided_stream`` holds the state in the stream's state store, and lets go of a key by a timer once its window is over.
Keys with the same hash are handed over together there.

An attempt without a time is admitted, sees nothing and isn't counted. Attempts without a key share one count.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from glasswatch.config import RateLimit

#: A stream's keys share this many groups, since each call of its function costs milliseconds however few attempts it gets.
KEY_GROUPS = 1 << 10
_RESULT = T.StructType([T.StructField("n_recent", T.LongType()), T.StructField("is_rejected", T.BooleanType())])


def admit(at: int | None, held: list[int], window: int, limit: int) -> int:
    """How many admitted attempts the window before ``at`` holds, its ends included; ``held`` (ascending) is brought up to date."""
    if at is None:
        return 0
    del held[: bisect_left(held, at - window)]
    n = len(held)
    if n < limit:
        held.append(at)
    return n


def _window(limit: RateLimit) -> int:
    return limit.minutes * 60 * 1_000_000


def _at():
    return F.unix_micros(F.col("requested_at").cast("timestamp"))


def decided(log: DataFrame, limit: RateLimit = RateLimit()) -> DataFrame:
    """``log`` (with ``query_id, key_id, requested_at``) and, per attempt, ``n_recent`` and ``is_rejected``."""
    window, most = _window(limit), limit.requests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, started = None, [], False
        for b in batches:
            counts = []
            for key, at in zip(b.column("_key").to_pylist(), b.column("_at").to_pylist(), strict=True):
                if not started or key != last:
                    last, held, started = key, [], True
                counts.append(admit(at, held, window, most))
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], n, pc.greater_equal(n, most)], [*b.schema.names[:-2], *_RESULT.names])

    # numbered inside, so that no own column clashes
    inner = log.toDF(*[f"c{i}" for i in range(len(log.columns))])
    place = {c: f"c{i}" for i, c in enumerate(log.columns)}
    timed = inner.withColumns({"_at": F.unix_micros(F.col(place["requested_at"]).cast("timestamp")), "_key": F.col(place["key_id"])})
    timed = timed.select(*inner.columns, "_key", "_at").repartition("_key").sortWithinPartitions("_key", "_at", place["query_id"])
    out = timed.mapInArrow(run, T.StructType([*inner.schema.fields, *_RESULT.fields]))
    return out.toDF(*log.columns, *_RESULT.names)


def decided_stream(log: DataFrame, limit: RateLimit = RateLimit(), delay: str = "2 minutes") -> DataFrame:
    """The same for a stream of attempts; those of a batch are put in order, batches are taken as they come.

    A restart goes on from the checkpointed state. A key whose last admitted attempt is older than the window and the delay is forgotten.
    """
    window, most = _window(limit), limit.requests
    names = ["query_id", "key_id", "requested_at"]

    def run(key, batches, state: GroupState):
        past, held = state.getCurrentWatermarkMs() * 1000, {}
        if state.exists:
            keys, counts, times = state.get
            ends = [0, *accumulate(counts)]
            held = {k: sorted(times[a:b]) for k, a, b in zip(keys, ends, ends[1:], strict=False)}
        if not state.hasTimedOut:
            rows = pd.concat(list(batches)).sort_values(["key", "at", "query_id"], na_position="first")
            rows["n_recent"] = [
                admit(None if pd.isna(at) else int(at), held.setdefault(k, []), window, most) for k, at in zip(rows["key"], rows["at"], strict=True)
            ]
            rows["is_rejected"] = rows["n_recent"] >= most
            rows["key_id"] = [k[1:] if k[0] == "=" else None for k in rows["key"]]
            yield rows[["query_id", "key_id", "at", "n_recent", "is_rejected"]]
        held = {k: times for k, times in held.items() if times and times[-1] + window >= past}
        if held:
            state.update((list(held), [len(times) for times in held.values()], [t for times in held.values() for t in times]))
            state.setTimeoutTimestamp(max(min(times[-1] for times in held.values()) + window, past) // 1000 + 1)
        elif state.exists:
            state.remove()

    types = log.select(*names).schema
    timed = log.select(*names).withColumns({"at": _at(), "event_time": F.col("requested_at").cast("timestamp")}).withWatermark("event_time", delay)
    # the key as text that is never NULL
    timed = timed.withColumn("key", F.when(F.col("key_id").isNull(), F.lit("?")).otherwise(F.concat(F.lit("="), F.col("key_id").cast("string"))))
    timed = timed.drop("key_id").withColumn("group", F.pmod(F.xxhash64("key"), F.lit(KEY_GROUPS)))
    out = timed.groupBy("group").applyInPandasWithState(
        run, "query_id string, key_id string, at long, n_recent long, is_rejected boolean", "keys array<string>, counts array<int>, times array<long>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    when = F.timestamp_micros("at").cast(types["requested_at"].dataType).alias("requested_at")
    return out.select(F.col("query_id").cast(types["query_id"].dataType), F.col("key_id").cast(types["key_id"].dataType), when, *_RESULT.names)
