"""The request log as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from glasswatch.config import RateLimit
from glasswatch.operators.researcher import outcome_class
from glasswatch.operators.staging import stage_table
from glasswatch.sources.sinks import write_by_day


def read_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def audit_rows(raw: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Typed request rows, each query id once even if its file arrives again within the delay.

    A request without an id is known by all its columns, so that different ones stay apart.
    The event time has to be TIMESTAMP for a watermark; it turns back to the zone-free type afterwards.
    """
    staged = stage_table(raw, "researcher_queries")
    whole = F.sha2(F.to_json(F.struct(*staged.columns), {"ignoreNullFields": "false"}), 256)
    return (
        staged.withColumn("_request", F.when(F.col("query_id").isNull(), F.concat(F.lit("?"), whole)).otherwise(F.concat(F.lit("="), "query_id")))
        .withColumn("requested_at", F.col("requested_at").cast("timestamp"))
        .withWatermark("requested_at", delay)
        .dropDuplicatesWithinWatermark(["_request"])
        .drop("_request")
        .withColumn("requested_at", F.col("requested_at").cast("timestamp_ntz"))
        .withColumn("outcome_class", outcome_class(F.col("response_status_code")))
    )


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is there and append it to the audit table."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _minute(at: Column) -> Column:
    """Minutes since 1970, down to the whole one."""
    return _whole(F.unix_micros(at.cast("timestamp")), 60_000_000)


def _whole(x: Column, by: int) -> Column:
    return ((x - F.pmod(x, F.lit(by))) / by).cast("long")


def _at(minute: Column) -> Column:
    return F.timestamp_seconds(minute * 60).cast("timestamp_ntz")


def rate_windows(requests: DataFrame, limit: RateLimit = RateLimit(), delay: str = "2 minutes") -> DataFrame:
    """Each request as the sliding windows it counts in, one of which starts every minute; keyless requests are counted together.

    These windows follow each other, so a row names the first one and their number: ``key_id, window_start, windows, minutes`` (the length of
    each), and ``mark``, the time up to which windows close once the request is there. Requests without a time are in no window.
    """
    at = F.col("requested_at").cast("timestamp")
    first = _at(_minute(at) - (limit.minutes - 1))
    mark = F.unix_micros(at - F.expr(f"INTERVAL '{delay}'"))
    windows, minutes = F.lit(limit.minutes).alias("windows"), F.lit(limit.minutes).alias("minutes")
    return requests.filter(at.isNotNull()).select("key_id", first.alias("window_start"), windows, minutes, mark.alias("mark"))


def _counts_to(windows: DataFrame, path: str, checkpoint: str, grace: bool) -> StreamingQuery:
    """Count every batch's requests per key and first window, in a folder of its own, so a repeated batch replaces itself.

    Windows that closed before the batch are cut off; with ``grace``, before the batch that came before it in the same run. ``marks`` has
    how far windows are closed after each batch. Nothing else is kept between batches.
    """
    run = uuid.uuid4().hex

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, counts = batch.sparkSession, f"{path}/counts/batch_id={batch_id}"
        earlier = [r for r in _marks(spark, path) if r["batch_id"] < batch_id]
        known = earlier[:-1] if grace and earlier and earlier[-1]["run"] == run else earlier
        closed = known[-1]["mark"] if known else 0
        first, opens = _minute(F.col("window_start")), F.lit(closed // 60_000_000) - F.col("minutes") + 1
        cut = F.greatest(opens - first, F.lit(0))
        rows = batch.groupBy("key_id", "window_start", "windows", "minutes").agg(F.count(F.lit(1)).alias("n"), F.max("mark").alias("mark"))
        still = rows.withColumns({"window_start": _at(first + cut), "windows": (F.col("windows") - cut).cast("int")}).filter("windows > 0")
        still.write.mode("overwrite").parquet(counts)
        last = spark.read.schema(still.schema).parquet(counts).agg(F.max("mark")).first()[0]
        mark = max([x for x in (last, earlier[-1]["mark"] if earlier else None) if x is not None], default=0)
        spark.range(0, 1, 1, 1).select(F.lit(run).alias("run"), F.lit(mark).cast("long").alias("mark")).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    return windows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store).trigger(availableNow=True).start()


def _marks(spark: SparkSession, path: str) -> list[Row]:
    """``batch_id, run, mark`` of the last three batches, oldest first."""
    if not _exists(spark, f"{path}/marks"):
        return []
    marks = spark.read.schema("run string, mark long, batch_id long").parquet(f"{path}/marks")
    return marks.orderBy(F.desc("batch_id")).limit(3).collect()[::-1]


def _counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/counts").drop("batch_id", "mark")


def _single_windows(counts: DataFrame, *sums: str) -> DataFrame:
    """``sums`` per key and window (``_start``, in minutes), for rows that count in the windows from ``_from`` to ``_to``.

    Rows meet by key and day and only there become windows, so they are moved once for each day their windows start on, not once for each
    window, and a busy key is spread over its days. Few bytes become many rows, so the number of tasks isn't left to sizes.
    """
    spark = counts.sparkSession
    added = [F.sum(c).alias(c) for c in sums]
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    days = F.sequence(_whole(F.col("_from"), 1440), _whole(F.col("_to"), 1440))
    dealt = counts.select("key_id", F.explode(days).alias("_day"), "_from", "_to", "minutes", *sums).repartition(tasks, "key_id", "_day")
    met = dealt.groupBy("key_id", "_day", "_from", "_to", "minutes").agg(*added)
    first = F.col("_day") * 1440
    starts = F.sequence(F.greatest("_from", first), F.least("_to", first + 1439))
    return met.select("key_id", "_day", "minutes", F.explode(starts).alias("_start"), *sums).groupBy("key_id", "_day", "_start", "minutes").agg(*added)


def _bounded(counts: DataFrame) -> DataFrame:
    first = _minute(F.col("window_start"))
    return counts.withColumns({"_from": first, "_to": first + F.col("windows") - 1})


def _windows(counts: DataFrame) -> DataFrame:
    """``key_id, window_start, window_end, n`` from counted rows."""
    start = F.col("_start")
    return _single_windows(_bounded(counts), "n").select("key_id", _at(start).alias("window_start"), _at(start + F.col("minutes")).alias("window_end"), "n")


def latest_windows_to(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what every batch adds to windows to a folder of its own, so a repeated batch replaces itself."""
    return _counts_to(windows, path, checkpoint, grace=True)


def read_latest_windows(spark: SparkSession, path: str, limit: RateLimit = RateLimit()) -> DataFrame:
    """Final count of each window and whether the key reached the limit in it."""
    return _windows(_counts(spark, path)).withColumn("over_limit", F.col("n") >= limit.requests)


def closed_windows_to(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Count requests until the last one seen, less the delay, has passed their windows' end; ``read_closed_windows`` has each such window once.

    What arrives for a closed window isn't counted; ``late_requests`` finds it. A batch is a folder of counts, which a repetition replaces, so
    a restart from the checkpoint neither loses a window nor counts one twice.
    """
    return _counts_to(windows, path, checkpoint, grace=False)


def late_requests(requests: DataFrame, closed: DataFrame, limit: RateLimit = RateLimit(), every: bool = False) -> DataFrame:
    """Requests that came after their window had closed, counted per key and window: ``key_id, window_start, window_end, n_late``.

    ``requests`` is the whole log, ``closed`` the stream's table (``read_closed_windows``, best in runs of windows). Windows close in the
    order of their ends, so all that end with the last closed one or before are closed, also those that had no request in time. ``every``
    gives the closed windows without late requests too, and the count ``n`` they closed with.

    The log is moved as counts per key and minute, which meet the closed windows by key and day and only there become windows.
    """
    at = F.col("_minute")
    minutes = requests.filter("requested_at is not null").select("key_id", _minute(F.col("requested_at")).alias("_minute"))
    minutes = minutes.groupBy("key_id", "_minute").agg(F.count(F.lit(1)).alias("_total"))
    length = F.lit(limit.minutes).alias("minutes")
    totals = minutes.select("key_id", (at - (limit.minutes - 1)).alias("_from"), at.alias("_to"), length, "_total", F.lit(None).cast("long").alias("n"))
    ran = _bounded(closed if "windows" in closed.columns else closed.withColumn("windows", F.lit(1)))
    counted = ran.select("key_id", "_from", "_to", length, F.lit(None).cast("long").alias("_total"), "n")
    through = counted.agg(F.max("_to").alias("_through"))
    windows = _single_windows(totals.union(counted), "_total", "n").join(F.broadcast(through), F.col("_start") <= F.col("_through"))
    n, start = F.coalesce("n", F.lit(0)), F.col("_start")
    late = windows.select(
        "key_id", _at(start).alias("window_start"), _at(start + F.col("minutes")).alias("window_end"), n.alias("n"),
        F.greatest(F.coalesce("_total", F.lit(0)) - n, F.lit(0)).alias("n_late"), F.col("n").isNotNull().alias("_closed"),
    )
    if every:
        return late.filter("_closed or n_late > 0").drop("_closed")
    return late.filter("n_late > 0").drop("n", "_closed")


def _closed(spark: SparkSession, path: str) -> DataFrame:
    """Counted rows, cut to the windows that have closed."""
    marks = _marks(spark, path)
    passed = F.lit(marks[-1]["mark"] // 60_000_000 if marks else 0) - F.col("minutes")
    rows = _bounded(_counts(spark, path))
    left = F.least("_to", passed) - F.col("_from") + 1
    return rows.withColumn("windows", left.cast("int")).filter("windows > 0").drop("_from", "_to")


def _by_day(closed: DataFrame) -> DataFrame:
    """Rows whose windows start on one day, which is ``window_day``."""
    day = F.col("_day")
    first, last = F.greatest("_from", day * 1440), F.least("_to", day * 1440 + 1439)
    days = _bounded(closed).withColumn("_day", F.explode(F.sequence(_whole(F.col("_from"), 1440), _whole(F.col("_to"), 1440))))
    cut = days.withColumns({"window_start": _at(first), "windows": (last - first + 1).cast("int"), "window_day": F.to_date(_at(day * 1440))})
    return cut.drop("_from", "_to", "_day")


def compact_windows(spark: SparkSession, path: str, target: str) -> None:
    """Copy the days of closed windows that can't grow any more from the stream's many files to few files per day.

    A day is complete once a window that starts after it has closed. Days that were copied before are left alone, so a copy that fails is repeated.
    """
    closed = _by_day(_closed(spark, path))
    last = closed.agg(F.max("window_day").alias("_last"))
    complete = closed.join(F.broadcast(last), F.col("window_day") < F.col("_last")).drop("_last")
    write_by_day(_without(complete, _copied(spark, target, closed)), target, time="window_start", day="window_day", mode="overwrite")


def _without(rows: DataFrame, done: DataFrame | None) -> DataFrame:
    """Rows of days that aren't copied. There is one row per day, so the days go to all tasks."""
    if done is None:
        return rows
    days = done.select(F.col("window_day").alias("_copied")).distinct()
    return rows.join(F.broadcast(days), F.col("window_day") == F.col("_copied"), "left_anti")


def read_closed_windows(spark: SparkSession, path: str, target: str | None = None, runs: bool = False) -> DataFrame:
    """All closed windows, ``key_id, window_start, window_end, n``; days copied by ``compact_windows`` are read from ``target``.

    With ``runs`` as they are stored: ``key_id, window_start, windows, minutes, n``, where ``n`` requests count in each of so many windows that
    follow each other, and several rows may count in one window.
    """
    closed = _closed(spark, path)
    rows = _by_day(closed) if target else closed
    done = _copied(spark, target, rows) if target else None
    if done is not None:
        rows = _without(rows, done).unionByName(done)
    rows = rows.select("key_id", "window_start", "windows", "minutes", "n")
    return rows if runs else _windows(rows)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _copied(spark: SparkSession, target: str, like: DataFrame) -> DataFrame | None:
    return spark.read.schema(like.schema).parquet(target) if _exists(spark, target) else None
