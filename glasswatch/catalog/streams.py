"""Streaming jobs over the request log, run to the end of what is there."""

from pyspark.sql import functions as F

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import cte, register
from glasswatch.catalog.researcher import ATTEMPTS, ATTEMPTS_SQL
from glasswatch.config import RateLimit
from glasswatch.operators import attempts
from glasswatch.operators.staging import stage_table
from glasswatch.schemas import BRONZE
from glasswatch.session import new_path
from glasswatch.streaming import requests as rq


def _log_files(s, d):
    """The request log as files in a folder, each request written twice."""
    path = new_path(s, "requests")
    log = t.raw_requests(s, d)
    log.unionByName(log).select(*BRONZE["researcher_queries"].names).write.parquet(path)
    return path


def _audited(s, d):
    raw = rq.read_files(s, _log_files(s, d), BRONZE["researcher_queries"])
    out = new_path(s, "audit_stream")
    rq.append_to(rq.audit_rows(raw), out, new_path(s, "audit_checkpoint")).awaitTermination()
    return s.read.parquet(out).select("query_id", "key_id", "requested_at", "outcome_class")


register(
    "stream_audit_ingest", _audited,
    "SELECT query_id, key_id, requested_at, CASE WHEN response_status_code BETWEEN 200 AND 299 THEN 'success' WHEN "
    "response_status_code = 429 THEN 'rate_limited' WHEN response_status_code BETWEEN 400 AND 499 THEN 'client_error' "
    "WHEN response_status_code BETWEEN 500 AND 599 THEN 'server_error' ELSE 'other' END AS outcome_class FROM requests",
    "requests", times="requested_at",
)
_LIMIT = RateLimit(requests=4)


def _windows(s, d):
    raw = rq.read_files(s, _log_files(s, d), BRONZE["researcher_queries"])
    log = stage_table(raw, "researcher_queries")
    out = new_path(s, "rate_stream")
    rq.latest_windows_to(rq.rate_windows(log, _LIMIT), out, new_path(s, "rate_checkpoint")).awaitTermination()
    return rq.read_latest_windows(s, out, _LIMIT)


register(
    "stream_rate_window", _windows,
    "SELECT key_id, w AS window_start, w + INTERVAL 15 MINUTE AS window_end, 2 * count(*) AS n, 2 * count(*) >= 4 AS "
    "over_limit FROM (SELECT key_id, date_trunc('minute', requested_at) - to_minutes(CAST(m AS BIGINT)) AS w FROM requests, "
    "range(15) r(m)) GROUP BY ALL",
    "requests", times="window_start window_end",
)


def _closed_windows(s, d):
    """The log as it arrives in three files, each read by a new run: its earlier half without the requests answered by 503, its later half,
    and last these requests, whose windows have closed by then."""
    log = t.requests(s, d).select("key_id", "requested_at", "response_status_code")
    folder, out, days, checkpoint = (new_path(s, f"closed_{n}") for n in ("in", "out", "days", "checkpoint"))
    at = F.unix_micros(F.col("requested_at").cast("timestamp"))
    ends = log.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
    early = at < (ends["a"] + ends["b"]) // 2
    held_back = early & (F.col("response_status_code") == 503)
    for part in (early & ~held_back, ~early, held_back):
        log.filter(part).write.mode("append").parquet(folder)
        rq.closed_windows_to(rq.rate_windows(rq.read_files(s, folder, log.schema), _LIMIT), out, checkpoint).awaitTermination()
        rq.compact_windows(s, out, days)
    closed = rq.read_closed_windows(s, out, days, runs=True)
    return rq.late_requests(s.read.schema(log.schema).parquet(folder), closed, _LIMIT, every=True)


cte(
    "bounds",
    "SELECT max(requested_at) - INTERVAL 2 MINUTE AS mark, make_timestamp((epoch_us(min(requested_at)) + "
    "epoch_us(max(requested_at))) // 2) AS cut FROM requests",
    "requests",
)
register(
    "stream_closed_windows", _closed_windows,
    "SELECT key_id, w AS window_start, w + INTERVAL 15 MINUTE AS "
    "window_end, count(*) FILTER (NOT held) AS n, count(*) FILTER (held) AS n_late FROM (SELECT key_id, mark, date_trunc('minute', "
    "requested_at) - to_minutes(CAST(m AS BIGINT)) AS w, response_status_code = 503 AND requested_at < cut AS held FROM "
    "requests, bounds, range(15) r(m)) WHERE w + INTERVAL 15 MINUTE <= mark GROUP BY key_id, w",
    "bounds", times="window_start window_end",
)


def _attempts(s, d):
    """The log in three files, one after the other, each read by a new run from the checkpoint of the one before."""
    log = t.requests(s, d).select("query_id", "key_id", "requested_at")
    folder, out, checkpoint = (new_path(s, f"attempts_{n}") for n in ("in", "out", "checkpoint"))
    first, second = log.select(F.unix_seconds(F.col("requested_at").cast("timestamp")).alias("x")).approxQuantile("x", [0.3, 0.7], 0.01)
    at = F.unix_seconds(F.col("requested_at").cast("timestamp"))
    for part in (at < first, (at >= first) & (at < second), at >= second):
        log.filter(part).write.mode("append").parquet(folder)
        stream = rq.read_files(s, folder, log.schema)
        rq.append_to(attempts.decided_stream(stream, ATTEMPTS), out, checkpoint).awaitTermination()
    return s.read.parquet(out)


register("stream_rate_limit_attempts", _attempts, ATTEMPTS_SQL, "requests", times="requested_at")
