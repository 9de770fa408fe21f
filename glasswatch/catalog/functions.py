"""Casts and expressions, each over a driver table."""

from datetime import datetime

from pyspark.sql import functions as F

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import pct_sql, register
from glasswatch.config import FixedPeriod, SignalConfig
from glasswatch.functions import casts
from glasswatch.functions import expressions as ex
from glasswatch.operators.researcher import outcome_class
from glasswatch.operators.verdict_prep import render_prompt


def _over(table, *columns):
    """A query that selects the columns built by the given functions from one table."""
    return lambda s, d: t.table(s, d, table).select(*[c() for c in columns])


_KEY = "o_orderkey"
register(
    "fn_safe_int",
    _over(
        "orders",
        lambda: F.col(_KEY),
        lambda: casts.safe_int(F.floor("o_totalprice").cast("double"), fractional=True).alias("whole"),
        lambda: casts.safe_int(F.substring("o_orderpriority", 1, 1)).alias("digit"),
        lambda: casts.safe_int(F.col("o_orderpriority")).alias("not_a_number"),
    ),
    "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole, "
    "TRY_CAST(o_orderpriority[1] AS BIGINT) AS digit, TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number FROM orders",
)
register(
    "fn_safe_float",
    _over(
        "orders",
        lambda: F.col(_KEY),
        lambda: casts.safe_float(F.col("o_totalprice").cast("string")).alias("price"),
        lambda: casts.safe_float(F.col("o_orderpriority")).alias("not_a_number"),
    ),
    "SELECT o_orderkey, o_totalprice AS price, TRY_CAST(o_orderpriority AS DOUBLE) AS not_a_number FROM orders",
    rounded="price not_a_number",
)
register(
    "fn_safe_text",
    _over("orders", lambda: casts.safe_text(F.col(_KEY)).alias("key_text"), lambda: casts.safe_text(F.col("o_orderstatus")).alias("status")),
    "SELECT CAST(o_orderkey AS VARCHAR) AS key_text, o_orderstatus AS status FROM orders",
)
register(
    "fn_safe_bool",
    _over(
        "orders",
        lambda: F.col(_KEY),
        lambda: casts.safe_bool(F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "P", "false").otherwise("perhaps")).alias("b"),
    ),
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END AS b FROM orders",
)
register(
    "fn_safe_timestamp",
    _over(
        "orders",
        lambda: F.col(_KEY),
        lambda: casts.safe_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        lambda: casts.safe_timestamp(F.col("o_orderpriority")).alias("no_time"),
    ),
    "SELECT o_orderkey, o_orderdate AS ts, TRY_CAST(o_orderpriority AS TIMESTAMP) AS no_time FROM orders",
    times="ts no_time",
)
register(
    "fn_safe_date",
    _over(
        "orders",
        lambda: F.col(_KEY),
        lambda: casts.safe_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        lambda: casts.safe_date(F.col("o_orderpriority")).alias("no_day"),
    ),
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, TRY_CAST(o_orderpriority AS DATE) AS no_day FROM orders",
    dates="day no_day",
)


def _period_constants(s, d):
    canonical, start, end = FixedPeriod().columns()
    return t.table(s, d, "orders").select(
        _KEY, canonical.alias("period"), start.alias("period_start"), end.alias("period_end")
    )


register(
    "fn_period_constants", _period_constants,
    "SELECT o_orderkey, 'annual_2025' AS period, DATE '2025-01-01' AS period_start, DATE '2025-12-31' AS period_end "
    "FROM orders",
    dates="period_start period_end",
)
register(
    "fn_case_ladder",
    _over(
        "lineitem",
        lambda: F.col("l_orderkey"),
        lambda: F.col("l_linenumber"),
        lambda: ex.ladder(
            [(F.col("l_quantity") >= 40, "large"), (F.col("l_quantity") >= 20, "medium"), (F.col("l_tax") > 0.05, "taxed")]
        ).alias("size"),
        lambda: ex.ladder([(F.col("l_discount") > 0.05, "cut")], "full").alias("price"),
    ),
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium' "
    "WHEN l_tax > CAST(0.05 AS DOUBLE) THEN 'taxed' END AS size, CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN 'cut' "
    "ELSE 'full' END AS price FROM lineitem",
)
register(
    "fn_like",
    _over(
        "part",
        lambda: F.col("p_partkey"),
        lambda: F.col("p_name").like("small%").alias("starts"),
        lambda: F.col("p_name").like("%ring%").alias("has"),
        lambda: F.col("p_brand").like("Brand_1%").alias("one_wild"),
    ),
    "SELECT p_partkey, p_name LIKE 'small%' AS starts, p_name LIKE '%ring%' AS has, p_brand LIKE 'Brand_1%' AS one_wild "
    "FROM part",
)
register(
    "fn_null_handling",
    _over(
        "lineitem",
        lambda: F.col("l_orderkey"),
        lambda: F.nullif(F.col("l_linenumber"), F.lit(1)).alias("not_first"),
        lambda: F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(1)), F.lit(0)).alias("filled"),
    ),
    "SELECT l_orderkey, nullif(l_linenumber, 1) AS not_first, coalesce(nullif(l_linenumber, 1), 0) AS filled FROM lineitem",
)
register(
    "fn_greatest_least",
    _over(
        "lineitem",
        lambda: F.col("l_orderkey"),
        lambda: F.least(F.lit(3.0), F.nullif(F.col("l_quantity"), F.lit(1.0)) / 10).alias("capped"),
        lambda: F.greatest(F.col("l_quantity"), F.lit(25.0), F.col("l_linenumber").cast("double")).alias("floored"),
    ),
    "SELECT l_orderkey, least(CAST(3 AS DOUBLE), nullif(l_quantity, 1) / 10) AS capped, "
    "greatest(l_quantity, CAST(25 AS DOUBLE), CAST(l_linenumber AS DOUBLE)) AS floored FROM lineitem",
    rounded="capped floored",
)
register(
    "fn_safe_ratio",
    _over("lineitem", lambda: F.col("l_orderkey"), lambda: ex.safe_ratio(F.col("l_quantity"), F.col("l_discount")).alias("ratio")),
    "SELECT l_orderkey, l_quantity / nullif(l_discount, 0) AS ratio FROM lineitem",
    rounded="ratio",
)


def _pct_round(s, d):
    by = t.table(s, d, "orders").groupBy("o_custkey").agg(
        ex.count_when(F.col("o_orderstatus") == "F").alias("n_f"), ex.count_when(F.col("o_orderstatus") != "P").alias("n")
    )
    return by.select("o_custkey", ex.pct(F.col("n_f"), F.col("n")).alias("share_pct"))


register(
    "fn_pct_round", _pct_round,
    f"SELECT o_custkey, {pct_sql('n_f', 'n')} AS share_pct FROM (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') "
    "AS n_f, count(*) FILTER (o_orderstatus <> 'P') AS n FROM orders GROUP BY o_custkey)",
    rounded="share_pct",
)
register(
    "fn_power",
    _over("lineitem", lambda: F.col("l_orderkey"), lambda: F.pow(F.col("l_quantity") / 50, F.lit(2.0)).alias("squared")),
    "SELECT l_orderkey, pow(l_quantity / 50, 2) AS squared FROM lineitem",
    rounded="squared",
)
register(
    "fn_length",
    _over("documents", lambda: F.col("doc_id"), lambda: F.length("text").alias("n")),
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents",
)
register(
    "fn_between",
    lambda s, d: t.requests(s, d).select("query_id", outcome_class(F.col("response_status_code")).alias("outcome_class")),
    "SELECT query_id, CASE WHEN response_status_code BETWEEN 200 AND 299 THEN 'success' WHEN response_status_code = 429 "
    "THEN 'rate_limited' WHEN response_status_code BETWEEN 400 AND 499 THEN 'client_error' WHEN response_status_code "
    "BETWEEN 500 AND 599 THEN 'server_error' ELSE 'other' END AS outcome_class FROM requests",
    "requests",
)
register(
    "fn_date_parts",
    _over("events", lambda: F.col("event_id"), lambda: F.to_date("ts").alias("day"), lambda: F.hour("ts").alias("hour"),
          lambda: F.year("ts").alias("year")),
    "SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(year(ts) AS INTEGER) AS year "
    "FROM events",
    dates="day",
)
register(
    "fn_datediff_inclusive",
    lambda s, d: t.table(s, d, "orders").groupBy("o_custkey").agg(
        ex.days_inclusive(F.min("o_orderdate"), F.max("o_orderdate")).alias("days")
    ),
    "SELECT o_custkey, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 AS INTEGER) AS days FROM orders "
    "GROUP BY o_custkey",
)


def _cutoff(s, d):
    cfg = SignalConfig(reference_time=datetime(2001, 11, 4), recent_days=30, baseline_days=335)
    return t.table(s, d, "lineitem").groupBy("l_partkey").agg(
        ex.count_when(F.col("l_shipdate") >= F.lit(cfg.recent_from).cast("timestamp_ntz")).alias("recent"),
        ex.count_when(F.col("l_shipdate") >= F.lit(cfg.window_from).cast("timestamp_ntz")).alias("in_window"),
    )


register(
    "fn_ts_cutoff", _cutoff,
    "SELECT l_partkey, count(*) FILTER (l_shipdate >= TIMESTAMP '2001-11-04' - INTERVAL 30 DAY) AS recent, "
    "count(*) FILTER (l_shipdate >= TIMESTAMP '2001-11-04' - INTERVAL 365 DAY) AS in_window FROM lineitem "
    "GROUP BY l_partkey",
)
register(
    "fn_now",
    # the stamp itself differs from run to run; what can be compared is that it is one moment, not in the past of the data
    lambda s, d: t.table(s, d, "orders").select(
        _KEY, (F.current_timestamp().cast("timestamp_ntz") > F.col("o_orderdate")).alias("built_later")
    ),
    "SELECT o_orderkey, CAST(now() AS TIMESTAMP) > o_orderdate AS built_later FROM orders",
)
register(
    "fn_concat_key",
    lambda s, d: t.table(s, d, "part").withColumn("kind", F.nullif(F.col("p_type"), F.lit("PROMO"))).select(
        "p_partkey", ex.key_of("p_brand", "kind", "p_name").alias("entity_key")
    ),
    "SELECT p_partkey, p_brand || '|' || nullif(p_type, 'PROMO') || '|' || p_name AS entity_key FROM part",
)
register(
    "fn_typed_null",
    _over("part", lambda: F.col("p_partkey"), lambda: F.lit(None).cast("double").alias("no_score"),
          lambda: F.lit(None).cast("timestamp_ntz").alias("no_time")),
    "SELECT p_partkey, CAST(NULL AS DOUBLE) AS no_score, CAST(NULL AS TIMESTAMP) AS no_time FROM part",
    rounded="no_score", times="no_time",
)
register(
    "fn_string_agg",
    # the years of a segment: made distinct before they are gathered
    lambda s, d: t.table(s, d, "orders").join(t.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    .select("c_mktsegment", F.year("o_orderdate").cast("string").alias("y")).distinct()
    .groupBy("c_mktsegment").agg(ex.string_agg_sorted(F.col("y")).alias("years")),
    "SELECT product AS c_mktsegment, string_agg(DISTINCT CAST(y AS VARCHAR), ',' ORDER BY CAST(y AS VARCHAR)) AS years "
    "FROM placed GROUP BY product",
    "placed",
)
register(
    "fn_sha256_prefix",
    _over("documents", lambda: F.col("doc_id"), lambda: ex.sha256_prefix(F.col("text"), "sha256:").alias("short"),
          lambda: ex.sha256_prefix(F.col("text"), "v_").alias("id"), lambda: F.sha2("text", 256).alias("full")),
    "SELECT doc_id, 'sha256:' || sha256(text)[:16] AS short, 'v_' || sha256(text)[:16] AS id, sha256(text) AS \"full\" "
    "FROM documents",
)
register(
    "fn_first_forwarded_ip",
    _over(
        "orders", lambda: F.col(_KEY),
        lambda: ex.first_forwarded_ip(
            F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" , 10.0.0.1")))
            .when(F.col("o_orderstatus") == "P", " ,10.0.0.2"),
            F.lit("unknown"),
        ).alias("ip"),
    ),
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE 'unknown' END AS ip FROM orders",
)
_LINES = (
    ("Order %s of customer %d", ("o_orderkey", "o_custkey")),
    ("status %s, priority %s", ("o_orderstatus", "o_orderpriority")),
)
register(
    "fn_format_template",
    lambda s, d: render_prompt(t.table(s, d, "orders"), _LINES).select(_KEY, "prompt", "prompt_hash"),
    "SELECT o_orderkey, prompt, sha256(prompt) AS prompt_hash FROM (SELECT o_orderkey, 'Order ' || o_orderkey || "
    "' of customer ' || o_custkey || chr(10) || 'status ' || o_orderstatus || ', priority ' || o_orderpriority AS prompt "
    "FROM orders)",
)


def _fenced(s, d):
    answer = F.concat(F.lit('{"k": "'), F.col("o_orderkey").cast("string"), F.lit('"}'))
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.concat(F.lit("```json\n"), answer, F.lit("\n```\n")))
        .when(status == "P", F.concat(F.lit(" ``` "), answer, F.lit(" ```")))
        .otherwise(F.concat(F.lit("Sure: "), answer))
    )
    body = ex.strip_fence(text)
    return t.table(s, d, "orders").select(
        _KEY,
        body.alias("body"),
        F.try_variant_get(F.try_parse_json(body), "$.k", "string").alias("k"),
    )


register(
    "fn_strip_fence_json", _fenced,
    "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN a ELSE 'Sure: ' || a END AS body, "
    "CASE WHEN o_orderstatus IN ('F', 'P') THEN CAST(o_orderkey AS VARCHAR) END AS k "
    "FROM (SELECT *, '{\"k\": \"' || o_orderkey || '\"}' AS a FROM orders)",
)
