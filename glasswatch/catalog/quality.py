"""Data-quality checks, the publish gate and row history."""

from pyspark.sql import functions as F

from glasswatch.catalog import tables as t
from glasswatch.catalog import transparency as trc
from glasswatch.catalog.registry import register
from glasswatch.operators import history, quality
from glasswatch.plans import history_store
from glasswatch.plans.expectations import EXPECTATIONS, check_table
from glasswatch.plans.publish import count_failures, publish, read_published
from glasswatch.session import new_path

_TRACKED = ["total_decisions", "automated_decisions"]
_KEYS = ["product_line", "reporting_period_canonical", "category_code"]
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
register(
    "dq_not_null",
    # priorities count as missing where they are not specified, so that something fails
    lambda s, d: quality.not_null(
        t.table(s, d, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))),
        _ORDER_COLUMNS,
    ),
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_failures FROM orders" for c in _ORDER_COLUMNS[:3]
    )
    + " UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') FROM orders",
)
register(
    "dq_unique", lambda s, d: quality.unique(t.table(s, d, "lineitem"), "l_orderkey"),
    "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
register(
    "dq_accepted_values",
    lambda s, d: quality.accepted_values(
        t.table(s, d, "lineitem"), "l_returnflag", ["A", "R"], where=F.col("l_linestatus") == "O"
    ),
    "SELECT l_returnflag, count(*) AS n_rows FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag NOT IN ('A', 'R') "
    "GROUP BY ALL",
)
register(
    "dq_relationships",
    lambda s, d: quality.relationships(
        t.table(s, d, "events"), "event_id", t.table(s, d, "customer"), "c_custkey"
    ),
    "SELECT DISTINCT event_id AS value FROM events WHERE event_id NOT IN (SELECT c_custkey FROM customer)",
)
register(
    "dq_between",
    lambda s, d: quality.between(t.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 5, 45),
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45",
    rounded="l_quantity",
)
register(
    "dq_categories_consistent", lambda s, d: quality.categories_consistent(t.decisions(s, d), t.categories_dim(s, d)),
    "SELECT DISTINCT category_code FROM decisions WHERE category_code NOT IN (SELECT category_code FROM categories_dim "
    "WHERE category_code IS NOT NULL)",
    "decisions", "categories_dim",
)


def _continuity(s, d):
    summary = t.summary(s, d)
    # one product lacks a year, and one period is turned round
    gap = summary.filter(~((F.col("product_line") == "BUILDING") & (F.col("reporting_period_canonical") == "annual_2000")))
    periods = trc.periods_dim(s, d).withColumn(
        "reporting_period_end",
        F.when(F.col("calendar_year") == 1998, F.lit("1997-12-31").cast("date")).otherwise(F.col("reporting_period_end")),
    )
    return quality.period_continuity(gap, periods)


register(
    "dq_period_continuity", _continuity,
    "SELECT 'period_set_mismatch' AS failure_kind, CAST(count(DISTINCT p) AS VARCHAR) AS detail FROM (SELECT product_line, "
    "string_agg(reporting_period_canonical, ',' ORDER BY reporting_period_canonical) AS p FROM summary WHERE NOT "
    "(product_line = 'BUILDING' AND reporting_period_canonical = 'annual_2000') GROUP BY product_line) "
    "HAVING count(DISTINCT p) > 1 UNION ALL SELECT 'invalid_period', reporting_period_canonical FROM periods WHERE "
    "reporting_period_canonical = 'annual_1998' OR reporting_period_start >= reporting_period_end",
    "summary", "periods",
)


def _gaps(s, d):
    """Periods of the fact, of which one product lacks a year, one has a short year and one a year that begins early."""
    code, product = F.col("reporting_period_canonical"), F.col("product_line")
    rows = t.decisions(s, d).filter(~((product == "BUILDING") & (code == "annual_1996")))
    short, early = (product == "MACHINERY") & (code == "annual_1995"), (product == "FURNITURE") & (code == "annual_1997")
    return quality.period_gaps(
        rows.withColumn("reporting_period_end", F.when(short, F.lit("1995-12-01").cast("date")).otherwise(F.col("reporting_period_end")))
        .withColumn("reporting_period_start", F.when(early, F.lit("1996-12-31").cast("date")).otherwise(F.col("reporting_period_start")))
    )


register(
    "dq_period_gaps", _gaps,
    "SELECT product_line, b AS period_before, p AS period, CASE WHEN step > 0 THEN 'gap' ELSE 'overlap' END AS failure_kind, CAST(abs(step) AS "
    "INTEGER) AS days FROM (SELECT product_line, p, lag(p) OVER w AS b, date_diff('day', lag(e) OVER w, a) - 1 AS step FROM (SELECT DISTINCT "
    "product_line, reporting_period_canonical AS p, CASE WHEN product_line = 'FURNITURE' AND p = 'annual_1997' THEN DATE '1996-12-31' ELSE "
    "reporting_period_start END AS a, CASE WHEN product_line = 'MACHINERY' AND p = 'annual_1995' THEN DATE '1995-12-01' ELSE "
    "reporting_period_end END AS e FROM decisions WHERE NOT (product_line = 'BUILDING' AND p = 'annual_1996')) WINDOW w AS (PARTITION BY "
    "product_line ORDER BY a)) WHERE step <> 0",
    "decisions",
)


def _reconciled(s, d):
    """Categories against the TOTAL row: one product's total is off by one, and one year is only there in its parts."""
    rows, off = t.decisions(s, d), F.when(F.col("product_line") == "BUILDING", 1).otherwise(0)
    totals = rows.filter("category_code = 'TOTAL' AND reporting_period_canonical <> 'annual_1994'").withColumn("total_decisions", F.col("total_decisions") + off)
    return quality.totals_reconciled(rows.filter("category_code <> 'TOTAL'"), totals, ["product_line", "reporting_period_canonical"], _TRACKED)


register(
    "dq_totals_reconciled", _reconciled,
    " UNION ALL ".join(
        f"SELECT product_line, reporting_period_canonical, '{m}' AS measure, CAST(a AS BIGINT) AS added_up, CAST(w AS BIGINT) AS disclosed FROM "
        f"(SELECT product_line, reporting_period_canonical, sum({m}) AS a FROM decisions WHERE category_code <> 'TOTAL' GROUP BY ALL) FULL JOIN "
        f"(SELECT product_line, reporting_period_canonical, sum({m} + {off}) AS w FROM decisions WHERE category_code = 'TOTAL' AND "
        "reporting_period_canonical <> 'annual_1994' GROUP BY ALL) USING (product_line, reporting_period_canonical) WHERE a IS DISTINCT FROM w"
        for m, off in (("total_decisions", "CASE product_line WHEN 'BUILDING' THEN 1 ELSE 0 END"), ("automated_decisions", "0"))
    ),
    "decisions",
)
register(
    "dq_fraud_caught", lambda s, d: quality.fraud_caught(
        t.expectations(s, d).withColumn("expected_min_score", F.col("expected_min_score") + 99), t.flags(s, d)
    ),
    "SELECT *, 'best score of the expected tracks is too low' AS failure_reason FROM (SELECT scenario_id, "
    "min(expected_min_score) + 99 AS expected_min_score, count(DISTINCT track_id) AS expected_track_count, max(score) AS "
    "actual_max_score, count(DISTINCT track_id) FILTER (score >= e.expected_min_score + 99) AS "
    "tracks_at_or_above_threshold FROM scenario_scores e GROUP BY scenario_id) WHERE actual_max_score < expected_min_score",
    "scenario_scores", rounded="actual_max_score",
)


def _checks(low, high):
    return {
        "track_id_not_null": lambda df: df.filter("track_id is null"),
        "track_id_unique": lambda df: quality.unique(df, "track_id"),
        "score_in_range": lambda df: quality.between(df, "composite_suspicion_score", low, high),
        "known_action": lambda df: df.filter(
            ~F.col("recommended_action").isin("recommend_remove", "recommend_rank_lower", "no_action")
        ),
    }


register(
    "dq_flag_checks", lambda s, d: count_failures(t.flags(s, d), _checks(0, 30)),
    "SELECT 'track_id_not_null' AS check_name, count(*) FILTER (track_id IS NULL) AS n_failures FROM flags UNION ALL "
    "SELECT 'track_id_unique', count(*) - count(DISTINCT track_id) FROM flags UNION ALL SELECT 'score_in_range', "
    "count(*) FILTER (composite_suspicion_score NOT BETWEEN 0 AND 30) FROM flags UNION ALL SELECT 'known_action', 0",
    "flags",
)


def _gate(s, d):
    """The flags as readers see them: the good table was published, one that fails a check did not replace it."""
    flags, path = t.flags(s, d), new_path(s, "published")
    # thresholds are so low here that a geo signal may fire with a negative severity
    first = publish(flags, path, _checks(-1000, 100))
    second = publish(flags.filter("n_signals_fired > 0"), path, _checks(0, 0))
    if not first.published or second.published:
        raise RuntimeError(f"gate let the wrong table through: {first}, {second}")
    return read_published(s, path).select("track_id", "n_signals_fired", "recommended_action")


register(
    "dq_publish_gate", _gate, "SELECT track_id, n_signals_fired, recommended_action FROM flags", "flags"
)

register(
    "dq_table_tests",
    lambda s, d: check_table(t.flags(s, d), EXPECTATIONS["fct_artificial_streaming_flags"]),
    " UNION ALL ".join(
        f"SELECT 'not_null:{c}' AS test_name, count(*) FILTER ({c} IS NULL) AS n_failures FROM flags"
        for c in ("track_id", "composite_suspicion_score", "recommended_action", "n_signals_fired")
    )
    + " UNION ALL SELECT 'accepted_values:recommended_action', 0 UNION ALL SELECT 'unique:track_id', 0 UNION ALL "
    "SELECT 'between:composite_suspicion_score', count(*) FILTER (composite_suspicion_score NOT BETWEEN 0 AND 100) FROM "
    "flags UNION ALL SELECT 'between:n_signals_fired', 0",
    "flags",
)



def _deliveries(s, d):
    """Two deliveries of the decisions: in the second, URGENT is gone, LOW has changed and TOTAL is new."""
    rows = t.decisions(s, d).select(*_KEYS, *_TRACKED)
    first = rows.filter(F.col("category_code") != "TOTAL")
    second = rows.filter(F.col("category_code") != "1-URGENT").withColumn(
        "total_decisions", F.col("total_decisions") + F.when(F.col("category_code") == "5-LOW", 1).otherwise(0)
    )
    return first, second


def _at(day):
    return F.to_timestamp_ntz(F.lit(f"{day} 00:00:00"))


def _history(s, d):
    first, second = _deliveries(s, d)
    opened = history.first_snapshot(first, _TRACKED, _at("2026-01-01"))
    return history.apply_snapshot(opened, second, _KEYS, _TRACKED, _at("2026-02-01")).drop("row_hash")


def _stored_history(s, d):
    """The same history as a stored table; the second delivery comes twice."""
    first, second = _deliveries(s, d)
    path = new_path(s, "history")
    history_store.start(s, path, first, _KEYS, _TRACKED, _at("2026-01-01"), buckets=16)
    history_store.deliver(s, path, second, _at("2026-02-01"))
    history_store.deliver(s, path, second, _at("2026-03-01"))
    return history_store.read_history(s, path).drop("row_hash")


_JAN, _FEB = "TIMESTAMP '2026-01-01 00:00:00'", "TIMESTAMP '2026-02-01 00:00:00'"
_BASE = "product_line, reporting_period_canonical, category_code"
_HISTORY_SQL = (
    f"SELECT {_BASE}, total_decisions, automated_decisions, {_JAN} AS valid_from, CASE WHEN category_code IN ('1-URGENT', "
    f"'5-LOW') THEN {_FEB} END AS valid_to, category_code NOT IN ('1-URGENT', '5-LOW') AS is_current FROM decisions WHERE "
    f"category_code <> 'TOTAL' UNION ALL SELECT {_BASE}, total_decisions + CASE WHEN category_code = '5-LOW' THEN 1 ELSE 0 "
    f"END, automated_decisions, {_FEB}, NULL, true FROM decisions WHERE category_code IN ('5-LOW', 'TOTAL')"
)
register("snap_scd2", _history, _HISTORY_SQL, "decisions", times="valid_from valid_to")
register("snap_scd2_stored", _stored_history, _HISTORY_SQL, "decisions", times="valid_from valid_to")
