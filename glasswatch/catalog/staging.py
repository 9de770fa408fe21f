"""The 18 staging projections."""

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import register
from glasswatch.operators import staging as st
from pyspark.sql import functions as F

_DATES = "reporting_period_start reporting_period_end"
_STAMP = (
    "'{sheet}' AS source_sheet, CAST(reporting_period_canonical[8:] AS BIGINT) - 1993 AS source_row_index, source_sha256"
)
_WHO = "'yes' AS applicability, product_line AS service"


def _sheet(name):
    return lambda s, d: t.staged(s, d, name)


def _remarks(sheet):
    return ", ".join(
        f"'see ' || reporting_period_canonical AS ctx_{m.removeprefix('n_')}" for m in st.SHEETS[sheet].metrics
    )


def _blank(sheet, have):
    out = []
    for m in st.SHEETS[sheet].metrics:
        hours = m.startswith("median_")
        name = m.removeprefix("n_") + ("_hours" if hours else "")
        if name not in have:
            out.append(f"CAST(NULL AS {'DOUBLE' if hours else 'BIGINT'}) AS {name}")
    return ", ".join(out)


def _metric_sheet(key, sheet, source, have):
    blank = _blank(sheet, have)
    register(
        key,
        _sheet(sheet),
        f"SELECT * EXCLUDE (source_sha256), {_WHO}, CAST(NULL AS VARCHAR) AS description_subcategory_other, "
        f"{blank + ', ' if blank else ''}{_remarks(sheet)}, "
        f"{_STAMP.format(sheet='4_notices' if sheet == 'notices' else sheet)} FROM {source}",
        source,
        dates=_DATES,
        rounded=" ".join(f"{m}_hours" for m in st.SHEETS[sheet].metrics if m.startswith("median_")),
    )


_OWN = (
    "measures_own_initiative", "measures_automated_detection", "vis_restriction_removal", "account_suspension",
    "account_termination",
)
_metric_sheet(
    "stg_dsa_notices", "notices", "notices",
    ("notices_received", "notices_from_trusted_flaggers", "items_in_notices", "items_in_tf_notices",
     "median_time_to_take_action_hours", "median_time_to_take_action_tf_hours", "actions_on_law", "actions_on_law_tf",
     "actions_on_tc", "actions_on_tc_tf"),
)
_metric_sheet("stg_dsa_own_initiative_illegal", "own_initiative_illegal", "illegal", _OWN)
_metric_sheet("stg_dsa_own_initiative_tc", "own_initiative_tc", "tc", _OWN)
_metric_sheet(
    "stg_dsa_member_states_orders", "member_states_orders", "authority_orders",
    ("orders_to_act", "items_in_orders_to_act", "median_time_to_inform_act_hours",
     "median_time_to_give_effect_act_hours", "orders_to_provide_info"),
)


def _eav(source, pairs):
    """Long rows from the wide SQL piece."""
    return " UNION ALL ".join(
        f"SELECT product_line, {_DATES.replace(' ', ', ')}, reporting_period_canonical, source_sha256, scope, "
        f"'{text}' AS indicator, {col} AS value FROM {source}"
        for col, text in pairs.items()
    )


_SHA = "sha256(product_line || '/' || reporting_period_canonical[8:]) AS source_sha256"
_APPEALS = dict(
    zip(
        ("complaints_submitted", "complaints_reversed", "complaints_upheld", "recidivism_count"),
        t.APPEAL_INDICATORS.values(),
        strict=True,
    )
)
_MEANS = dict(
    zip(
        ("accuracy", "precision_score", "recall", "measures_solely_automated", "measures_not_automated",
         "notices_solely_automated", "notices_not_automated"),
        t.MEANS_INDICATORS.values(),
        strict=True,
    )
)
register(
    "stg_dsa_appeals_and_recidivism",
    _sheet("appeals_and_recidivism"),
    f"SELECT *, {_WHO}, 'Internal complaints' AS section, CAST(NULL AS VARCHAR) AS contextual_information, "
    f"{_STAMP.format(sheet='appeals_and_recidivism').removesuffix(', source_sha256')} FROM ("
    + _eav(f"(SELECT *, 'Total number' AS scope, {_SHA} FROM appeals)", _APPEALS) + ")",
    "appeals", dates=_DATES, rounded="value",
)
register(
    "stg_dsa_automated_means",
    _sheet("automated_means"),
    f"SELECT *, {_WHO}, 'Automated means' AS section, CAST(NULL AS VARCHAR) AS contextual_information, "
    "CASE WHEN contains(indicator, '- Precision') THEN 'precision' WHEN contains(indicator, '- Recall') THEN 'recall' "
    "WHEN contains(indicator, '- Accuracy') THEN 'accuracy' END AS quality_metric_kind, "
    f"{_STAMP.format(sheet='automated_means').removesuffix(', source_sha256')} FROM ("
    + _eav(f"(SELECT *, {_SHA} FROM quality)", _MEANS) + ")",
    "quality", dates=_DATES, rounded="value",
)
register(
    "stg_dsa_report_identification",
    _sheet("report_identification"),
    "SELECT product AS product_line, 'annual_' || y AS reporting_period_canonical, make_date(y, 1, 1) AS "
    "reporting_period_start, make_date(y, 12, 31) AS reporting_period_end, 'yes' AS applicability, product AS service, "
    "unnest(['Starting date of the reporting period', 'Ending date of the reporting period']) AS indicator, "
    "unnest([CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR), CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR)]) "
    "AS value, 'report_identification' AS source_sheet, y - 1993 AS source_row_index, "
    "sha256(product || '/' || y) AS source_sha256 FROM placed GROUP BY product, y",
    "placed", dates=_DATES,
)
register(
    "stg_dsa_categories_names",
    _sheet("categories_names"),
    "SELECT product AS product_line, 'annual_2025' AS reporting_period_canonical, label AS category_label, "
    "'about ' || category AS category_description, code AS category_code, CAST(NULL AS VARCHAR) AS "
    "contextual_information, 'categories_names' AS source_sheet, CAST(category[1] AS BIGINT) AS source_row_index, "
    "sha256(product) AS source_sha256 FROM categories",
    "categories",
)
register(
    "stg_dsa_qualitative",
    _sheet("qualitative"),
    "SELECT source AS product_line, 'annual_2025' AS reporting_period_canonical, DATE '2025-01-01' AS "
    "reporting_period_start, DATE '2025-12-31' AS reporting_period_end, 'yes' AS applicability, lang AS service, "
    "'narrative ' || lang AS indicator, text AS narrative_text, 'qualitative' AS source_sheet, doc_id AS "
    "source_row_index, sha256(text) AS source_sha256 FROM documents",
    dates=_DATES,
)

# --- other tables: driver rows under bronze column names ---------------------------------------------------------


def _users(s, d):
    c = t.table(s, d, "customer")
    return c.select(
        # ids of the diagnostic kind appear for high balances
        F.concat(F.when(F.col("c_acctbal") > 9000, "u_990").otherwise(F.lit("u_")), F.col("c_custkey")).alias("user_id"),
        F.col("c_nationkey").alias("country"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "family").when(F.col("c_mktsegment") != "MACHINERY", "free").alias(
            "plan_type"
        ),
        F.concat(F.lit("2020-01-0"), (F.col("c_custkey") % 12).cast("string"), F.lit(" 10:00:00")).alias("signup_ts"),
        F.col("c_mktsegment").alias("age_band"),
        (F.col("c_custkey") % 10).alias("household_id"),
    )


register(
    "stg_synth_users",
    lambda s, d: st.stage_table(_users(s, d), "users"),
    "SELECT CASE WHEN c_acctbal > 9000 THEN 'u_990' ELSE 'u_' END || c_custkey AS user_id, "
    "CAST(c_nationkey AS VARCHAR) AS country_iso2, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'family' "
    "WHEN c_mktsegment <> 'MACHINERY' THEN 'free' END AS plan_type, "
    "CASE WHEN c_custkey % 12 BETWEEN 1 AND 9 THEN make_timestamp(2020, 1, c_custkey % 12, 10, 0, 0) END AS signup_ts, "
    "c_mktsegment AS age_band, CAST(c_custkey % 10 AS VARCHAR) AS household_id, "
    "c_mktsegment = 'HOUSEHOLD' AS is_family_plan, "
    # any one character may stand for the underscore
    "(CASE WHEN c_acctbal > 9000 THEN 'u_990' ELSE 'u_' END || c_custkey) LIKE 'u_990%' AS is_synth_fraud_injected_user "
    "FROM customer",
    times="signup_ts",
)
register(
    "stg_synth_artists",
    lambda s, d: st.stage_table(
        t.table(s, d, "supplier").selectExpr(
            "s_suppkey artist_id", "s_name name", "s_nationkey country", "'self' distributor",
            "floor(s_acctbal) * 1.0D monthly_listeners",
        ),
        "artists",
    ),
    "SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS country_iso2, "
    "'self' AS distributor, CAST(floor(s_acctbal) AS BIGINT) AS monthly_listeners FROM supplier",
)
register(
    "stg_synth_tracks",
    lambda s, d: st.stage_table(
        t.table(s, d, "part").selectExpr(
            "p_partkey track_id", "p_partkey % 10 artist_id", "p_name title", "p_brand isrc", "p_retailprice duration_ms",
            "make_date(2000 + p_size, 1, 1) release_date", "p_type distributor",
            "case when p_type = 'PROMO' then 'true' when p_type = 'SMALL' then 'maybe' else 'false' end ai_generated_label",
        ),
        "tracks",
    ),
    "SELECT CAST(p_partkey AS VARCHAR) AS track_id, CAST(p_partkey % 10 AS VARCHAR) AS artist_id, p_name AS title, "
    "p_brand AS isrc, CAST(round(p_retailprice) AS BIGINT) AS duration_ms, (2000 + p_size) || '-01-01' AS release_date, "
    "p_type AS distributor, CASE WHEN p_type <> 'SMALL' THEN p_type = 'PROMO' END AS ai_generated_label FROM part",
)
register(
    "stg_synth_streams",
    lambda s, d: st.stage_table(
        t.table(s, d, "lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) stream_id", "l_suppkey user_id", "l_partkey track_id", "l_shipdate ts",
            "l_returnflag country", "l_linestatus device", "l_quantity * 1000 ms_played", "l_orderkey session_id",
        ),
        "streams",
    ),
    "SELECT l_orderkey || '-' || l_linenumber AS stream_id, CAST(l_suppkey AS VARCHAR) AS user_id, "
    "CAST(l_partkey AS VARCHAR) AS track_id, l_shipdate AS streamed_at, l_returnflag AS stream_country_iso2, "
    "l_linestatus AS device, CAST(l_quantity * 1000 AS BIGINT) AS ms_played, CAST(l_orderkey AS VARCHAR) AS session_id "
    "FROM lineitem",
    times="streamed_at",
)
register(
    "stg_synth_moderation_actions",
    lambda s, d: st.stage_table(
        t.table(s, d, "orders").selectExpr(
            "o_orderkey action_id", "'user' subject_type", "o_custkey subject_id", "o_orderpriority category",
            "o_orderstatus decision_type", "'manual' decision_basis", "cast(o_orderdate as date) ts", "'own' notice_origin",
        ),
        "moderation_actions",
    ),
    "SELECT CAST(o_orderkey AS VARCHAR) AS action_id, 'user' AS subject_type, CAST(o_custkey AS VARCHAR) AS subject_id, "
    "o_orderpriority AS category_code, o_orderstatus AS decision_type, 'manual' AS decision_basis, o_orderdate AS "
    "action_ts, 'own' AS notice_origin FROM orders",
    times="action_ts",
)
register(
    "stg_synth_appeals",
    lambda s, d: st.stage_table(
        t.table(s, d, "orders").selectExpr(
            "o_orderkey appeal_id", "o_custkey action_id", "o_orderdate ts_filed",
            "case when o_orderstatus = 'F' then o_orderdate end ts_resolved", "o_orderstatus status",
            "cast(null as string) reviewer_type",
        ),
        "appeals",
    ),
    "SELECT CAST(o_orderkey AS VARCHAR) AS appeal_id, CAST(o_custkey AS VARCHAR) AS action_id, o_orderdate AS filed_at, "
    "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS resolved_at, o_orderstatus AS status, "
    "CAST(NULL AS VARCHAR) AS reviewer_type FROM orders",
    times="filed_at resolved_at",
)
register(
    "stg_llm_verdicts", t.staged_verdicts, "SELECT * FROM verdicts", "verdicts",
    rounded="confidence cost_usd", times="requested_at completed_at",
)
register("stg_researcher_keys", t.keys, "SELECT * FROM keys", "keys", times="created_at")
register("stg_researcher_queries", t.requests, "SELECT * FROM requests", "requests", times="requested_at")
