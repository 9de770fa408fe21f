"""The data tests of every table, and a runner that checks all row rules of a table in one scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.functions.expressions import count_when
from glasswatch.operators import quality


@dataclass(frozen=True)
class Expect:
    """Tests of one table. NULL only fails ``not_null``."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[object, ...]] = field(default_factory=dict)
    between: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    # column -> (table, column) it must be found in
    found_in: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# fixed values: allowed values and which columns are tested for what
_LINES = ("main", "artists", "authors", "creators")
_PRODUCT = {"product_line": _LINES}
_SCENARIOS = ("bot_ring", "ai_fake_artists", "family_plan_abuse", "geographic_anomaly", "playlist_stuffing")
_PROVIDERS = ("anthropic", "openai", "google")
_STATUSES = ("ok", "skipped_no_key", "malformed_response", "api_error")
_RECOMMENDATIONS = ("recommend_no_action", "recommend_rank_lower", "recommend_remove")
_PERIOD = {"reporting_period_canonical": ("annual_2025",)}
_FIRES = {"fires": (0, 1)}
_IN_PRODUCTS = {"product_line": ("dim_dsa_products", "product_id")}

EXPECTATIONS: dict[str, Expect] = {
    "stg_dsa_report_identification": Expect(
        ("product_line", "reporting_period_canonical", "source_sha256"), accepted={**_PRODUCT, **_PERIOD}
    ),
    "stg_dsa_categories_names": Expect(("product_line", "category_label", "source_sha256"), accepted=_PRODUCT),
    "stg_dsa_member_states_orders": Expect(("product_line", "reporting_period_canonical", "scope"), accepted=_PRODUCT),
    "stg_dsa_notices": Expect(
        ("product_line", "reporting_period_canonical", "category_code", "source_sha256"), accepted={**_PRODUCT, **_PERIOD}
    ),
    "stg_dsa_own_initiative_illegal": Expect(("product_line",), accepted=_PRODUCT),
    "stg_dsa_own_initiative_tc": Expect(("product_line",), accepted=_PRODUCT),
    "stg_dsa_appeals_and_recidivism": Expect(("product_line", "section", "indicator"), accepted=_PRODUCT),
    "stg_dsa_automated_means": Expect(
        ("product_line",), accepted={**_PRODUCT, "quality_metric_kind": ("accuracy", "precision", "recall")}
    ),
    "stg_dsa_qualitative": Expect(("product_line", "narrative_text"), accepted=_PRODUCT),
    "stg_synth_users": Expect(
        ("user_id", "country_iso2", "plan_type", "age_band"),
        ("user_id",),
        {
            "plan_type": ("free", "individual", "duo", "family", "student"),
            "age_band": ("13-17", "18-24", "25-34", "35-44", "45-54", "55+"),
        },
    ),
    "stg_synth_artists": Expect(("artist_id", "monthly_listeners"), ("artist_id",)),
    "stg_synth_tracks": Expect(
        ("track_id", "artist_id", "ai_generated_label"), ("track_id",), found_in={"artist_id": ("stg_synth_artists", "artist_id")}
    ),
    "stg_synth_streams": Expect(
        ("stream_id", "user_id", "track_id", "device"),
        ("stream_id",),
        {"device": ("web", "ios", "android", "desktop", "tv", "speaker")},
        found_in={"user_id": ("stg_synth_users", "user_id"), "track_id": ("stg_synth_tracks", "track_id")},
    ),
    "stg_synth_moderation_actions": Expect(
        ("action_id", "subject_type", "decision_basis"),
        ("action_id",),
        {"subject_type": ("track", "user", "artist"), "decision_basis": ("automated", "manual", "hybrid")},
    ),
    "stg_synth_appeals": Expect(
        ("appeal_id", "action_id", "status"),
        ("appeal_id",),
        {"status": ("upheld", "reversed", "pending")},
        found_in={"action_id": ("stg_synth_moderation_actions", "action_id")},
    ),
    "stg_llm_verdicts": Expect(
        ("verdict_id", "scenario_id", "provider", "status"),
        ("verdict_id",),
        {"scenario_id": _SCENARIOS, "provider": _PROVIDERS, "status": _STATUSES, "recommendation": _RECOMMENDATIONS},
    ),
    "int_dsa_period_aligned": Expect(("reporting_period_canonical", "period_days"), ("reporting_period_canonical",)),
    "int_dsa_unified": Expect(
        ("product_line", "reporting_period_canonical", "total_decisions", "automated_decisions"), accepted=_PRODUCT
    ),
    "int_dsa_automated_quality": Expect(
        ("product_line", "scope"), accepted={**_PRODUCT, "scope": ("Total number", "Own-initiative ", "NAM Total")}
    ),
    "int_dsa_appeals": Expect(("product_line", "complaints_submitted"), accepted=_PRODUCT),
    "dim_dsa_reporting_periods": Expect(
        ("reporting_period_id", "reporting_period_start", "reporting_period_end", "period_granularity"),
        ("reporting_period_id",),
        {"period_granularity": ("annual", "biannual", "quarterly", "other")},
    ),
    "dim_dsa_products": Expect(
        ("product_id", "display_name", "service_kind"),
        ("product_id",),
        {
            "product_id": _LINES,
            "service_kind": (
                "music_streaming", "music_artist_platform", "audiobook_author_platform", "podcast_creator_platform",
            ),
        },
    ),
    "dim_dsa_categories": Expect(
        ("category_id", "category_label"), ("category_id",), {"category_level": ("aggregate", "top_level", "sub_category")}
    ),
    "dim_eu_member_states": Expect(("member_state_id", "is_eu"), ("member_state_id",)),
    "fct_dsa_decisions": Expect(
        ("product_line", "reporting_period_canonical", "category_code", "total_decisions"),
        found_in={
            **_IN_PRODUCTS,
            "reporting_period_canonical": ("dim_dsa_reporting_periods", "reporting_period_id"),
        },
    ),
    "fct_dsa_appeals": Expect(("product_line",), ("product_line",), found_in=_IN_PRODUCTS),
    "fct_dsa_eu_orders": Expect(
        ("product_line", "member_state_id"),
        found_in={**_IN_PRODUCTS, "member_state_id": ("dim_eu_member_states", "member_state_id")},
    ),
    "rpt_cross_product_summary": Expect(
        ("product_line", "total_decisions", "notices_received"), ("product_line",), _PRODUCT
    ),
    "rpt_quarter_over_quarter_trends": Expect(("product_line", "period_seq", "n_periods_available"), accepted=_PRODUCT),
    "rpt_member_state_breakdown": Expect(("product_line", "member_state_id")),
    "rpt_automated_vs_human": Expect(
        ("product_line",),
        ("product_line",),
        {**_PRODUCT, "automation_posture": ("conservative", "aggressive", "balanced")},
    ),
    "rpt_appeals_lifecycle": Expect(("product_line",), ("product_line",), _PRODUCT),
    "sig_listen_spike": Expect(("track_id", "fires", "severity"), ("track_id",), _FIRES, {"severity": (0, 3.01)}),
    "sig_geo_anomaly": Expect(("track_id", "fires"), ("track_id",), _FIRES, {"top_country_share": (0.0, 1.0)}),
    "sig_stream_to_listener_ratio": Expect(("track_id", "fires"), ("track_id",), _FIRES),
    "sig_repeat_listener_concentration": Expect(("track_id", "fires"), ("track_id",), _FIRES, {"hhi_value": (0.0, 1.0001)}),
    "sig_playlist_stuffing": Expect(("track_id", "fires"), ("track_id",), {"fires": (1,)}),
    "fct_artificial_streaming_flags": Expect(
        ("track_id", "composite_suspicion_score", "recommended_action", "n_signals_fired"),
        ("track_id",),
        {"recommended_action": ("recommend_remove", "recommend_rank_lower", "no_action")},
        {"composite_suspicion_score": (0, 100), "n_signals_fired": (0, 5)},
    ),
    "fraud_scenario_expectations": Expect(
        ("scenario_id", "track_id", "expected_min_score"), accepted={"scenario_id": _SCENARIOS},
        between={"expected_min_score": (0, 100)},
    ),
    "eu_member_states": Expect(("member_state_code", "is_eu")),
    "fct_llm_verdicts": Expect(
        ("verdict_id", "scenario_id", "provider", "status"),
        ("verdict_id",),
        {"scenario_id": _SCENARIOS, "provider": _PROVIDERS, "status": _STATUSES, "llm_agrees_with_heuristic": (0, 1)},
    ),
    "rpt_llm_agreement_rate": Expect(
        ("scenario_id", "two_of_three_agree", "unanimous_agree"),
        ("scenario_id",),
        {"two_of_three_agree": (0, 1), "unanimous_agree": (0, 1)},
    ),
    "rpt_llm_latency_distribution": Expect(("provider",), ("provider",)),
    "rpt_llm_cost_breakdown": Expect(("provider",), ("provider",)),
    "rpt_llm_drift_score": Expect(
        ("provider", "drift_status"),
        ("provider",),
        {"drift_status": ("no_prior_snapshot", "within_tolerance", "drift_detected")},
    ),
    "dim_researcher_keys": Expect(("key_id", "created_at"), ("key_id",)),
    "fct_researcher_queries": Expect(
        ("query_id", "key_id", "requested_at", "outcome_class"),
        ("query_id",),
        {"outcome_class": ("success", "rate_limited", "client_error", "server_error", "other")},
    ),
    "rpt_researcher_query_audit": Expect(("key_id", "query_date", "n_queries")),
}


def _row_rules(expect: Expect) -> dict[str, Column]:
    """Test name -> condition of a failing row."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in expect.not_null}
    rules |= {f"accepted_values:{c}": ~F.col(c).isin(*values) for c, values in expect.accepted.items()}
    rules |= {f"between:{c}": ~F.col(c).between(*bounds) for c, bounds in expect.between.items()}
    return rules


def check_table(df: DataFrame, expect: Expect, tables: Mapping[str, DataFrame] = {}) -> DataFrame:
    """One row per test: ``test_name`` and ``n_failures``. Row rules share a scan; the others add one job part each."""
    rules = _row_rules(expect)
    parts = []
    if rules:
        counts = df.agg(*[count_when(c).alias(name) for name, c in rules.items()])
        parts.append(counts.unpivot([], [F.col(f"`{n}`") for n in rules], "test_name", "n_failures"))
    failing = {f"unique:{c}": quality.unique(df, c) for c in expect.unique}
    for c, (table, parent_column) in expect.found_in.items():
        failing[f"relationships:{c}"] = quality.relationships(df, c, tables[table], parent_column)
    for name, rows in failing.items():
        parts.append(rows.agg(F.count(F.lit(1)).alias("n_failures")).select(F.lit(name).alias("test_name"), "n_failures"))
    return reduce(DataFrame.unionByName, parts)


def check_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The tests of every given table that has any: ``table_name``, ``test_name``, ``n_failures``."""
    checked = [
        check_table(df, EXPECTATIONS[name], tables).select(F.lit(name).alias("table_name"), "test_name", "n_failures")
        for name, df in tables.items()
        if name in EXPECTATIONS
    ]
    return reduce(DataFrame.unionByName, checked)
