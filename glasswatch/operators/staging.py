"""Staging: one row in, one row out; rename and cast only.

A table is described by (source column, kind, new name) triples; ``project`` turns the list into one ``select``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.config import FixedPeriod, PeriodConfig
from glasswatch.functions.casts import cast_as, safe_text
from glasswatch.functions.expressions import ladder

Triple = tuple[str, str, str]


def project(df: DataFrame, spec: Iterable[Triple], *extra: Column) -> DataFrame:
    return df.select(*[cast_as(df, src, kind).alias(dst) for src, kind, dst in spec], *extra)


def _same(kind: str, *names: str) -> list[Triple]:
    return [(n, kind, n) for n in names]


# --- regulatory sheets -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sheet:
    """Layout of one report sheet: leading text columns, then metrics, each with a free-text remark."""

    text: tuple[Triple, ...]
    metrics: tuple[str, ...] = ()
    remarks: bool = False
    with_dates: bool = True

    def spec(self) -> list[Triple]:
        out = list(self.text)
        for metric in self.metrics:
            plain = metric.removeprefix("n_")
            hours = metric.startswith("median_")
            out.append((metric, "float", f"{plain}_hours") if hours else (metric, "int", plain))
        if self.remarks:
            out += [(f"ctx_{m}", "text", f"ctx_{m.removeprefix('n_')}") for m in self.metrics]
        return out


_WHO = tuple(_same("text", "applicability", "service"))
_EAV = (*_WHO, *_same("text", "section", "indicator", "scope"), ("value", "float", "value"),
        *_same("text", "contextual_information"))


def _by_category(column: str, *more: str) -> tuple[Triple, ...]:
    return (*_WHO, (column, "text", "category_code"), *_same("text", "description_subcategory_other", *more))


# fixed values: metric columns of the harmonised report template
_ORDER_METRICS = (
    "n_orders_to_act", "n_items_in_orders_to_act", "median_time_to_inform_act", "median_time_to_give_effect_act",
    "n_orders_to_provide_info", "median_time_to_inform_info", "median_time_to_give_effect_info",
)
_NOTICE_METRICS = (
    "n_notices_received", "n_notices_from_trusted_flaggers", "n_items_in_notices", "n_items_in_tf_notices",
    "median_time_to_take_action", "median_time_to_take_action_tf",
    "n_actions_on_law", "n_actions_on_law_tf", "n_actions_on_tc", "n_actions_on_tc_tf",
)
_OWN_INITIATIVE_METRICS = (
    "n_measures_own_initiative", "n_measures_automated_detection",
    "vis_restriction_removal", "vis_restriction_disable", "vis_restriction_demoted", "vis_restriction_age_restricted",
    "vis_restriction_interaction_restricted", "vis_restriction_labelled", "vis_restriction_other",
    "mon_restriction_suspension", "mon_restriction_termination", "mon_restriction_other",
    "provision_suspension", "provision_termination", "account_suspension", "account_termination",
)

SHEETS: dict[str, Sheet] = {
    "report_identification": Sheet((*_WHO, *_same("text", "indicator", "value"))),
    "categories_names": Sheet(
        (*_same("text", "category_label", "category_description"),
         ("category_of_illegal_or_tc", "text", "category_code"), *_same("text", "contextual_information")),
        with_dates=False,
    ),
    "member_states_orders": Sheet(
        _by_category("category_of_illegal_content", "scope"), _ORDER_METRICS, remarks=True
    ),
    "notices": Sheet(_by_category("category_of_illegal_content"), _NOTICE_METRICS, remarks=True),
    "own_initiative_illegal": Sheet(
        _by_category("category_of_illegal_content"), _OWN_INITIATIVE_METRICS, remarks=True
    ),
    "own_initiative_tc": Sheet(
        _by_category("category_of_incompatibility_tc"), _OWN_INITIATIVE_METRICS, remarks=True
    ),
    "appeals_and_recidivism": Sheet(_EAV),
    "automated_means": Sheet(_EAV),
    "qualitative": Sheet((*_WHO, *_same("text", "indicator"), ("value", "text", "narrative_text"))),
}


def stage_sheet(raw: DataFrame, sheet: str, period: PeriodConfig = FixedPeriod()) -> DataFrame:
    """Staged form of one of the nine report sheets, with product, period and provenance columns."""
    layout = SHEETS[sheet]
    canonical, start, end = period.columns()
    head = [safe_text(F.col("source_product")).alias("product_line"), canonical.alias("reporting_period_canonical")]
    if layout.with_dates:
        head += [start.alias("reporting_period_start"), end.alias("reporting_period_end")]
    body = [cast_as(raw, src, kind).alias(dst) for src, kind, dst in layout.spec()]
    if sheet == "automated_means":
        body.append(_quality_kind(safe_text(F.col("indicator"))).alias("quality_metric_kind"))
    tail = _same("text", "source_sheet") + _same("int", "source_row_index") + _same("text", "source_sha256")
    return raw.select(*head, *body, *[cast_as(raw, s, k).alias(d) for s, k, d in tail])


def _quality_kind(indicator: Column) -> Column:
    # all three indicators mention accuracy, so it is tested last
    return ladder([(indicator.like(f"%- {word}%"), word.lower()) for word in ("Precision", "Recall", "Accuracy")])


# --- play events, moderation, verdicts, researcher log -----------------------------------------------------------

# fixed values: columns of the tables, how they are cast, and their staged names
TABLES: dict[str, list[Triple]] = {
    "users": _same("text", "user_id") + [("country", "text", "country_iso2")] + _same("text", "plan_type")
    + _same("timestamp", "signup_ts") + _same("text", "age_band", "household_id"),
    "artists": _same("text", "artist_id", "name") + [("country", "text", "country_iso2")]
    + _same("text", "distributor") + _same("int", "monthly_listeners"),
    "tracks": _same("text", "track_id", "artist_id", "title", "isrc") + _same("int", "duration_ms")
    + _same("text", "release_date", "distributor") + _same("bool", "ai_generated_label"),
    "streams": _same("text", "stream_id", "user_id", "track_id")
    + [("ts", "timestamp", "streamed_at"), ("country", "text", "stream_country_iso2")]
    + _same("text", "device") + _same("int", "ms_played") + _same("text", "session_id"),
    "moderation_actions": _same("text", "action_id", "subject_type", "subject_id")
    + [("category", "text", "category_code")] + _same("text", "decision_type", "decision_basis")
    + [("ts", "timestamp", "action_ts")] + _same("text", "notice_origin"),
    "appeals": _same("text", "appeal_id", "action_id")
    + [("ts_filed", "timestamp", "filed_at"), ("ts_resolved", "timestamp", "resolved_at")]
    + _same("text", "status", "reviewer_type"),
    "llm_verdicts": _same("text", "verdict_id", "scenario_id", "track_id", "provider")
    + [("model", "text", "model_name")] + _same("text", "status", "error_class", "recommendation")
    + _same("float", "confidence") + _same("text", "primary_signal", "reasoning")
    + [("uncertainty_flags", "text", "uncertainty_flags_json")]
    + _same("timestamp", "requested_at", "completed_at")
    + _same("int", "latency_ms", "input_tokens", "output_tokens") + _same("float", "cost_usd")
    + _same("text", "prompt_hash", "response_hash"),
    "researcher_keys": _same("text", "key_id", "researcher_name", "institution", "purpose", "email_hash")
    + _same("timestamp", "created_at") + _same("text", "status"),
    "researcher_queries": _same("text", "query_id", "key_id", "endpoint", "query_params_json")
    + _same("int", "response_size_bytes", "response_status_code", "latency_ms")
    + _same("timestamp", "requested_at") + _same("text", "client_ip_hash"),
}


def stage_table(raw: DataFrame, table: str) -> DataFrame:
    """Staged form of one of the non-sheet tables."""
    extra: list[Column] = []
    if table == "users":
        extra = [
            F.coalesce(safe_text(F.col("plan_type")) == "family", F.lit(False)).alias("is_family_plan"),
            # "_" matches any one character; for diagnosis only, no signal reads it
            F.coalesce(safe_text(F.col("user_id")).like("u_990%"), F.lit(False)).alias("is_synth_fraud_injected_user"),
        ]
    return project(raw, TABLES[table], *extra)
