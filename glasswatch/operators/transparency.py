"""Regulatory-transparency tables: unification of the report sheets, dimensions, facts and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glasswatch.functions.expressions import days_inclusive, ladder, pct

PERIOD = ("reporting_period_canonical", "reporting_period_start", "reporting_period_end")
PRODUCT_PERIOD = ("product_line", *PERIOD)


def _c(name: str) -> Column:
    return F.col(name)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _all_of(frames: list[DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """Distinct rows over all frames. Each frame is made distinct on the map side before rows move."""
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in frames]).distinct()


# --- intermediate ----------------------------------------------------------------------------------------------


def period_aligned(notices: DataFrame, illegal: DataFrame, tc: DataFrame) -> DataFrame:
    """The reporting periods present in any of the three sheets, with their length in days."""
    days = days_inclusive(_c("reporting_period_start"), _c("reporting_period_end"))
    return _all_of([notices, illegal, tc], PERIOD).withColumn("period_days", days)


def unified(notices: DataFrame, illegal: DataFrame, tc: DataFrame) -> DataFrame:
    """All sheets side by side at (product, period, category).

    The category code is not a key of a sheet: a code used twice multiplies rows. A NULL category stays as a row but
    finds no numbers.
    """
    keys = ["product_line", "reporting_period_canonical", "category_code"]

    def own(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *keys,
            _c("measures_own_initiative").alias(f"_{name}_measures"),
            _c("measures_automated_detection").alias(f"_{name}_automated"),
            _c("vis_restriction_removal").alias(f"_{name}_removals"),
            # one side missing makes the sum missing
            (_c("account_suspension") + _c("account_termination")).alias(f"_{name}_account_actions"),
        )

    counts = (
        "notices_received", "notices_from_trusted_flaggers", "items_in_notices", "items_in_tf_notices",
        "actions_on_law", "actions_on_law_tf", "actions_on_tc", "actions_on_tc_tf",
    )
    joined = (
        _all_of([notices, illegal, tc], (*PRODUCT_PERIOD, "category_code"))
        .join(notices.select(*keys, *counts, "median_time_to_take_action_hours", "source_sha256"), keys, "left")
        .join(own(illegal, "illegal"), keys, "left")
        .join(own(tc, "tc"), keys, "left")
    )
    parts = ("measures", "automated", "removals", "account_actions")
    return joined.select(
        *PRODUCT_PERIOD,
        "category_code",
        *[_zero(c).alias(c) for c in counts],
        "median_time_to_take_action_hours",
        *[_zero(f"_{s}_{p}").alias(f"own_initiative_{s}_{p}") for s in ("illegal", "tc") for p in parts],
        (_zero("actions_on_law") + _zero("actions_on_tc") + _zero("_illegal_measures") + _zero("_tc_measures")).alias(
            "total_decisions"
        ),
        (_zero("_illegal_automated") + _zero("_tc_automated")).alias("automated_decisions"),
        "source_sha256",
    )


def _value_where(condition: Column, name: str) -> Column:
    return F.max(F.when(condition, _c("value"))).alias(name)


def automated_quality(means: DataFrame) -> DataFrame:
    """Indicator rows of the automated-means sheet as columns, per product, period and scope."""
    # fixed values: beginnings of the indicators' wording
    kind, indicator = _c("quality_metric_kind"), _c("indicator")
    return means.groupBy(*PRODUCT_PERIOD, "scope").agg(
        _value_where(kind == "accuracy", "accuracy"),
        _value_where(kind == "precision", "precision_score"),
        _value_where(kind == "recall", "recall"),
        _value_where(indicator.like("Number of measures solely taken by automated%"), "measures_solely_automated"),
        _value_where(indicator.like("Number of measures not taken by automated%"), "measures_not_automated"),
        _value_where(indicator.like("Number of notices solely processed by automated%"), "notices_solely_automated"),
        _value_where(indicator.like("Number of notices not processed by automated%"), "notices_not_automated"),
    )


def appeals_wide(appeals: DataFrame) -> DataFrame:
    """Indicator rows of the appeals sheet as columns, per product and period."""
    # fixed values: what the indicators' wording holds
    indicator = _c("indicator")
    return appeals.groupBy(*PRODUCT_PERIOD).agg(
        _value_where(indicator.like("Number of complaints submitted%"), "complaints_submitted"),
        _value_where(indicator.like("%reversed%"), "complaints_reversed"),
        _value_where(indicator.like("%upheld%"), "complaints_upheld"),
        _value_where(indicator.like("%recidivism%"), "recidivism_count"),
    )


# --- dimensions ------------------------------------------------------------------------------------------------


def dim_categories(categories: DataFrame, canonical_product: str = "main") -> DataFrame:
    """The category taxonomy, read from one product's copy; the label is the key."""
    label = _c("category_label")
    return (
        categories.filter((_c("product_line") == canonical_product) & label.isNotNull())
        .groupBy("category_label")
        .agg(F.max("category_description").alias("category_description"), F.max("category_code").alias("category_code"))
        .select(
            label.alias("category_id"),
            "category_label",
            "category_description",
            "category_code",
            ladder(
                [
                    (label == "TOTAL", "aggregate"),
                    (label.like("Category %") & (F.length(label) <= 11), "top_level"),
                ],
                "sub_category",
            ).alias("category_level"),
        )
    )


# fixed values: product line -> (name after the platform's own, service kind, audience)
PRODUCTS = {
    "main": ("Main", "music_streaming", "consumer"),
    "artists": ("for Artists", "music_artist_platform", "creator"),
    "authors": ("for Authors", "audiobook_author_platform", "creator"),
    "creators": ("for Creators", "podcast_creator_platform", "creator"),
}


def dim_products(products: DataFrame, platform: str, catalogue: dict[str, tuple[str, str, str]] = PRODUCTS) -> DataFrame:
    """All product lines of the catalogue, and those found in ``products.product_line`` besides.

    ``platform`` is the name of the platform whose reports are loaded. A product outside the catalogue keeps NULLs.
    """
    described = F.create_map(
        *[
            part
            for line, (name, service, audience) in catalogue.items()
            for part in (
                F.lit(line),
                F.struct(
                    F.lit(f"{platform} {name}").alias("display_name"),
                    F.lit(service).alias("service_kind"),
                    F.lit(audience).alias("audience_kind"),
                ),
            )
        ]
    )
    return (
        products.select("product_line")
        .filter("product_line is not null")
        .union(products.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, catalogue)))))
        .distinct()
        .withColumn("_d", F.try_element_at(described, _c("product_line")))
        .select(_c("product_line").alias("product_id"), "_d.display_name", "_d.service_kind", "_d.audience_kind")
    )


def dim_reporting_periods(aligned: DataFrame, platform: str) -> DataFrame:
    days = _c("period_days")
    return aligned.select(
        _c("reporting_period_canonical").alias("reporting_period_id"),
        "reporting_period_start",
        "reporting_period_end",
        "period_days",
        ladder([(days >= 350, "annual"), (days >= 175, "biannual"), (days >= 85, "quarterly")], "other").alias(
            "period_granularity"
        ),
        F.year("reporting_period_start").alias("calendar_year"),
        F.lit(f"{platform} DSA (2024/2835 harmonised template)").alias("reporting_framework"),
    )


# fixed values: member states by code, Greece under both its codes, and the row for undivided totals
EU_MEMBER_STATES = {
    "AT": "Austria", "BE": "Belgium", "BG": "Bulgaria", "HR": "Croatia", "CY": "Cyprus", "CZ": "Czechia",
    "DK": "Denmark", "EE": "Estonia", "FI": "Finland", "FR": "France", "DE": "Germany", "GR": "Greece",
    "EL": "Greece", "HU": "Hungary", "IE": "Ireland", "IT": "Italy", "LV": "Latvia", "LT": "Lithuania",
    "LU": "Luxembourg", "MT": "Malta", "NL": "Netherlands", "PL": "Poland", "PT": "Portugal", "RO": "Romania",
    "SK": "Slovakia", "SI": "Slovenia", "ES": "Spain", "SE": "Sweden",
    "EU_AGGREGATE": "EU Aggregate (no per-state breakdown)",
}


def member_state_seed(spark: SparkSession) -> DataFrame:
    """The reference list of member states, in the form of the seed file."""
    rows = [(code, name, True, code == "EU_AGGREGATE") for code, name in EU_MEMBER_STATES.items()]
    return spark.createDataFrame(
        rows, "member_state_code string, member_state_name string, is_eu boolean, is_aggregate boolean"
    )


def dim_member_states(seed: DataFrame) -> DataFrame:
    return seed.select(
        _c("member_state_code").alias("member_state_id"), "member_state_name", "is_eu", "is_aggregate"
    )


# --- facts -----------------------------------------------------------------------------------------------------


def fct_decisions(u: DataFrame) -> DataFrame:
    """Decision fact at (product, period, category); the TOTAL category stays in, so sums must exclude it."""
    return u.filter(_c("category_code").isNotNull()).select(
        *PRODUCT_PERIOD,
        "category_code",
        "notices_received",
        "notices_from_trusted_flaggers",
        "items_in_notices",
        "items_in_tf_notices",
        "actions_on_law",
        "actions_on_tc",
        (_c("actions_on_law") + _c("actions_on_tc")).alias("actions_on_notice_total"),
        "own_initiative_illegal_measures",
        "own_initiative_illegal_automated",
        "own_initiative_tc_measures",
        "own_initiative_tc_automated",
        "total_decisions",
        "automated_decisions",
        pct(_c("automated_decisions"), _c("total_decisions")).alias("automated_share_pct"),
        "median_time_to_take_action_hours",
        "source_sha256",
    )


def fct_appeals(wide: DataFrame) -> DataFrame:
    return wide.select(
        *PRODUCT_PERIOD,
        "complaints_submitted",
        "complaints_reversed",
        "complaints_upheld",
        "recidivism_count",
        pct(_c("complaints_reversed"), _c("complaints_submitted")).alias("reversal_rate_pct"),
    )


def fct_eu_orders(orders: DataFrame) -> DataFrame:
    """Orders of authorities; reports only disclose EU totals, so every row belongs to the aggregate state."""
    return orders.filter(_c("category_code").isNotNull()).select(
        *PRODUCT_PERIOD,
        "category_code",
        "scope",
        F.lit("EU_AGGREGATE").alias("member_state_id"),
        "orders_to_act",
        "items_in_orders_to_act",
        "median_time_to_inform_act_hours",
        "median_time_to_give_effect_act_hours",
        "orders_to_provide_info",
        "median_time_to_inform_info_hours",
        "median_time_to_give_effect_info_hours",
        "source_sha256",
    )


# --- reports ---------------------------------------------------------------------------------------------------


def cross_product_summary(
    notices: DataFrame,
    illegal: DataFrame,
    tc: DataFrame,
    appeals: DataFrame,
    quality: DataFrame,
    by_period: bool = True,
) -> DataFrame:
    """One row per product and period: notice, own-initiative, complaint and automation-quality totals.

    ``appeals`` and ``quality`` are the wide forms. ``by_period=False`` joins on the product alone; that is the same
    for one period and multiplies rows for several.
    """
    keys = ["product_line", "reporting_period_canonical"] if by_period else ["product_line"]

    def own(df: DataFrame, name: str) -> DataFrame:
        return df.filter(_c("category_code") == "TOTAL").select(
            *keys,
            _c("measures_own_initiative").alias(f"_{name}"),
            _c("measures_automated_detection").alias(f"_{name}_automated"),
        )

    scored = quality.filter(_c("scope") == "Total number").select(
        *keys, "accuracy", "precision_score", "recall", "measures_solely_automated", "measures_not_automated"
    )
    on_notices = _c("actions_on_law") + _c("actions_on_tc")
    own_total = _zero("_illegal") + _zero("_tc")
    decisions, automated = _c("total_decisions"), _c("automated_decisions")
    return (
        notices.filter(_c("category_code") == "TOTAL")
        .join(own(illegal, "illegal"), keys, "left")
        .join(own(tc, "tc"), keys, "left")
        .join(appeals.select(*keys, "complaints_submitted"), keys, "left")
        .join(scored, keys, "left")
        .withColumn("total_decisions", on_notices + own_total)
        .withColumn("automated_decisions", _zero("_illegal_automated") + _zero("_tc_automated"))
        .select(
            *PRODUCT_PERIOD,
            "notices_received",
            "items_in_notices",
            "actions_on_law",
            "actions_on_tc",
            on_notices.alias("notice_actions_total"),
            _zero("_illegal").alias("own_initiative_illegal"),
            _zero("_tc").alias("own_initiative_tc"),
            own_total.alias("own_initiative_total"),
            "total_decisions",
            "automated_decisions",
            pct(automated, decisions).alias("automated_share_pct"),
            "median_time_to_take_action_hours",
            _zero("complaints_submitted").alias("complaints_submitted"),
            F.round(100.0 * _c("accuracy"), 2).alias("automated_accuracy_pct"),
            F.round(100.0 * _c("precision_score"), 2).alias("automated_precision_pct"),
            F.round(100.0 * _c("recall"), 2).alias("automated_recall_pct"),
            "measures_solely_automated",
            "measures_not_automated",
        )
    )


def period_trends(summary: DataFrame) -> DataFrame:
    """Summary rows in period order with the change against the period before.

    The window spans the reporting periods of one product: a handful of already aggregated rows.
    """
    product = Window.partitionBy("product_line")
    ordered = product.orderBy("reporting_period_start")

    def change(name: str) -> Column:
        return _c(name) - F.lag(name).over(ordered)

    return summary.select(
        *PRODUCT_PERIOD,
        F.row_number().over(ordered).alias("period_seq"),
        F.count(F.lit(1)).over(product).alias("n_periods_available"),
        "total_decisions",
        "automated_decisions",
        "automated_share_pct",
        "notices_received",
        "notice_actions_total",
        "complaints_submitted",
        "automated_accuracy_pct",
        "automated_precision_pct",
        "automated_recall_pct",
        change("total_decisions").alias("total_decisions_delta_vs_prior"),
        change("automated_share_pct").alias("automated_share_delta_vs_prior"),
    )


def automated_vs_human(summary: DataFrame) -> DataFrame:
    """Automation share and the posture read off the gap between accuracy and recall."""
    solely, other = _c("measures_solely_automated"), _c("measures_not_automated")
    accuracy, recall = _c("automated_accuracy_pct"), _c("automated_recall_pct")
    return summary.select(
        "product_line",
        "reporting_period_canonical",
        "total_decisions",
        "automated_decisions",
        "automated_share_pct",
        solely,
        other,
        pct(solely, solely + other).alias("measures_solely_automated_share_pct"),
        accuracy,
        "automated_precision_pct",
        recall,
        # fixed values: gaps in percentage points
        ladder([(accuracy - recall >= 3.0, "conservative"), (recall - accuracy >= 0.5, "aggressive")], "balanced").alias(
            "automation_posture"
        ),
    )


def appeals_lifecycle(appeals_fact: DataFrame, summary: DataFrame) -> DataFrame:
    keys = ["product_line", "reporting_period_canonical"]
    return (
        appeals_fact.join(summary.select(*keys, "total_decisions"), keys, "left")
        .select(
            *PRODUCT_PERIOD,
            "complaints_submitted",
            "complaints_reversed",
            "complaints_upheld",
            "recidivism_count",
            "reversal_rate_pct",
            "total_decisions",
            pct(_c("complaints_submitted"), _c("total_decisions")).alias("complaints_per_100_decisions"),
        )
    )


def member_state_breakdown(orders_fact: DataFrame, states: DataFrame) -> DataFrame:
    """Order totals per product, period and member state. Facts are added up before the state name is looked up."""
    keys = ["product_line", "reporting_period_canonical", "member_state_id"]
    totals = (
        orders_fact.filter(_c("scope") == "TOTAL")
        .groupBy(*keys)
        .agg(
            *[F.sum(c).alias(c) for c in ("orders_to_act", "items_in_orders_to_act", "orders_to_provide_info")],
            *[
                F.avg(c).alias(f"avg_{c}")
                for c in ("median_time_to_inform_act_hours", "median_time_to_give_effect_act_hours")
            ],
        )
    )
    named = states.select("member_state_id", "member_state_name", "is_aggregate")
    return totals.join(named, "member_state_id", "left").select(
        *keys, "member_state_name", "is_aggregate", *[c for c in totals.columns if c not in keys]
    )
