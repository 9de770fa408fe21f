"""All marts from bronze tables, and how they are stored.

Every function takes ``keep``, which is given each mart as soon as it is described and returns the table that later ones
read. By default that is the description itself and nothing runs; ``written`` stores the mart and hands back what was
written, so that work shared by several marts is done once. ``store`` writes a layer that was only described.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from glasswatch.config import FixedPeriod, PeriodConfig, SignalConfig
from glasswatch.operators import researcher, signals, staging, transparency, verdicts
from glasswatch.sources.sinks import write_mart

Tables = dict[str, DataFrame]
Keep = Callable[[str, DataFrame], DataFrame]

# marts that are read by product and period are stored that way
PARTITIONS = {
    "fct_dsa_decisions": ("product_line", "reporting_period_canonical"),
    "fct_dsa_eu_orders": ("product_line", "reporting_period_canonical"),
    "fct_researcher_queries": ("query_date",),
}


def described(name: str, df: DataFrame) -> DataFrame:
    return df


def written(spark: SparkSession, root: str) -> Keep:
    """Writes every mart below ``root``, once, and returns the written table."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        write_mart(df, path, PARTITIONS.get(name, ()))
        return spark.read.schema(df.schema).parquet(path)

    return keep


def store(spark: SparkSession, marts: Tables, root: str) -> Tables:
    """Write every mart below ``root`` and return the written tables."""
    keep = written(spark, root)
    return {name: keep(name, df) for name, df in marts.items()}


def staged_sheets(bronze: Tables, period: PeriodConfig = FixedPeriod()) -> Tables:
    """The nine report sheets; ``bronze`` is keyed by sheet name."""
    return {f"stg_dsa_{sheet}": staging.stage_sheet(bronze[sheet], sheet, period) for sheet in staging.SHEETS}


def staged_tables(bronze: Tables) -> Tables:
    """The other bronze tables that are there, under their staging names."""
    plain = ("llm_verdicts", "researcher_keys", "researcher_queries")
    return {
        f"stg_{'' if name in plain else 'synth_'}{name}": staging.stage_table(bronze[name], name)
        for name in staging.TABLES
        if name in bronze
    }


def transparency_marts(stg: Tables, member_states: DataFrame, platform: str, keep: Keep = described) -> Tables:
    notices, illegal, tc = (
        stg[f"stg_dsa_{s}"] for s in ("notices", "own_initiative_illegal", "own_initiative_tc")
    )
    out: Tables = {}

    def mart(name: str, df: DataFrame) -> DataFrame:
        out[name] = keep(name, df)
        return out[name]

    aligned = mart("int_dsa_period_aligned", transparency.period_aligned(notices, illegal, tc))
    unified = mart("int_dsa_unified", transparency.unified(notices, illegal, tc))
    quality = mart("int_dsa_automated_quality", transparency.automated_quality(stg["stg_dsa_automated_means"]))
    wide_appeals = mart("int_dsa_appeals", transparency.appeals_wide(stg["stg_dsa_appeals_and_recidivism"]))
    mart("dim_dsa_categories", transparency.dim_categories(stg["stg_dsa_categories_names"]))
    mart("dim_dsa_products", transparency.dim_products(stg["stg_dsa_report_identification"], platform))
    mart("dim_dsa_reporting_periods", transparency.dim_reporting_periods(aligned, platform))
    states = mart("dim_eu_member_states", transparency.dim_member_states(member_states))
    mart("fct_dsa_decisions", transparency.fct_decisions(unified))
    appeals = mart("fct_dsa_appeals", transparency.fct_appeals(wide_appeals))
    orders = mart("fct_dsa_eu_orders", transparency.fct_eu_orders(stg["stg_dsa_member_states_orders"]))
    summary = mart(
        "rpt_cross_product_summary", transparency.cross_product_summary(notices, illegal, tc, wide_appeals, quality)
    )
    mart("rpt_quarter_over_quarter_trends", transparency.period_trends(summary))
    mart("rpt_automated_vs_human", transparency.automated_vs_human(summary))
    mart("rpt_appeals_lifecycle", transparency.appeals_lifecycle(appeals, summary))
    mart("rpt_member_state_breakdown", transparency.member_state_breakdown(orders, states))
    return out


def safety_marts(stg: Tables, cfg: SignalConfig = SignalConfig(), keep: Keep = described) -> Tables:
    """Signals and flags. Plays are read for three aggregates, which ``keep`` may store; all six marts come from these."""
    streams, users, tracks, artists = (stg[f"stg_synth_{n}"] for n in ("streams", "users", "tracks", "artists"))
    counts = signals.PlayCounts(*(keep(f"int_plays_{n}", df) for n, df in signals.play_counts(streams, cfg)._asdict().items()))
    marts = {
        "sig_listen_spike": signals.listen_spike_of(counts.countries, cfg),
        "sig_geo_anomaly": signals.geo_anomaly_of(counts.countries, tracks, artists, cfg),
        "sig_stream_to_listener_ratio": signals.ratio_of(counts.listeners, cfg),
        "sig_repeat_listener_concentration": signals.concentration_of(counts.listeners, users, cfg),
        "sig_playlist_stuffing": signals.stuffing_of(counts.pairs, tracks, cfg),
        "fct_artificial_streaming_flags": signals.flags_of(counts, users, tracks, artists, cfg),
    }
    return {name: keep(name, df) for name, df in marts.items()}


def verdict_marts(stg: Tables, flags: DataFrame, keep: Keep = described) -> Tables:
    """``flags`` should be the stored mart. Cost, latency and drift use no column of it and read the staged verdicts."""
    staged = stg["stg_llm_verdicts"]
    fact = keep("fct_llm_verdicts", verdicts.with_heuristic(staged, flags))
    reports = {
        "rpt_llm_agreement_rate": verdicts.agreement_rate(fact),
        "rpt_llm_cost_breakdown": verdicts.cost_breakdown(staged),
        "rpt_llm_latency_distribution": verdicts.latency_distribution(staged),
        "rpt_llm_drift_score": verdicts.drift_score(staged.withColumnRenamed("recommendation", "llm_recommendation")),
    }
    return {"fct_llm_verdicts": fact} | {name: keep(name, df) for name, df in reports.items()}


def researcher_marts(stg: Tables, built_at: Column | None = None, keep: Keep = described) -> Tables:
    keys = keep("dim_researcher_keys", researcher.dim_keys(stg["stg_researcher_keys"], built_at))
    fact = keep("fct_researcher_queries", researcher.fct_queries(stg["stg_researcher_queries"], keys))
    audit = keep("rpt_researcher_query_audit", researcher.query_audit(fact))
    return {"dim_researcher_keys": keys, "fct_researcher_queries": fact, "rpt_researcher_query_audit": audit}
