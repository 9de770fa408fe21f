"""Methodology settings: one frozen dataclass per product area.

The numbers below are fixed values of the published methodology. Passing a changed copy (``dataclasses.replace``)
re-tunes every operator that takes the config.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SignalConfig:
    """Thresholds, weights and cut-offs of the artificial-streaming score."""

    # fixed values: time frame of the spike signal
    reference_time: datetime = datetime(2026, 5, 1)
    recent_days: int = 7
    baseline_days: int = 83

    # fixed values: thresholds per signal
    spike_multiplier: float = 10.0
    spike_min_baseline_per_day: float = 0.10
    geo_share: float = 0.80
    geo_min_streams: int = 100
    ratio_threshold: float = 4.0
    ratio_min_streams: int = 200
    hhi_threshold: float = 0.20
    hhi_min_streams: int = 50
    stuffing_ai_share: float = 0.50
    stuffing_min_tracks: int = 5

    # fixed values: weights of the composite score
    weight_spike: float = 0.30
    weight_geo: float = 0.50
    weight_ratio: float = 0.30
    weight_concentration: float = 0.40
    weight_stuffing: float = 0.50

    # fixed values: cap of one signal's severity, score cut-offs of the two actions
    severity_cap: float = 3.0
    remove_at: float = 70
    rank_lower_at: float = 40

    built_at: datetime = datetime(2026, 5, 1)

    @property
    def recent_from(self) -> datetime:
        return self.reference_time - timedelta(days=self.recent_days)

    @property
    def window_from(self) -> datetime:
        return self.reference_time - timedelta(days=self.recent_days + self.baseline_days)


@dataclass(frozen=True)
class FixedPeriod:
    """Every sheet row belongs to one reporting period."""

    canonical: str = "annual_2025"
    start: date = date(2025, 1, 1)
    end: date = date(2025, 12, 31)

    def columns(self) -> tuple[Column, Column, Column]:
        return F.lit(self.canonical), F.lit(self.start), F.lit(self.end)


@dataclass(frozen=True)
class YearlyPeriods:
    """The period is read from a source column holding ``annual_YYYY``; use it once several years are loaded."""

    column: str = "source_period"

    def columns(self) -> tuple[Column, Column, Column]:
        year = F.regexp_extract(F.col(self.column), r"^annual_(\d{4})$", 1).try_cast("int")
        return (
            F.col(self.column),
            F.make_date(year, F.lit(1), F.lit(1)),
            F.make_date(year, F.lit(12), F.lit(31)),
        )


PeriodConfig = FixedPeriod | YearlyPeriods


@dataclass(frozen=True)
class VerdictConfig:
    """Limits of the model-verdict job."""

    # fixed values: US dollars per million input / output tokens, by provider
    prices: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "anthropic": (3.00, 15.00),
            "openai": (2.50, 10.00),
            "google": (0.30, 2.50),
        }
    )
    budget_usd: float = 10.0

    # fixed values: allowed answers
    recommendations: tuple[str, ...] = ("recommend_no_action", "recommend_rank_lower", "recommend_remove")
    primary_signals: tuple[str, ...] = (
        "listen_spike",
        "geo_anomaly",
        "stream_to_listener_ratio",
        "repeat_listener_concentration",
        "playlist_stuffing",
        "none",
    )


@dataclass(frozen=True)
class RateLimit:
    """Requests one key may make in a trailing window."""

    requests: int = 100
    minutes: int = 15
