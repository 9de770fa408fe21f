"""Artificial-streaming signals and the composite suspicion score.

Inputs are the staged tables: streams (track_id, user_id, streamed_at, stream_country_iso2, session_id), users
(user_id, household_id), tracks (track_id, artist_id, ai_generated_label) and artists (artist_id, country_iso2).

Every per-track number is a count, sum, max or min, so each step combines on the map side before it shuffles, and a
track holding a large share of all plays costs one partial row per task. Nothing is ranked in a window and no side is
broadcast by hint; AQE picks broadcast joins from measured sizes and splits skewed join partitions.

All five signals follow from three aggregates of the plays, ``per_listener``, ``per_country`` and ``session_pairs``. Whoever needs
several of them writes the aggregates once (``PlayCounts``); ``operators.daily`` keeps them per day.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.config import SignalConfig
from glasswatch.functions.expressions import count_when, flag, ladder, safe_ratio
from glasswatch.functions.joins import spread_join


def _rows() -> Column:
    return F.count(F.lit(1))


def _in_recent(cfg: SignalConfig) -> Column:
    # compares the raw column, so the range reaches the Parquet reader
    return F.col("streamed_at") >= F.lit(cfg.recent_from).cast("timestamp_ntz")


def _in_window(cfg: SignalConfig) -> Column:
    return F.col("streamed_at") >= F.lit(cfg.window_from).cast("timestamp_ntz")


def _capped(severity: Column, cfg: SignalConfig) -> Column:
    # least() skips NULL, so an unknown severity becomes the cap
    return F.least(F.lit(cfg.severity_cap), severity)


def _days_of_window(streams: DataFrame, cfg: SignalConfig) -> DataFrame:
    """Only the days of the window, where plays are stored by day. The last day has no bound, as the window has none."""
    if "play_day" not in streams.columns:
        return streams
    return streams.filter(F.col("play_day") >= F.lit(cfg.window_from.date()))


def plays_of_days(streams: DataFrame, days: DataFrame) -> DataFrame:
    """Plays, stored by day, of the days in the column ``play_day`` of ``days``.

    The days are known when ``days`` was read: the scan of the plays opens their folders only (dynamic partition pruning).
    """
    return streams.join(days.select("play_day").distinct(), "play_day", "left_semi")


def _entity() -> Column:
    return F.lit("track").alias("entity_kind")


# --- aggregates of the plays -----------------------------------------------------------------------------------


class PlayCounts(NamedTuple):
    """What the signals need of the plays.

    ``listeners``: ``track_id, user_id, n``; ``countries``: ``track_id, stream_country_iso2, n, recent, baseline``;
    ``pairs``: distinct ``session_id, track_id``, neither of them NULL.
    """

    listeners: DataFrame
    countries: DataFrame
    pairs: DataFrame


def per_listener(streams: DataFrame) -> DataFrame:
    """Plays of each user on each track."""
    return streams.groupBy("track_id", "user_id").agg(_rows().alias("n"))


def per_country(streams: DataFrame, cfg: SignalConfig) -> DataFrame:
    """Plays of each track from each country: all, recent ones, and those of the days before."""
    recent = _in_recent(cfg)
    return streams.groupBy("track_id", "stream_country_iso2").agg(
        _rows().alias("n"),
        count_when(recent).alias("recent"),
        count_when(_in_window(cfg) & ~recent).alias("baseline"),
    )


def session_pairs(streams: DataFrame) -> DataFrame:
    """Each track once for each session it was played in."""
    # the joins below drop NULLs; saying so here keeps the pairs the same for both, so they are shuffled once
    return streams.select("session_id", "track_id").filter("session_id is not null and track_id is not null").distinct()


def play_counts(streams: DataFrame, cfg: SignalConfig = SignalConfig()) -> PlayCounts:
    return PlayCounts(per_listener(streams), per_country(streams, cfg), session_pairs(streams))


# --- listen spike ----------------------------------------------------------------------------------------------


def _spike_ratio(recent: Column, baseline: Column, cfg: SignalConfig) -> Column:
    per_day = recent.cast("double") / cfg.recent_days
    usual = F.greatest(baseline.cast("double") / cfg.baseline_days, F.lit(cfg.spike_min_baseline_per_day))
    return per_day / usual


def listen_spike(streams: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Plays per day in the recent window against the days before it; fires strictly above the multiplier.

    Plays stored by day (``sinks.write_by_day``) have a column ``play_day``: folders of days before the window aren't opened.
    """
    recent = _in_recent(cfg)
    return spike_of(
        _days_of_window(streams, cfg)
        .filter(_in_window(cfg))
        .groupBy("track_id")
        .agg(count_when(recent).alias("recent_streams"), count_when(~recent).alias("baseline_streams")),
        cfg,
    )


def listen_spike_of(countries: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """The same from ``per_country``."""
    return spike_of(
        countries.groupBy("track_id").agg(F.sum("recent").alias("recent_streams"), F.sum("baseline").alias("baseline_streams")), cfg
    )


def spike_of(per_track: DataFrame, cfg: SignalConfig) -> DataFrame:
    ratio = F.col("spike_ratio")
    return per_track.filter("recent_streams > 0").withColumn(
        "spike_ratio", _spike_ratio(F.col("recent_streams"), F.col("baseline_streams"), cfg)
    ).select(
        "track_id",
        _entity(),
        "recent_streams",
        "baseline_streams",
        (F.col("recent_streams").cast("double") / cfg.recent_days).alias("recent_per_day"),
        (F.col("baseline_streams").cast("double") / cfg.baseline_days).alias("baseline_per_day"),
        "spike_ratio",
        flag(ratio > cfg.spike_multiplier).alias("fires"),
        _capped(ratio / cfg.spike_multiplier, cfg).alias("severity"),
    )


# --- geo anomaly -----------------------------------------------------------------------------------------------


def _home_country(tracks: DataFrame, artists: DataFrame) -> DataFrame:
    return tracks.select("track_id", "artist_id").join(
        artists.select("artist_id", F.col("country_iso2").alias("artist_country")), "artist_id", "left"
    ).select("track_id", "artist_country")


def _top_country() -> Column:
    # most plays first, then the smaller country code, NULL before any code
    return F.min_by("stream_country_iso2", F.struct((-F.col("n")).alias("n"), F.col("stream_country_iso2")))


def _geo_fires(cfg: SignalConfig) -> Column:
    return flag(
        (F.col("top_country_share") >= cfg.geo_share)
        & (F.col("total_streams") >= cfg.geo_min_streams)
        & (F.col("top_country") != F.col("artist_country"))
    )


def _geo_severity(cfg: SignalConfig) -> Column:
    # fixed values: 0.50 share scores zero, every further 0.20 one point
    return _capped((F.col("top_country_share") - 0.50) / 0.20, cfg)


def geo_anomaly(
    streams: DataFrame, tracks: DataFrame, artists: DataFrame, cfg: SignalConfig = SignalConfig()
) -> DataFrame:
    """Share of the strongest country per track; fires when it is high, well supported and not the artist's home."""
    return geo_anomaly_of(streams.groupBy("track_id", "stream_country_iso2").agg(_rows().alias("n")), tracks, artists, cfg)


def geo_anomaly_of(
    countries: DataFrame, tracks: DataFrame, artists: DataFrame, cfg: SignalConfig = SignalConfig()
) -> DataFrame:
    """The same from plays per track and country."""
    per_track = (
        countries.groupBy("track_id")
        .agg(
            _top_country().alias("top_country"),
            F.max("n").alias("top_country_streams"),
            F.sum("n").alias("total_streams"),
            _rows().alias("n_distinct_countries"),
        )
        .withColumn("top_country_share", safe_ratio(F.col("top_country_streams"), F.col("total_streams")))
    )
    return per_track.join(_home_country(tracks, artists), "track_id").select(
        "track_id",
        _entity(),
        "artist_country",
        "top_country",
        "top_country_streams",
        "total_streams",
        "n_distinct_countries",
        "top_country_share",
        _geo_fires(cfg).alias("fires"),
        _geo_severity(cfg).alias("severity"),
    )


# --- streams per listener --------------------------------------------------------------------------------------


def _ratio_fires(cfg: SignalConfig) -> Column:
    return flag(
        (F.col("total_streams") >= cfg.ratio_min_streams) & (F.col("streams_per_listener") >= cfg.ratio_threshold)
    )


def stream_to_listener_ratio(streams: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Plays per distinct listener of a track."""
    # two plain aggregates: the first is spread over (track, user), the second adds one partial row per task
    return ratio_of(per_listener(streams), cfg)


def ratio_of(listeners: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """The same from ``per_listener``."""
    per_track = (
        listeners.groupBy("track_id")
        .agg(F.sum("n").alias("total_streams"), F.count("user_id").alias("distinct_listeners"))
        .withColumn("streams_per_listener", safe_ratio(F.col("total_streams"), F.col("distinct_listeners")))
    )
    return per_track.select(
        "track_id",
        _entity(),
        "total_streams",
        "distinct_listeners",
        "streams_per_listener",
        _ratio_fires(cfg).alias("fires"),
        _capped(F.col("streams_per_listener") / cfg.ratio_threshold, cfg).alias("severity"),
    )


# --- repeat listener concentration -----------------------------------------------------------------------------


def _hhi(squares: Column, total: Column) -> Column:
    # sum of squared shares as one division: exact for whole counts, and no second pass to fetch the total
    t = total.cast("double")
    return F.try_divide(squares, t * t)


def _hhi_fires(total: Column, hhi: Column, cfg: SignalConfig) -> Column:
    return flag((total >= cfg.hhi_min_streams) & (hhi >= cfg.hhi_threshold))


def _squared(c: Column) -> Column:
    return F.pow(c.cast("double"), F.lit(2.0))


def repeat_listener_concentration(
    streams: DataFrame, users: DataFrame, cfg: SignalConfig = SignalConfig()
) -> DataFrame:
    """Herfindahl index of a track's plays over households."""
    # plays of a user on a track collapse before the join, so a heavy user brings few rows into it
    return concentration_of(per_listener(streams), users, cfg)


def concentration_of(listeners: DataFrame, users: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """The same from ``per_listener``."""
    per_track = (
        listeners.join(users.select("user_id", "household_id"), "user_id")
        .groupBy("track_id", "household_id")
        .agg(F.sum("n").alias("n"))
        .groupBy("track_id")
        .agg(
            F.sum("n").alias("total_streams"),
            _rows().alias("distinct_households"),
            F.sum(_squared(F.col("n"))).alias("_squares"),
            F.max("n").alias("_top"),
        )
        .withColumn("hhi_value", _hhi(F.col("_squares"), F.col("total_streams")))
    )
    return per_track.select(
        "track_id",
        _entity(),
        "total_streams",
        "distinct_households",
        "hhi_value",
        safe_ratio(F.col("_top"), F.col("total_streams")).alias("top_household_share"),
        _hhi_fires(F.col("total_streams"), F.col("hhi_value"), cfg).alias("fires"),
        _capped(F.col("hhi_value") / cfg.hhi_threshold, cfg).alias("severity"),
    )


# --- playlist stuffing -----------------------------------------------------------------------------------------


def playlist_stuffing(streams: DataFrame, tracks: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Tracks played in a session that holds many distinct tracks, most of them labelled as generated.

    Only firing tracks appear. A track labelled both ways counts as generated once; an unknown label does not count.
    """
    return stuffing_of(session_pairs(streams), tracks, cfg)


def stuffing_of(pairs: DataFrame, tracks: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """The same from ``session_pairs``: a track looped in one session, or a huge number of plays of one track, is one row there."""
    labels = tracks.groupBy("track_id").agg(
        F.max(flag(F.col("ai_generated_label"))).alias("ai")
    ).filter(F.col("track_id").isNotNull())
    share = F.try_divide(F.col("ai_tracks").cast("double"), F.col("distinct_tracks"))
    stuffed = (
        spread_join(pairs, labels, ["track_id"], spread_by=["session_id"])
        .groupBy("session_id")
        .agg(_rows().alias("distinct_tracks"), F.sum("ai").alias("ai_tracks"))
        .withColumn("ai_share", share)
        .filter((F.col("distinct_tracks") >= cfg.stuffing_min_tracks) & (F.col("ai_share") >= cfg.stuffing_ai_share))
    )
    # Unknown tracks come along on the way back and are dropped at the end, when there is one row per track. Labels have
    # one row per track too, so an inner join does it; a semi join would be pushed down to the plays.
    return (
        spread_join(pairs, stuffed, ["session_id"], spread_by=["track_id"])
        .groupBy("track_id")
        .agg(
            F.max("distinct_tracks").alias("session_distinct_tracks"),
            F.max("ai_tracks").alias("session_ai_tracks"),
            F.max("ai_share").alias("session_ai_share"),
        )
        .join(labels.select("track_id"), "track_id")
        .select(
            "track_id",
            _entity(),
            "session_distinct_tracks",
            "session_ai_tracks",
            "session_ai_share",
            F.lit(1).alias("fires"),
            _capped(F.col("session_ai_share") / cfg.stuffing_ai_share, cfg).alias("severity"),
        )
    )


# --- composite -------------------------------------------------------------------------------------------------


def _listener_profile(listeners: DataFrame, users: DataFrame, cfg: SignalConfig) -> DataFrame:
    """Listener ratio and household concentration of every streamed track, from plays per listener.

    A user id listed twice counts in each of its households, but its plays are the track's only once: so the track's own
    counts come from the listeners, those of households from their join with the users. Users without id join with nothing.
    """
    total, count = F.col("total_streams"), F.col("distinct_listeners")
    own = listeners.groupBy("track_id").agg(F.sum("n").alias("total_streams"), F.count("user_id").alias("distinct_listeners"))
    homes = (
        listeners.join(users.select("user_id", "household_id"), "user_id")
        .groupBy("track_id", "household_id")
        .agg(F.sum("n").alias("n"))
        .groupBy("track_id")
        .agg(F.sum("n").alias("_hh_total"), F.sum(_squared(F.col("n"))).alias("_squares"))
    )
    per_track = (
        own.join(homes, "track_id", "left")
        .withColumn("streams_per_listener", safe_ratio(total, count))
        .withColumn("_hhi", _hhi(F.col("_squares"), F.col("_hh_total")))
    )
    in_households = F.col("_hh_total").isNotNull()
    return per_track.select(
        "track_id",
        _ratio_fires(cfg).alias("s2l_ratio_fires"),
        _capped(F.col("streams_per_listener") / cfg.ratio_threshold, cfg).alias("s2l_ratio_severity"),
        _hhi_fires(F.col("_hh_total"), F.col("_hhi"), cfg).alias("repeat_listener_fires"),
        F.when(in_households, _capped(F.col("_hhi") / cfg.hhi_threshold, cfg)).alias("repeat_listener_severity"),
    )


def _country_profile(countries: DataFrame, tracks: DataFrame, artists: DataFrame, cfg: SignalConfig) -> DataFrame:
    """Spike and geo signal of every streamed track, from plays per country."""
    per_track = (
        countries.groupBy("track_id")
        .agg(
            _top_country().alias("top_country"),
            F.max("n").alias("_top"),
            F.sum("n").alias("total_streams"),
            F.sum("recent").alias("recent"),
            F.sum("baseline").alias("baseline"),
        )
        .withColumn("top_country_share", safe_ratio(F.col("_top"), F.col("total_streams")))
        .withColumn("_ratio", _spike_ratio(F.col("recent"), F.col("baseline"), cfg))
    )
    home = _home_country(tracks, artists).withColumn("_listed", F.lit(True))
    spiking, listed = F.col("recent") > 0, F.col("_listed")
    return per_track.join(home, "track_id", "left").select(
        "track_id",
        F.when(spiking, flag(F.col("_ratio") > cfg.spike_multiplier)).alias("listen_spike_fires"),
        F.when(spiking, _capped(F.col("_ratio") / cfg.spike_multiplier, cfg)).alias("listen_spike_severity"),
        F.when(listed, _geo_fires(cfg)).alias("geo_anomaly_fires"),
        F.when(listed, _geo_severity(cfg)).alias("geo_anomaly_severity"),
    )


# order matters: the score adds the terms in this order
SIGNAL_COLUMNS = ("listen_spike", "geo_anomaly", "s2l_ratio", "repeat_listener", "playlist_stuffing")


def score_flags(signals: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """Count, score and action from the ten ``<signal>_fires`` / ``<signal>_severity`` columns (missing = 0)."""
    weights = dict(
        zip(
            SIGNAL_COLUMNS,
            (cfg.weight_spike, cfg.weight_geo, cfg.weight_ratio, cfg.weight_concentration, cfg.weight_stuffing),
            strict=True,
        )
    )
    # a NULL track id never finds its signals
    known = F.col("track_id").isNotNull()
    filled = []
    for s in SIGNAL_COLUMNS:
        for suffix, zero in (("fires", F.lit(0)), ("severity", F.lit(0.0))):
            name = f"{s}_{suffix}"
            filled.append(F.coalesce(F.when(known, F.col(name)), zero).alias(name))
    fired = [F.col(f"{s}_fires") for s in SIGNAL_COLUMNS]
    terms = [F.col(f"{s}_fires") * F.col(f"{s}_severity") * weights[s] for s in SIGNAL_COLUMNS]
    score = F.col("composite_suspicion_score")
    return (
        signals.select("track_id", *filled)
        .withColumn("n_signals_fired", sum(fired[1:], fired[0]))
        .withColumn("composite_suspicion_score", F.least(F.lit(100.0), F.lit(100.0) * sum(terms[1:], terms[0])))
        .withColumn(
            "recommended_action",
            ladder(
                [(score >= cfg.remove_at, "recommend_remove"), (score >= cfg.rank_lower_at, "recommend_rank_lower")],
                "no_action",
            ),
        )
        .withColumn("built_at", F.lit(cfg.built_at).cast("timestamp_ntz"))
    )


def artificial_streaming_flags(
    streams: DataFrame,
    users: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    cfg: SignalConfig = SignalConfig(),
) -> DataFrame:
    """One row per streamed track: five signals, the 0-100 score and the recommended action.

    All five signals only name streamed tracks, and the listener profile has every one of them, so it is the spine.
    The three profiles end in an aggregate by track and are joined on it without another shuffle.
    """
    return flags_of(play_counts(streams, cfg), users, tracks, artists, cfg)


def flags_of(
    counts: PlayCounts, users: DataFrame, tracks: DataFrame, artists: DataFrame, cfg: SignalConfig = SignalConfig()
) -> DataFrame:
    """The same from the aggregates of the plays."""
    stuffing = stuffing_of(counts.pairs, tracks, cfg).select(
        "track_id",
        F.col("fires").alias("playlist_stuffing_fires"),
        F.col("severity").alias("playlist_stuffing_severity"),
    )
    signals = (
        _listener_profile(counts.listeners, users, cfg)
        .join(_country_profile(counts.countries, tracks, artists, cfg), "track_id", "left")
        .join(stuffing, "track_id", "left")
    )
    return score_flags(signals, cfg)
