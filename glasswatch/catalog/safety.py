"""Signals and flags."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import cte, register
from glasswatch.catalog.store import stored
from glasswatch.operators import daily, signals
from glasswatch.session import new_path
from glasswatch.sources import sinks

_C = t.SIGNALS
_RECENT = f"TIMESTAMP '{_C.recent_from}'"
_WINDOW = f"TIMESTAMP '{_C.window_from}'"
_CAP = f"CAST({_C.severity_cap} AS DOUBLE)"

cte(
    "sig_spike",
    f"""SELECT *, CASE WHEN spike_ratio > {_C.spike_multiplier} THEN 1 ELSE 0 END AS fires,
  least({_CAP}, spike_ratio / {_C.spike_multiplier}) AS severity
FROM (SELECT *, recent_per_day / greatest(baseline_per_day, CAST({_C.spike_min_baseline_per_day} AS DOUBLE)) AS spike_ratio
  FROM (SELECT track_id, count(*) FILTER (streamed_at >= {_RECENT}) AS recent_streams,
      count(*) FILTER (streamed_at < {_RECENT}) AS baseline_streams,
      CAST(recent_streams AS DOUBLE) / {_C.recent_days} AS recent_per_day,
      CAST(baseline_streams AS DOUBLE) / {_C.baseline_days} AS baseline_per_day
    FROM streams WHERE streamed_at >= {_WINDOW} GROUP BY track_id)
  WHERE recent_streams > 0)""",
    "streams",
)
cte(
    "sig_geo",
    f"""SELECT *,
  CASE WHEN top_country_share >= {_C.geo_share} AND total_streams >= {_C.geo_min_streams}
    AND top_country <> artist_country THEN 1 ELSE 0 END AS fires,
  least({_CAP}, (top_country_share - CAST(0.5 AS DOUBLE)) / CAST(0.2 AS DOUBLE)) AS severity
FROM (SELECT p.track_id, a.home AS artist_country, p.country AS top_country, p.n AS top_country_streams,
    p.total AS total_streams, p.n_countries AS n_distinct_countries, CAST(p.n AS DOUBLE) / p.total AS top_country_share
  FROM (SELECT track_id, country, count(*) AS n, CAST(sum(count(*)) OVER w AS BIGINT) AS total,
      count(*) OVER w AS n_countries,
      row_number() OVER (PARTITION BY track_id ORDER BY count(*) DESC, country NULLS FIRST) AS place
    FROM streams GROUP BY track_id, country WINDOW w AS (PARTITION BY track_id)) p
  JOIN tracks USING (track_id) LEFT JOIN artists a USING (artist_id) WHERE place = 1)""",
    "streams", "tracks", "artists",
)
cte(
    "sig_ratio",
    f"""SELECT *, CASE WHEN total_streams >= {_C.ratio_min_streams}
    AND streams_per_listener >= {_C.ratio_threshold} THEN 1 ELSE 0 END AS fires,
  least({_CAP}, streams_per_listener / {_C.ratio_threshold}) AS severity
FROM (SELECT track_id, count(*) AS total_streams, count(DISTINCT user_id) AS distinct_listeners,
    CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT user_id), 0) AS streams_per_listener
  FROM streams GROUP BY track_id)""",
    "streams",
)
# the index is a sum of squared shares, compared without the noise of its last digits
cte(
    "sig_hhi",
    f"""SELECT track_id, total_streams, distinct_households, hhi_value, top_household_share,
  CASE WHEN total_streams >= {_C.hhi_min_streams}
    AND round(hhi_value, 12) >= {_C.hhi_threshold} THEN 1 ELSE 0 END AS fires,
  least({_CAP}, hhi_value / {_C.hhi_threshold}) AS severity
FROM (SELECT track_id, CAST(total AS BIGINT) AS total_streams, count(*) AS distinct_households,
    sum(pow(CAST(n AS DOUBLE) / total, 2)) AS hhi_value, max(CAST(n AS DOUBLE) / total) AS top_household_share
  FROM (SELECT track_id, household_id, count(*) AS n, sum(count(*)) OVER (PARTITION BY track_id) AS total
    FROM streams JOIN users USING (user_id) GROUP BY track_id, household_id)
  GROUP BY track_id, total)""",
    "streams", "users",
)
cte(
    "sig_stuffing",
    f"""SELECT track_id, max(d) AS session_distinct_tracks, max(a) AS session_ai_tracks, max(s) AS session_ai_share,
  1 AS fires, max(least({_CAP}, s / {_C.stuffing_ai_share})) AS severity
FROM (SELECT DISTINCT session_id, track_id FROM streams JOIN tracks USING (track_id))
JOIN (SELECT session_id, count(DISTINCT track_id) AS d, count(DISTINCT track_id) FILTER (ai) AS a,
    CAST(count(DISTINCT track_id) FILTER (ai) AS DOUBLE) / count(DISTINCT track_id) AS s
  FROM streams JOIN tracks USING (track_id) GROUP BY session_id
  HAVING count(DISTINCT track_id) >= {_C.stuffing_min_tracks}) USING (session_id)
WHERE s >= {_C.stuffing_ai_share} GROUP BY track_id""",
    "streams", "tracks",
)
_NAMES = {
    "listen_spike": ("sig_spike", _C.weight_spike),
    "geo_anomaly": ("sig_geo", _C.weight_geo),
    "s2l_ratio": ("sig_ratio", _C.weight_ratio),
    "repeat_listener": ("sig_hhi", _C.weight_concentration),
    "playlist_stuffing": ("sig_stuffing", _C.weight_stuffing),
}
_FILLED = ",\n    ".join(
    f"coalesce({s}.fires, 0) AS {n}_fires, coalesce({s}.severity, CAST(0 AS DOUBLE)) AS {n}_severity"
    for n, (s, _) in _NAMES.items()
)
_TERMS = " + ".join(f"{n}_fires * {n}_severity * CAST({w} AS DOUBLE)" for n, (_, w) in _NAMES.items())
_JOINS = " ".join(f"LEFT JOIN {s} USING (track_id)" for s, _ in _NAMES.values())
cte(
    "flags",
    f"""SELECT *, CASE WHEN composite_suspicion_score >= {_C.remove_at} THEN 'recommend_remove'
    WHEN composite_suspicion_score >= {_C.rank_lower_at} THEN 'recommend_rank_lower' ELSE 'no_action'
  END AS recommended_action
FROM (SELECT *, least(CAST(100 AS DOUBLE), 100 * ({_TERMS})) AS composite_suspicion_score,
    {" + ".join(f"{n}_fires" for n in _NAMES)} AS n_signals_fired
  FROM (SELECT track_id, TIMESTAMP '{_C.built_at}' AS built_at,
    {_FILLED}
    FROM (SELECT DISTINCT track_id FROM streams) {_JOINS}))""",
    "sig_spike", "sig_geo", "sig_ratio", "sig_hhi", "sig_stuffing",
)

_ALL = "SELECT *, 'track' AS entity_kind FROM "
register(
    "sig_listen_spike", lambda s, d: signals.listen_spike(t.streams(s, d), _C), _ALL + "sig_spike", "sig_spike",
    rounded="recent_per_day baseline_per_day spike_ratio severity",
)


def _plays_by_day(s, d):
    return stored(s, d, "plays_by_day", t.streams, sinks.write_by_day, T.StructField("play_day", T.DateType()))


register(
    "sig_listen_spike_by_day", lambda s, d: signals.listen_spike(_plays_by_day(s, d), _C), _ALL + "sig_spike", "sig_spike",
    rounded="recent_per_day baseline_per_day spike_ratio severity",
)


def _busy_days(s, d):
    """Plays of each country on the days on which more orders than usual came in; other days' plays aren't opened."""
    orders = t.table(s, d, "orders").groupBy(F.to_date("o_orderdate").alias("play_day")).agg(F.count(F.lit(1)).alias("n"))
    usual = orders.agg(F.avg("n").alias("usual"))
    busy = orders.join(usual, F.col("n") > 2 * F.col("usual"))
    return signals.plays_of_days(_plays_by_day(s, d), busy).groupBy("play_day", "stream_country_iso2").agg(F.count(F.lit(1)).alias("n"))


register(
    "plays_of_busy_days", _busy_days,
    "SELECT CAST(streamed_at AS DATE) AS play_day, country AS stream_country_iso2, count(*) AS n FROM streams WHERE CAST(streamed_at AS DATE) "
    "IN (SELECT day FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, avg(count(*)) OVER () AS usual FROM orders GROUP BY ALL) "
    "WHERE n > 2 * usual) GROUP BY ALL",
    "streams", dates="play_day",
)
register(
    "sig_geo_anomaly",
    lambda s, d: signals.geo_anomaly(t.streams(s, d), t.tracks(s, d), t.artists(s, d), _C),
    _ALL + "sig_geo", "sig_geo", rounded="top_country_share severity",
)
register(
    "sig_stream_to_listener_ratio",
    lambda s, d: signals.stream_to_listener_ratio(t.streams(s, d), _C),
    _ALL + "sig_ratio", "sig_ratio", rounded="streams_per_listener severity",
)
register(
    "sig_repeat_listener_concentration",
    lambda s, d: signals.repeat_listener_concentration(t.streams(s, d), t.users(s, d), _C),
    _ALL + "sig_hhi", "sig_hhi", rounded="hhi_value top_household_share severity",
)
register(
    "sig_playlist_stuffing",
    lambda s, d: signals.playlist_stuffing(t.streams(s, d), t.tracks(s, d), _C),
    _ALL + "sig_stuffing", "sig_stuffing", rounded="session_ai_share severity",
)
register(
    "fct_artificial_streaming_flags", t.computed_flags, "SELECT * FROM flags", "flags",
    rounded="composite_suspicion_score " + " ".join(f"{n}_severity" for n in _NAMES), times="built_at",
)


def _daily(s, d):
    """Plays in two deliveries that share days, the second loaded twice; what lies before the spike's window rolled up."""
    root, rolled = new_path(s, "daily"), new_path(s, "daily_rolled")
    plays = t.streams(s, d)
    second = F.pmod(F.xxhash64("session_id", "track_id"), F.lit(3)) == 0
    daily.add_delivery(plays.filter(~second), root, "first")
    daily.add_delivery(plays.filter(second & (F.col("track_id") > 5)), root, "second")
    daily.add_delivery(plays.filter(second), root, "second")
    daily.roll_up(s, root, rolled, _C.window_from.date())
    return rolled


register(
    "fct_flags_from_daily_counts",
    lambda s, d: signals.flags_of(daily.fold(s, _daily(s, d), _C), t.users(s, d), t.tracks(s, d), t.artists(s, d), _C),
    "SELECT * FROM flags", "flags",
    rounded="composite_suspicion_score " + " ".join(f"{n}_severity" for n in _NAMES), times="built_at",
)
register(
    "sig_recent_listens", lambda s, d: daily.recent_listens(s, _daily(s, d), _C),
    f"SELECT track_id, CAST(CAST(streamed_at AS DATE) AS VARCHAR) AS day, count(*) AS n FROM streams WHERE streamed_at >= {_WINDOW} GROUP BY ALL",
    "streams",
)
