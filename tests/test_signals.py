"""Signals on small frames: the five fraud shapes and the edge rows."""

from datetime import datetime, timedelta

import pytest

from glasswatch.config import SignalConfig
from glasswatch.operators import signals as sg

REF = datetime(2026, 5, 1)
STREAMS = "track_id string, user_id string, streamed_at timestamp_ntz, stream_country_iso2 string, session_id string"
USERS = "user_id string, household_id string"
TRACKS = "track_id string, artist_id string, ai_generated_label boolean"
ARTISTS = "artist_id string, country_iso2 string"


class World:
    """Rows of the four staged tables."""

    def __init__(self):
        self.plays, self.users, self.tracks, self.artists = [], {}, [], [("a0", "SE")]

    def play(self, track, user, country="SE", session=None, days_ago=1.0, times=1):
        session = session or f"s-{track}-{user}"
        self.plays += [(track, user, REF - timedelta(days=days_ago), country, session)] * times
        self.users.setdefault(user, f"h-{user}")

    def frames(self, spark):
        return (
            spark.createDataFrame(self.plays, STREAMS),
            spark.createDataFrame(list(self.users.items()), USERS),
            spark.createDataFrame(self.tracks, TRACKS),
            spark.createDataFrame(self.artists, ARTISTS),
        )

    def flags(self, spark, cfg=SignalConfig()):
        return {r["track_id"]: r for r in sg.artificial_streaming_flags(*self.frames(spark), cfg).collect()}


def test_bot_ring_is_caught(spark):
    w = World()
    w.tracks.append(("t", "a0", False))
    for u in range(200):
        w.play("t", f"bot{u}", country="VN", times=5, days_ago=1 + u % 6)
    row = w.flags(spark)["t"]
    assert row["composite_suspicion_score"] >= 80
    assert row["recommended_action"] == "recommend_remove"
    assert row["s2l_ratio_fires"] == row["geo_anomaly_fires"] == row["listen_spike_fires"] == 1


def test_new_generated_track_is_caught(spark):
    w = World()
    w.tracks.append(("t", "a0", True))
    for i in range(333):
        w.play("t", f"u{i % 250}", country=("SE", "DE", "US", "FR")[i % 4], days_ago=1 + i % 6)
    row = w.flags(spark)["t"]
    assert row["listen_spike_fires"] == 1 and row["composite_suspicion_score"] >= 75


def test_family_plan_abuse_is_caught(spark):
    w = World()
    w.tracks.append(("t", "a0", False))
    for i in range(120):
        w.play("t", f"kid{i % 5}", days_ago=0.5)
    w.users = dict.fromkeys(w.users, "h1")
    row = w.flags(spark)["t"]
    # one household: index 1, severity capped at 3, 100 * 0.4 * 3 capped at 100
    assert row["repeat_listener_severity"] == 3.0 and row["composite_suspicion_score"] == 100.0


def test_geographic_anomaly_is_caught(spark):
    w = World()
    w.tracks.append(("t", "us", False))
    w.artists.append(("us", "US"))
    for i in range(120):
        w.play("t", f"u{i}", country="JP" if i < 100 else "US", days_ago=20 + i % 60)
    row = w.flags(spark)["t"]
    assert row["geo_anomaly_fires"] == 1
    assert row["geo_anomaly_severity"] == pytest.approx((100 / 120 - 0.5) / 0.2)
    assert row["composite_suspicion_score"] >= 75


def test_stuffed_session_scores_exactly_its_minimum(spark):
    w = World()
    for i in range(20):
        w.tracks.append((f"t{i}", "a0", i < 16))
        w.play(f"t{i}", "u", session="stuffed", days_ago=200)
    flags = w.flags(spark)
    assert {r["composite_suspicion_score"] for r in flags.values()} == {80.0}
    assert all(r["playlist_stuffing_fires"] == 1 for r in flags.values())


def test_spike_is_strict_and_has_no_upper_bound(spark):
    w = World()
    # 7 a day against the floor of 0.1 a day: ratio is exactly 10 at 7 plays
    w.play("edge", "u", times=7)
    w.play("over", "u", times=8, days_ago=-400)
    w.play("old", "u", times=8, days_ago=91)
    streams = w.frames(spark)[0] if w.tracks else spark.createDataFrame(w.plays, STREAMS)
    got = {r["track_id"]: r for r in sg.listen_spike(streams).collect()}
    assert got["edge"]["spike_ratio"] == pytest.approx(10.0) and got["edge"]["fires"] == 0
    assert got["over"]["fires"] == 1 and "old" not in got
    assert got["over"]["severity"] == pytest.approx(8 / 7)


def test_top_country_tie_takes_smaller_code_and_null_first(spark):
    w = World()
    w.tracks += [("t", "a0", None), ("n", "a0", None), ("lone", "nobody", None)]
    w.play("t", "u", country="SE", times=2)
    w.play("t", "u", country="DE", times=2)
    w.play("n", "u", country=None, times=2)
    w.play("n", "u", country="DE", times=2)
    w.play("lone", "u", country="DE", times=200)
    w.play("unlisted", "u", country="DE", times=200)
    streams, _, tracks, artists = w.frames(spark)
    got = {r["track_id"]: r for r in sg.geo_anomaly(streams, tracks, artists).collect()}
    assert got["t"]["top_country"] == "DE" and got["n"]["top_country"] is None
    assert got["n"]["n_distinct_countries"] == 2
    # severity below one half is negative; an unknown home country never fires; an unlisted track is left out
    assert got["t"]["severity"] == pytest.approx(0.0)
    assert got["lone"]["artist_country"] is None and got["lone"]["fires"] == 0
    assert "unlisted" not in got


def test_ratio_without_listeners_takes_the_cap(spark):
    w = World()
    w.plays = [("t", None, REF, "SE", "s")] * 3
    got = sg.stream_to_listener_ratio(spark.createDataFrame(w.plays, STREAMS)).collect()[0]
    assert got["distinct_listeners"] == 0 and got["streams_per_listener"] is None
    assert got["severity"] == 3.0 and got["fires"] == 0


def test_concentration_is_exact_at_the_threshold(spark):
    w = World()
    w.tracks.append(("t", "a0", False))
    for u in range(5):
        w.play("t", f"u{u}", times=10)
    streams, users, _, _ = w.frames(spark)
    got = sg.repeat_listener_concentration(streams, users).collect()[0]
    assert got["hhi_value"] == 0.2 and got["fires"] == 1 and got["top_household_share"] == 0.2


def test_unknown_users_are_left_out_of_concentration_only(spark):
    w = World()
    w.tracks.append(("t", "a0", False))
    w.play("t", "known", times=60)
    w.plays += [("t", "stranger", REF, "SE", "x")] * 40
    streams, users, tracks, artists = w.frames(spark)
    alone = sg.repeat_listener_concentration(streams, users).collect()[0]
    assert alone["total_streams"] == 60 and alone["hhi_value"] == 1.0
    row = sg.artificial_streaming_flags(streams, users, tracks, artists).collect()[0]
    assert row["repeat_listener_fires"] == 1
    ratio = sg.stream_to_listener_ratio(streams).collect()[0]
    assert ratio["total_streams"] == 100 and ratio["distinct_listeners"] == 2


def test_stuffing_counts_distinct_known_tracks(spark):
    w = World()
    labels = [True, True, True, None, False]
    for i, label in enumerate(labels):
        w.tracks.append((f"t{i}", "a0", label))
        w.play(f"t{i}", "u", session="s", times=3)
    w.play("unlisted", "u", session="s")
    # a second row of the same track with another label does not count the track twice
    w.tracks.append(("t0", "a0", False))
    streams, _, tracks, _ = w.frames(spark)
    got = {r["track_id"]: r for r in sg.playlist_stuffing(streams, tracks).collect()}
    assert set(got) == {f"t{i}" for i in range(5)}
    assert got["t4"]["session_distinct_tracks"] == 5 and got["t4"]["session_ai_tracks"] == 3
    assert got["t4"]["severity"] == pytest.approx(0.6 / 0.5)


def test_null_track_is_kept_with_zeros(spark):
    w = World()
    w.tracks.append(("t", "a0", False))
    w.play("t", "u")
    w.plays += [(None, "u", REF, "SE", "s")] * 500
    row = w.flags(spark)[None]
    assert row["n_signals_fired"] == 0 and row["composite_suspicion_score"] == 0.0
    assert row["recommended_action"] == "no_action"


def test_flags_equal_the_five_signals_put_together(spark, rows):
    """The fused form against the plain one: five signals, left-joined to every streamed track."""
    import random

    rng = random.Random(7)
    w = World()
    w.artists += [("a1", "US"), ("a2", None)]
    for i in range(12):
        w.tracks.append((f"t{i}", rng.choice(["a0", "a1", "a2", "gone"]), rng.choice([True, False, None])))
    for _ in range(4000):
        t = rng.choice([f"t{min(int(rng.expovariate(0.4)), 13)}"] * 9 + [None])
        w.play(t, f"u{rng.randrange(30)}", rng.choice(["SE", "US", "JP", None]), f"s{rng.randrange(300)}",
               rng.uniform(-1, 120))
    w.users = {u: f"h{int(u[1:]) % 7}" for u in w.users if u != "u3"}
    cfg = SignalConfig(geo_share=0.3, ratio_threshold=2.0, hhi_threshold=0.15, stuffing_min_tracks=2, spike_multiplier=1.2)
    streams, users, tracks, artists = w.frames(spark)
    parts = {
        "listen_spike": sg.listen_spike(streams, cfg),
        "geo_anomaly": sg.geo_anomaly(streams, tracks, artists, cfg),
        "s2l_ratio": sg.stream_to_listener_ratio(streams, cfg),
        "repeat_listener": sg.repeat_listener_concentration(streams, users, cfg),
        "playlist_stuffing": sg.playlist_stuffing(streams, tracks, cfg),
    }
    plain = streams.select("track_id").distinct()
    for name, part in parts.items():
        plain = plain.join(
            part.selectExpr("track_id", f"fires {name}_fires", f"severity {name}_severity"), "track_id", "left"
        )
    fused = sg.artificial_streaming_flags(streams, users, tracks, artists, cfg)
    expected = sg.score_flags(plain, cfg)
    assert rows(fused, *sorted(fused.columns)) == rows(expected, *sorted(fused.columns))
    assert fused.filter("n_signals_fired > 1").count() > 3


def test_invariants(spark):
    w = World()
    for i in range(5):
        w.tracks.append((f"t{i}", "a0", i % 2 == 0))
        for u in range(i + 1):
            w.play(f"t{i}", f"u{u}", session=f"s{u}", times=60)
    streams, users, tracks, artists = w.frames(spark)
    flags = sg.artificial_streaming_flags(streams, users, tracks, artists).collect()
    assert len({r["track_id"] for r in flags}) == len(flags) == 5
    assert all(0 <= r["composite_suspicion_score"] <= 100 for r in flags)
    assert all(0 < r["hhi_value"] <= 1 for r in sg.repeat_listener_concentration(streams, users).collect())
    assert all(0 < r["top_country_share"] <= 1 for r in sg.geo_anomaly(streams, tracks, artists).collect())


def test_shipped_settings():
    cfg = SignalConfig()
    assert (cfg.recent_from, cfg.window_from) == (datetime(2026, 4, 24), datetime(2026, 1, 31))
    assert (cfg.weight_spike, cfg.weight_geo, cfg.weight_ratio, cfg.weight_concentration, cfg.weight_stuffing) == (
        0.30, 0.50, 0.30, 0.40, 0.50,
    )
    assert (cfg.remove_at, cfg.rank_lower_at, cfg.severity_cap) == (70, 40, 3.0)
