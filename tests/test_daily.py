"""Signals folded from daily counts against signals over the plays, after any split of the plays into deliveries."""

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from glasswatch.config import SignalConfig
from glasswatch.operators import daily, signals
from glasswatch.plans import marts

CFG = replace(
    SignalConfig(), reference_time=datetime(2026, 5, 1), spike_multiplier=1.2, geo_share=0.4, geo_min_streams=5, ratio_threshold=1.5,
    ratio_min_streams=5, hhi_threshold=0.2, hhi_min_streams=5, stuffing_min_tracks=3,
)
PLAYS = "track_id string, user_id string, streamed_at timestamp_ntz, stream_country_iso2 string, session_id string"


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(4)
    start = datetime(2025, 12, 1)
    plays = []
    for _ in range(3000):
        at = start + timedelta(days=r.randrange(150), seconds=r.choice([0, 1, 86_399, r.randrange(86_400)]))
        plays.append((
            r.choice([f"t{i}" for i in range(40)] + [None]), r.choice([f"u{i}" for i in range(25)] + [None]),
            r.choice([at] * 30 + [None]), r.choice(["DE", "FR", "JP", None]), r.choice([f"s{i}" for i in range(300)] + [None]),
        ))
    plays += [("t1", "u1", datetime(2026, 4, 24), "JP", "s1"), ("t1", "u1", datetime(2026, 1, 31), "JP", "s1")] * 5
    return (
        spark.createDataFrame(plays, PLAYS).cache(),
        spark.createDataFrame([(f"u{i % 20}", f"h{i % 6}") for i in range(30)] + [(None, "h1")] * 200, "user_id string, household_id string"),
        spark.createDataFrame([(f"t{i}", f"a{i % 5}", i % 2 == 0) for i in range(35)], "track_id string, artist_id string, ai_generated_label boolean"),
        spark.createDataFrame([(f"a{i}", "DE") for i in range(4)], "artist_id string, country_iso2 string"),
    )


def test_any_split_into_deliveries_gives_the_same_flags(spark, tables, rows, tmp_path):
    plays, users, tracks, artists = tables
    want = rows(signals.artificial_streaming_flags(plays, users, tracks, artists, CFG))
    assert len(want) == 41 and {r[-2] for r in want} != {"no_action"}
    parts = plays.randomSplit([0.5, 0.3, 0.2], seed=3)
    root = str(tmp_path / "daily")
    for i, part in enumerate(parts):
        daily.add_delivery(part, root, f"d{i}")
    daily.add_delivery(parts[1], root, "d1")  # loaded again
    assert rows(signals.flags_of(daily.fold(spark, root, CFG), users, tracks, artists, CFG)) == want
    rolled = str(tmp_path / "rolled")
    daily.roll_up(spark, root, rolled, CFG.window_from.date())
    assert rows(signals.flags_of(daily.fold(spark, rolled, CFG), users, tracks, artists, CFG)) == want
    days = {r[0] for r in spark.read.parquet(f"{rolled}/listeners").select("day").distinct().collect()}
    assert date(1000, 1, 1) in days and all(d >= CFG.window_from.date() for d in days - {date(1000, 1, 1)})
    # a later delivery on top of what is rolled up
    late = spark.createDataFrame([("t0", "u9", datetime(2026, 4, 30, 1), "JP", "s9")] * 40, PLAYS)
    daily.add_delivery(late, rolled, "late")
    want = rows(signals.artificial_streaming_flags(plays.union(late), users, tracks, artists, CFG))
    assert rows(signals.flags_of(daily.fold(spark, rolled, CFG), users, tracks, artists, CFG)) == want


def test_each_signal_from_its_counts(tables, rows):
    plays, users, tracks, artists = tables
    counts = signals.play_counts(plays, CFG)
    assert rows(signals.listen_spike_of(counts.countries, CFG)) == rows(signals.listen_spike(plays, CFG))
    assert rows(signals.geo_anomaly_of(counts.countries, tracks, artists, CFG)) == rows(signals.geo_anomaly(plays, tracks, artists, CFG))
    assert rows(signals.ratio_of(counts.listeners, CFG)) == rows(signals.stream_to_listener_ratio(plays, CFG))
    assert rows(signals.concentration_of(counts.listeners, users, CFG)) == rows(signals.repeat_listener_concentration(plays, users, CFG))
    assert rows(signals.stuffing_of(counts.pairs, tracks, CFG)) == rows(signals.playlist_stuffing(plays, tracks, CFG))


def test_other_months_are_not_opened(spark, tables, tmp_path):
    root = str(tmp_path / "months")
    daily.add_delivery(tables[0], root, "all")
    cfg = replace(CFG, recent_days=7, baseline_days=21)
    out = daily.recent_listens(spark, root, cfg)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day" in plan
    read = {f.split("month=")[1][:7] for f in spark.read.parquet(f"{root}/countries").filter("month >= '2026-04-01'").inputFiles()}
    assert read >= {"2026-04"}
    want = tables[0].filter("streamed_at >= '2026-04-03'").groupBy("track_id").count()
    got = {r["track_id"]: r["s"] for r in out.groupBy("track_id").agg({"n": "sum"}).toDF("track_id", "s").collect()}
    assert got == {r["track_id"]: r["count"] for r in want.collect()}


def test_boundaries_within_a_day_are_refused(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="midnight"):
        daily.fold(spark, str(tmp_path), replace(CFG, reference_time=datetime(2026, 5, 1, 12)))


def test_marts_read_the_plays_for_three_aggregates(spark, tables, tmp_path):
    plays, users, tracks, artists = tables
    path = str(tmp_path / "plays")
    plays.write.parquet(path)
    stg = {f"stg_synth_{n}": df for n, df in zip(("users", "tracks", "artists"), (users, tracks, artists), strict=True)}
    scans = 0
    store = marts.written(spark, str(tmp_path / "marts"))

    def keep(name, df):
        nonlocal scans
        scans += sum("/plays/" in f or f.endswith("/plays") for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()})
        return store(name, df)

    out = marts.safety_marts({**stg, "stg_synth_streams": spark.read.parquet(path)}, CFG, keep)
    assert scans == 3 and len(out) == 6


def test_many_users_without_id(spark, rows):
    """A third of the users list has no id: they join with nothing and are gathered nowhere."""
    users = spark.range(1_000_000).selectExpr("CAST(NULL AS STRING) AS user_id", "concat('h', id) AS household_id").union(
        spark.createDataFrame([("u1", "h1"), ("u2", "h1")], "user_id string, household_id string")
    )
    plays = spark.createDataFrame([("t1", u, datetime(2026, 4, 30), "DE", "s") for u in ("u1", "u2", None, "u3")], PLAYS)
    tracks = spark.createDataFrame([("t1", "a1", False)], "track_id string, artist_id string, ai_generated_label boolean")
    artists = spark.createDataFrame([("a1", "DE")], "artist_id string, country_iso2 string")
    cfg = replace(CFG, hhi_min_streams=2, ratio_min_streams=4, ratio_threshold=1.3)
    got = signals.artificial_streaming_flags(plays, users, tracks, artists, cfg).collect()
    assert [(r["s2l_ratio_fires"], r["repeat_listener_fires"]) for r in got] == [(1, 1)]
    plan = signals.artificial_streaming_flags(plays, users, tracks, artists, cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "isnotnull(user_id" in plan
