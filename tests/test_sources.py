import hashlib
import json
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from glasswatch.config import RateLimit
from glasswatch.operators.staging import stage_table
from glasswatch.schemas import BRONZE
from glasswatch.session import shared_dir
from glasswatch.sources import ingest, readers, sinks
from glasswatch.streaming import requests as rq

T0 = datetime(2026, 1, 1, 10)


def test_union_by_name(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "id int, only_a string").write.parquet(a)
    spark.createDataFrame([(2.5, 2)], "only_b double, id int").write.parquet(b)
    got = {r["id"]: (r["only_a"], r["only_b"]) for r in readers.read_merged(spark, a, b).collect()}
    assert got == {1: ("x", None), 2: (None, 2.5)}


def test_csv_may_be_empty(spark, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text(",".join(BRONZE["researcher_keys"].names) + "\n")
    df = readers.read_csv(spark, str(path), BRONZE["researcher_keys"])
    assert df.count() == 0 and df.columns == BRONZE["researcher_keys"].names


def test_seed_and_scenarios(spark, tmp_path):
    (tmp_path / "s.csv").write_text("member_state_code,member_state_name,is_eu,is_aggregate\nGR,Greece,true,false\nEL,Greece,true,false\n")
    assert [r["is_eu"] for r in readers.read_seed(spark, str(tmp_path / "s.csv"), "eu_member_states").collect()] == [True, True]
    folder = tmp_path / "scenarios"
    folder.mkdir()
    for i, tracks in enumerate((["t1", "t2"], [], None)):
        doc = {"scenario_id": f"s{i}", "expected_score_min": 70 + i, "description": "x"}
        if tracks is not None:
            doc["track_ids"] = tracks
        (folder / f"{i}.json").write_text(json.dumps(doc, indent=2))
    got = sorted(tuple(r) for r in readers.read_scenarios(spark, str(folder)).collect())
    assert got == [("s0", "t1", 70), ("s0", "t2", 70)]


def test_header_drift(spark):
    df = spark.createDataFrame([("good", ["a", "b"]), ("wide", ["a", "b", "more"]), ("moved", ["b", "a"]), ("short", ["a"])],
                               "source string, header array<string>")
    got = sorted(tuple(r) for r in ingest.header_drift(df, ["a", "b"]).collect())
    assert got == [("moved", 0, "b", "a"), ("moved", 1, "a", "b"), ("short", 1, None, "b"), ("wide", 2, "more", None)]
    frames = {"x": spark.range(1), "y": spark.range(1), "z": spark.range(1).selectExpr("cast(id as int) id")}
    with pytest.raises(ValueError, match="z"):
        ingest.require_same_schema(frames)


def test_cells(spark):
    cells = [None, "", "  ", "\t\n", "N/A", " na ", "n/a x", " kept ", "Own-initiative ", "nan"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r["c"] for r in ingest.normalise_cells(df).orderBy("i").collect()]
    assert got == [None] * 6 + ["n/a x", " kept ", "Own-initiative ", "nan"]
    times = spark.createDataFrame([(1, datetime(2025, 1, 2)), (2, datetime(2025, 1, 2, 3, 4, 5)), (3, datetime(2025, 1, 2, 3, 4, 5, 60)), (4, None)],
                                  "i int, t timestamp_ntz")
    got = [r["t"] for r in ingest.normalise_cells(times).orderBy("i").collect()]
    assert got == [datetime(2025, 1, 2).date().isoformat(), datetime(2025, 1, 2, 3, 4, 5).isoformat(), datetime(2025, 1, 2, 3, 4, 5, 60).isoformat(), None]


def test_sheet_rows_to_bronze(spark):
    rows = [("1", "7", "n/a", 0), ("", " ", None, 1), ("x", None, "text", 2)]
    df = spark.createDataFrame(rows, "n_a string, ctx_n_a string, value string, row long")
    kept = ingest.drop_empty_rows(ingest.normalise_cells(df), ["n_a", "ctx_n_a", "value"])
    stamped = ingest.stamp_provenance(kept, F.lit("main"), F.lit("annual_2025"), F.lit("7"), F.col("row"), F.lit("sha")).drop("row")
    typed = ingest.typed_by_prefix(stamped, "appeals_and_recidivism")
    got = [(r["n_a"], r["ctx_n_a"], r["value"], r["source_row_index"]) for r in typed.orderBy("source_row_index").collect()]
    assert got == [(1.0, "7", None, 2), (None, None, None, 4)]
    assert dict(ingest.typed_by_prefix(stamped, "qualitative").dtypes)["value"] == "string"


def test_row_rules(spark):
    good = ("ap_000001", "m_00000001", T0, None, "upheld", None)
    bad = [("ap_1", *good[1:]), (*good[:4], "maybe", "robot"), (None, *good[1:]), (*good[:2], None, *good[3:])]
    df = spark.createDataFrame([good, *bad], BRONZE["appeals"])
    valid, quarantine = ingest.split_valid(df, "appeals")
    assert [tuple(r) for r in valid.collect()] == [good]
    assert sorted(r["violations"] for r in quarantine.collect()) == [["appeal_id"], ["appeal_id"], ["status", "reviewer_type"], ["ts_filed"]]
    with pytest.raises(ValueError, match="lacks"):
        ingest.violations(df.drop("status"), "appeals")
    with pytest.raises(ValueError, match="unexpected"):
        ingest.forbid_extra(df, ["appeal_id"])


def test_sheet_rules(spark):
    rows = [("main", "p", "s", 2, "h"), ("other", "p", "s", 0, "h"), ("authors", None, "s", 2, None)]
    df = spark.createDataFrame(rows, "source_product string, source_period string, source_sheet string, source_row_index long, source_sha256 string")
    got = sorted(r["violations"] for r in ingest.violations(df, "sheet").collect())
    assert got == [[], ["source_period", "source_sha256"], ["source_product", "source_row_index"]]


def test_track_and_verdict_rules(spark):
    track = ("t_00000001", "a_00000001", "x", "SE-ABC-25-00001", 15000, datetime(2025, 1, 1).date(), "d", False)
    df = spark.createDataFrame([track, (*track[:4], 14999, *track[5:]), (*track[:3], "SE-abc-25-00001", *track[4:])], BRONZE["tracks"])
    assert sorted(r["violations"] for r in ingest.violations(df, "tracks").collect()) == [[], ["duration_ms"], ["isrc"]]
    v = dict(verdict_id="v_" + "a" * 16, scenario_id="bot_ring", track_id="t", provider="google", model="m", requested_at=T0, completed_at=T0,
             latency_ms=0, input_tokens=0, output_tokens=0, cost_usd=0.0, prompt_hash="0" * 64, status="ok")
    rows = [v, {**v, "confidence": 1.5}, {**v, "reasoning": "x" * 1001}, {**v, "status": "unknown"}]
    df = spark.createDataFrame([tuple(r.get(c) for c in BRONZE["llm_verdicts"].names) for r in rows], BRONZE["llm_verdicts"])
    assert sorted(r["violations"] for r in ingest.violations(df, "llm_verdicts").collect()) == [[], [], ["confidence"], ["status"]]


def test_changed_files(spark, tmp_path):
    for name in ("same", "edited", "new"):
        (tmp_path / name).write_bytes(name.encode())
    files = spark.read.format("binaryFile").load(str(tmp_path)).withColumn("path", F.element_at(F.split("path", "/"), -1))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    manifest = spark.createDataFrame([("same", sha("same")), ("edited", sha("before"))], "path string, sha256 string")
    got = {r["path"]: r["changed"] for r in ingest.changed_files(files, manifest).collect()}
    assert got == {"same": False, "edited": True, "new": True}


def test_reload_replaces_only_what_it_brings(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda v, p: spark.createDataFrame([(v, p)], "v int, p string")
    sinks.truncate_reload({"a": row(1, "x"), "b": row(2, "y")}, path, ["p"])
    sinks.truncate_reload({"a": row(3, "y")}, path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "x"), (3, "y")]
    sinks.truncate_reload({"a": row(9, "z").select("v")}, path + "2")
    sinks.truncate_reload({"a": row(8, "z").select("v")}, path + "2")
    assert [r["v"] for r in spark.read.parquet(path + "2").collect()] == [8]


def test_sorted_files_do_not_overlap_and_split_a_hot_value(spark, tmp_path):
    path = tmp_path / "sorted"
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("v"), "id", F.array(F.lit("a")).alias("tags"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_sorted(df, str(path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ranges = []
    for f in sorted(path.glob("part-*.parquet")):
        t = pq.read_table(f)
        v = t["v"].to_pylist()
        assert v == sorted(v) and t["tags"][0].as_py() == '["a"]'
        if v:
            ranges.append((v[0], v[-1]))
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert sum(lo <= 500 <= hi for lo, hi in ranges) > 1
    assert spark.read.parquet(str(path)).count() == 30000


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def _requests(spark, rows):
    names = BRONZE["researcher_queries"].names
    return spark.createDataFrame([tuple(dict(zip(("query_id", "key_id", "response_status_code", "requested_at"), r, strict=True)).get(c) for c in names) for r in rows],
                                 BRONZE["researcher_queries"])


def test_audit_stream_takes_each_request_once(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    first = [("q1", "k", 200, T0), ("q2", "k", 429, T0), ("q1", "k", 200, T0)]
    _requests(spark, first).coalesce(1).write.parquet(source)
    def run():
        raw = rq.read_files(spark, source, BRONZE["researcher_queries"])
        rq.append_to(rq.audit_rows(raw), out, ckpt).awaitTermination()
        return sorted((r["query_id"], r["outcome_class"]) for r in spark.read.parquet(out).collect())
    assert run() == [("q1", "success"), ("q2", "rate_limited")]
    # a second delivery: one row again, one new; the checkpoint remembers
    _requests(spark, [("q2", "k", 429, T0), ("q3", "k", 500, T0)]).coalesce(1).write.mode("append").parquet(source)
    assert run() == [("q1", "success"), ("q2", "rate_limited"), ("q3", "server_error")]


def test_rate_windows_over_two_batches(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    limit = RateLimit(requests=3)
    for i, batch in enumerate(([("a", "k", 200, T0)] * 2, [("b", "k", 200, T0.replace(minute=1))])):
        _requests(spark, batch).coalesce(1).write.mode("append").parquet(source)
        log = stage_table(rq.read_files(spark, source, BRONZE["researcher_queries"], max_files=1), "researcher_queries")
        rq.latest_windows_to(rq.rate_windows(log, limit), out, ckpt).awaitTermination()
        got = rq.read_latest_windows(spark, out, limit)
        assert got.filter("over_limit").count() == (0 if i == 0 else 14)
    assert got.filter(F.col("window_start") == F.lit(datetime(2026, 1, 1, 9, 50))).collect()[0]["n"] == 3
