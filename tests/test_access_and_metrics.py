from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from glasswatch.functions.expressions import first_forwarded_ip
from glasswatch.operators import researcher as rs
from glasswatch.operators import history, quality
from glasswatch.plans import metrics, serving
from glasswatch.plans.publish import publish, read_published
from glasswatch.sources.readers import date_spine

T0 = datetime(2026, 1, 1, 10)


@pytest.fixture
def keys(spark):
    return spark.createDataFrame([("k1", "Ann", "U", "active"), ("k2", "Bo", "V", None), ("k3", "Cy", "W", "revoked")],
                                 "key_id string, researcher_name string, institution string, status string")


def test_outcome_classes(spark):
    codes = [200, 299, 301, 404, 429, 500, 599, 600, None]
    df = spark.createDataFrame([(c,) for c in codes], "c long")
    got = [r[0] for r in df.select(rs.outcome_class(F.col("c"))).collect()]
    assert got == ["success", "success", "other", "client_error", "rate_limited", "server_error", "server_error", "other", "other"]


def test_keys_fact_and_audit(spark, keys):
    active = rs.dim_keys(keys, F.lit("now"))
    assert {r["key_id"] for r in active.collect()} == {"k1", "k2"}
    log = spark.createDataFrame(
        [(f"q{i}", k, e, "{}", 10, c, ms, T0, "h") for i, (k, e, c, ms) in enumerate(
            [("k1", "/a", 200, 10), ("k1", "/b", 429, 20), ("k1", "/a", 500, None), ("k3", "/a", 404, 5)])],
        "query_id string, key_id string, endpoint string, query_params_json string, response_size_bytes long, "
        "response_status_code long, latency_ms long, requested_at timestamp_ntz, client_ip_hash string")
    fact = rs.fct_queries(log, active)
    row = {r["query_id"]: r for r in fact.collect()}
    assert (row["q0"]["query_date"], row["q0"]["query_hour_utc"]) == (date(2026, 1, 1), 10)
    # a revoked key leaves the researcher unknown
    assert row["q3"]["researcher_name"] is None and row["q0"]["researcher_name"] == "Ann"
    audit = {r["key_id"]: r for r in rs.query_audit(fact).collect()}["k1"]
    assert (audit["n_queries"], audit["n_success"], audit["n_rate_limited"], audit["n_server_error"], audit["mean_latency_ms"],
            audit["total_response_bytes"], audit["distinct_endpoints_hit"]) == (3, 1, 1, 1, 15.0, 30, 2)
    decisions = {r["key_id"]: r["decision"] for r in rs.key_check(
        spark.createDataFrame([("k1",), ("k2",), ("k3",), ("k4",), (None,)], "key_id string"), keys).collect()}
    assert decisions == {"k1": "accepted", "k2": "accepted", "k3": "forbidden", "k4": "unknown_key", None: "unknown_key"}


def test_forwarded_ip(spark):
    df = spark.createDataFrame([(" 1.2.3.4 , 5.6.7.8",), ("",), (" ,9.9.9.9",), (None,)], "h string")
    assert [r[0] for r in df.select(first_forwarded_ip(F.col("h"), F.lit("peer"))).collect()] == ["1.2.3.4", "peer", "peer", "peer"]


def test_spine_and_fill(spark):
    bounds = spark.createDataFrame([(date(2025, 1, 1), date(2027, 1, 1))], "start date, end date")
    spine = date_spine(bounds)
    assert spine.count() == 730 and spine.agg(F.max("date_day")).first()[0] == date(2026, 12, 31)
    assert date_spine(spark.createDataFrame([(date(2025, 1, 1), date(2025, 1, 1))], "start date, end date")).count() == 0
    daily = spark.createDataFrame([(date(2025, 1, 2), 5)], "metric_time date, n long")
    filled = metrics.fill_days(spine, daily, ["n"])
    assert filled.count() == 730 and filled.agg(F.sum("n")).first()[0] == 5


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [("v1", "s", "p", "ok", 10, 0.5, 1, T0), ("v2", "s", "p", "api_error", 0, 0.0, None, T0), ("v3", "s", "q", "ok", 30, 0.25, 0, T0)],
        "verdict_id string, scenario_id string, provider string, status string, latency_ms long, cost_usd double, "
        "llm_agrees_with_heuristic int, requested_at timestamp_ntz")


def test_metrics(fact):
    got = {r["provider"]: r for r in metrics.metric_query(
        fact, "llm_verdicts", ["llm_provider_uptime", "llm_mean_latency_ms", "mean_latency_ms", "llm_verdict_agreement_rate"], ["provider"]).collect()}
    assert tuple(got["p"])[1:] == (0.5, 10.0, 5.0, 0.5)
    one = metrics.metric_query(fact, "llm_verdicts", ["n_verdicts"], where=F.col("status") == "ok", grain="month").collect()
    assert [tuple(r) for r in one] == [(date(2026, 1, 1), 2)]
    assert metrics.metric_query(fact.limit(0), "llm_verdicts", ["llm_provider_uptime"]).first()[0] is None
    with pytest.raises(ValueError, match="no_such"):
        metrics.metric_query(fact, "llm_verdicts", ["no_such"])
    with pytest.raises(ValueError, match="grain"):
        metrics.metric_query(fact, "llm_verdicts", ["n_verdicts"], grain="hour")


def test_all_named_metrics_exist(spark):
    named = {m for model in metrics.models().values() for m in model.metrics()}
    assert {"composite_suspicion_score", "llm_total_cost_usd", "llm_mean_latency_ms", "llm_heuristic_agreement_count",
            "dsa_decisions_total", "dsa_automated_decisions", "dsa_automated_share", "dsa_notices_received",
            "dsa_complaints_submitted", "llm_verdict_agreement_rate", "two_of_three_agree_sum", "scenario_count",
            "llm_provider_uptime", "ok_verdict_count", "total_verdict_count"} <= named


def test_complaints_are_not_repeated_per_category(spark):
    decisions = spark.createDataFrame([("m", "p", c, 10, 5, 1, 1) for c in "ab"],
                                      "product_line string, reporting_period_canonical string, category_code string, "
                                      "total_decisions long, automated_decisions long, notices_received long, actions_on_notice_total long")
    appeals = spark.createDataFrame([("m", "p", 7.0)], "product_line string, reporting_period_canonical string, complaints_submitted double")
    row = metrics.cross_product(decisions, appeals).collect()[0]
    assert (row["dsa_decisions_total"], row["dsa_automated_share"], row["dsa_complaints_submitted"]) == (20, 0.5, 7.0)


def test_serving_guards(spark):
    with pytest.raises(ValueError, match="metric must be"):
        serving.time_series(spark.range(1), "drop table")
    log = spark.createDataFrame([(f"q{i}", "k", "/x", T0, 200, 1) for i in range(600)],
                                "query_id string, key_id string, endpoint string, requested_at timestamp_ntz, response_status_code long, latency_ms long")
    assert serving.my_queries(log, "k", 9999).count() == log.filter("key_id = 'k'").count() and serving.my_queries(log, "k").count() == 50
    mine = serving.citation(log, "q1", "k", "Pub", "https://example.org", 2026).collect()
    assert len(mine) == 1 and mine[0]["model"] == "unknown"
    assert serving.citation(log, "q1", "other", "Pub", "https://example.org", 2026).count() == 0


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "c")], "k int, v string")
    assert rows(quality.not_null(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(quality.unique(df, "k")) == [(1, 2)]
    assert rows(quality.accepted_values(df, "v", ["a", "b"])) == [("c", 1)]
    assert rows(quality.accepted_values(df, "v", ["a", "b"], F.col("k") == 1)) == []
    assert rows(quality.relationships(df, "k", df.filter("k = 1"), "k")) == [(2,)]
    assert rows(quality.between(df, "k", 0, 1), "k") == [(2,)]


def test_period_continuity(spark, rows):
    summary = spark.createDataFrame([("a", "p1"), ("a", "p2"), ("b", "p2"), ("b", "p1")], "product_line string, reporting_period_canonical string")
    periods = spark.createDataFrame([("p1", date(2025, 1, 1), date(2025, 12, 31), 365), ("p2", date(2025, 1, 1), date(2025, 1, 1), 1)],
                                    "reporting_period_id string, reporting_period_start date, reporting_period_end date, period_days int")
    # the same periods in another order are the same set
    assert rows(quality.period_continuity(summary, periods)) == [("invalid_period", "p2")]
    assert ("period_set_mismatch", "2") in rows(quality.period_continuity(summary.filter("not (product_line = 'b' and reporting_period_canonical = 'p1')"), periods))


def test_fraud_caught(spark):
    expected = spark.createDataFrame([("s1", "t1", 80), ("s1", "t2", 80), ("s2", "t3", 70), ("s3", "t4", 70)], "scenario_id string, track_id string, expected_min_score int")
    flags = spark.createDataFrame([("t1", 80.0), ("t3", 69.9)], "track_id string, composite_suspicion_score double")
    got = {r["scenario_id"]: (r["actual_max_score"], r["tracks_at_or_above_threshold"]) for r in quality.fraud_caught(expected, flags).collect()}
    assert got == {"s2": (69.9, 0), "s3": (0.0, 0)}


def test_gate(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id int, part string")
    checks = {"unique": lambda x: quality.unique(x, "id"), "few": lambda x: x.filter("id > 2")}
    path = str(tmp_path / "mart")
    assert publish(df, path, checks, ["part"]).published
    bad = publish(df.unionByName(df.filter("id = 2").selectExpr("id + 1 id", "part")), path, checks)
    assert not bad.published and bad.failures == {"unique": 0, "few": 1}
    assert read_published(spark, path).count() == 2
    assert publish(df.filter("id = 1"), path, checks).published and read_published(spark, path).count() == 1


def test_history(spark):
    at = lambda d: F.to_timestamp_ntz(F.lit(f"2026-0{d}-01 00:00:00"))
    schema = "k string, v long"
    h = history.first_snapshot(spark.createDataFrame([("same", 1), ("changed", 1), ("gone", None)], schema), ["v"], at(1))
    h = history.apply_snapshot(h, spark.createDataFrame([("same", 1), ("changed", 2), ("new", 5)], schema), ["k"], ["v"], at(2))
    h = history.apply_snapshot(h, spark.createDataFrame([("same", 1), ("changed", None), ("new", 5), ("gone", None)], schema), ["k"], ["v"], at(3))
    got = sorted(((r["k"], str(r["v"]), r["valid_from"].month, r["valid_to"].month if r["valid_to"] else None, r["is_current"]) for r in h.collect()), key=str)
    assert got == sorted([
        ("same", "1", 1, None, True), ("changed", "1", 1, 2, False), ("changed", "2", 2, 3, False), ("changed", "None", 3, None, True),
        ("gone", "None", 1, 2, False), ("gone", "None", 3, None, True), ("new", "5", 2, None, True)], key=str)
