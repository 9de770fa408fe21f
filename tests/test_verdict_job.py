"""The verdict job against asking one by one: budget, reruns, failures, races."""

import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from glasswatch.config import VerdictConfig
from glasswatch.plans import verdict_job as job
from glasswatch.plans.publish import Conflict, add_entry, latest
from glasswatch.schemas import BRONZE

MODELS = {"p": "model-p", "q": "model-q"}
# a dollar per token, so that costs are whole numbers
CFG = VerdictConfig(prices={"p": (1e6, 1e6), "q": (1e6, 1e6)}, budget_usd=60.0)
GOOD = json.dumps({"recommendation": "recommend_remove", "confidence": 0.5, "primary_signal": "none", "reasoning": "r", "uncertainty_flags": ["x"]})
N = 12


def _prompts(spark, n=N):
    rows = [(i, f"s{i}", i, "x" * (5 + i % 3), f"h{i}") for i in range(n)]
    # a repeated prompt is one question
    return spark.createDataFrame([*rows, rows[0]], "scenario_seq long, scenario_id string, track_id long, prompt string, prompt_hash string")


def _ask(down):
    """Half the tokens of the ceiling; scenarios in ``down`` fail, s3 gives no JSON."""

    def ask(calls):
        fails = F.col("scenario_id").isin(*down)
        at = F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz")
        return calls.withColumns({
            "response_text": F.when(~fails, F.when(F.col("scenario_id") == "s3", "no idea").otherwise(GOOD)),
            "input_tokens": F.when(fails, 0).otherwise(F.octet_length("prompt") - 3), "output_tokens": F.when(fails, 0).otherwise(1),
            "latency_ms": F.lit(7), "requested_at": at, "completed_at": at, "error_class": F.when(fails, "timeout"),
        })

    return ask


def _one_by_one(known, down, budget):
    """Status per question as the rule has it, and the questions asked."""
    spent, out, asked = 0.0, {}, []
    for i in range(N):
        for p in MODELS:
            key = (f"s{i}", p)
            if known.get(key) == "ok":
                out[key] = "ok"
            elif spent >= budget:
                out[key] = known.get(key, "skipped_no_key")
            else:
                asked.append(key)
                spent += 0 if f"s{i}" in down else 5 + i % 3 - 2
                out[key] = "api_error" if f"s{i}" in down else "malformed_response" if i == 3 else "ok"
    return out, asked


def _status(df):
    found = [((r["scenario_id"], r["provider"]), r["status"]) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def test_runs_equal_asking_one_by_one(spark, tmp_path):
    path, known, total = str(tmp_path / "job"), {}, []
    for down, cfg in (({"s1", "s4"}, CFG), ({"s4"}, CFG), (set(), replace(CFG, budget_usd=1000.0)), (set(), CFG)):
        before = latest(spark, path)
        got = job.run(spark, path, _prompts(spark), MODELS, _ask(down), 1, cfg)
        known, asked = _one_by_one(known, down, cfg.budget_usd)
        assert _status(got) == known
        new = job.read_ledger(spark, path).filter(F.col("wave") > before)
        assert sorted((r[0], r[1]) for r in new.select("scenario_id", "provider").collect()) == sorted(asked)
        total += asked
    # all but s3 are answered, and the last run asked s3 only
    assert {k[0] for k, v in known.items() if v != "ok"} == {"s3"} == {k[0] for k in asked}
    assert job.read_ledger(spark, path).count() == len(total)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BRONZE["llm_verdicts"]]
    row = got.filter("scenario_id = 's0' and provider = 'p'").first()
    assert (row["track_id"], row["model"], row["recommendation"], row["uncertainty_flags"], row["cost_usd"]) == ("0", "model-p", "recommend_remove", '["x"]', 3.0)
    # asking all again on demand
    before = latest(spark, path)
    again = job.run(spark, path, _prompts(spark), MODELS, _ask({"s0"}), 1, replace(CFG, budget_usd=1000.0), force=True)
    assert job.read_ledger(spark, path).filter(F.col("wave") > before).count() == 2 * N
    assert _status(again) == known  # a failure doesn't hide an earlier answer


def test_a_run_that_dies_is_repeated_and_races_fail(spark, tmp_path):
    path = str(tmp_path / "job")

    def dies(calls):
        return _ask(set())(calls).withColumn("latency_ms", F.raise_error(F.lit("no network")).cast("long"))

    with pytest.raises(Exception, match="no network"):
        job.run(spark, path, _prompts(spark), MODELS, dies, 1, CFG)
    assert latest(spark, path) == 0 and job.read_ledger(spark, path).count() == 0

    def overtaken(calls):
        add_entry(spark, path, latest(spark, path) + 1, {})
        return _ask(set())(calls)

    with pytest.raises(Conflict):
        job.run(spark, path, _prompts(spark), MODELS, overtaken, 1, CFG)


def test_no_questions(spark, tmp_path):
    got = job.run(spark, str(tmp_path / "job"), _prompts(spark).limit(0), MODELS, _ask(set()), 1, CFG)
    assert got.count() == 0 and latest(spark, str(tmp_path / "job")) == 0


def test_questions_without_ids(spark, tmp_path):
    prompts = spark.createDataFrame([(0, None, None, "xxxxx", "h"), (1, "s1", None, None, None)], _prompts(spark).schema)
    got = job.run(spark, str(tmp_path / "job"), prompts, {"p": "m"}, _ask(set()), 1, CFG)
    assert _status(got).keys() == {(None, "p"), ("s1", "p")} and job.read_ledger(spark, str(tmp_path / "job")).count() == 2
