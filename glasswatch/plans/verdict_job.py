"""The verdict job: asks models for verdicts within a budget, and no question twice.

A question is a prompt for a provider. The ledger below ``path`` holds every answer ever given; it grows by waves. A wave writes the questions it
is about to ask, asks them, judges and prices the answers in the same pass, and becomes part of the ledger by one entry of the log that
``publish`` keeps. A run that dies in a wave has asked that wave only, and two runs at a time end in ``Conflict`` for the later one. Within
a wave Spark may repeat a lost task, and with it its questions.

Which questions may be asked follows the rule that a question is skipped once those before it cost the budget or more. Costs are only known
afterwards, so a wave takes the questions that stay within the budget even at their dearest (``price_ceiling``), and the next one
goes on from what was really spent. What is asked in the end is what asking one by one would have asked. With ceilings ``c`` times the real costs
about ``c * ln(budget / cheapest question)`` waves are needed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.config import VerdictConfig
from glasswatch.functions.joins import join_null_safe
from glasswatch.operators.verdict_prep import budget_gate, parse_responses, verdict_id, with_cost
from glasswatch.plans.publish import add_entry, entry_folders, latest
from glasswatch.schemas import BRONZE

#: What ``ask`` must add to its questions: answers, or the class of the error.
ANSWER = "response_text string, input_tokens long, output_tokens long, latency_ms long, requested_at timestamp_ntz, completed_at timestamp_ntz, error_class string"
Ask = Callable[[DataFrame], DataFrame]

_KEY = ["scenario_id", "provider", "prompt_hash"]
_ROW = BRONZE["llm_verdicts"]
_LEDGER = T.StructType([*_ROW, T.StructField("wave", T.LongType())])


def questions(prompts: DataFrame, models: dict[str, str]) -> DataFrame:
    """``prompts`` (``scenario_seq, scenario_id, track_id, prompt, prompt_hash``) for each provider, numbered in the order of
    ``scenario_seq``, then of ``models``. Repeated prompts of a scenario are one question, at its first place."""
    ids = [F.struct(F.lit(i).alias("i"), F.lit(p).alias("provider"), F.lit(m).alias("model")) for i, (p, m) in enumerate(models.items())]
    once = prompts.groupBy("scenario_id", "prompt_hash").agg(F.min_by(F.struct("scenario_seq", F.col("track_id").cast("string").alias("track_id"), "prompt"), "scenario_seq").alias("q"))
    each = once.withColumn("p", F.explode(F.array(*ids)))
    number = F.col("q.scenario_seq") * len(models) + F.col("p.i")
    return each.select("scenario_id", "q.track_id", "p.provider", "p.model", "q.prompt", "prompt_hash", number.cast("long").alias("call_seq"))


def price_ceiling(calls: DataFrame, max_output_tokens: int, cfg: VerdictConfig) -> DataFrame:
    """``cost_usd`` as it can't be exceeded: a token for every byte of the prompt, and the longest answer that models are asked for."""
    sized = calls.withColumn("input_tokens", F.octet_length("prompt")).withColumn("output_tokens", F.lit(max_output_tokens))
    return with_cost(sized, cfg).drop("input_tokens", "output_tokens")


def read_ledger(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """All answers, failed ones too, in the layout of the raw verdict table, with the wave that brought them."""
    number = latest(spark, path) if number is None else number
    folders = [f"{path}/{f}" for f in entry_folders(spark, path, number).values()] if number else []
    return spark.read.schema(_LEDGER).parquet(*folders) if folders else spark.createDataFrame([], _LEDGER)


def _judged(answers: DataFrame, wave: int, cfg: VerdictConfig) -> DataFrame:
    failed = F.col("error_class").isNotNull()
    parsed = with_cost(parse_responses(answers, cfg), cfg)
    status = F.when(failed, "api_error").otherwise(F.col("status"))
    rows = parsed.withColumn("verdict_id", verdict_id(F.col("provider"), F.col("prompt_hash"))).withColumns({
        "status": status,
        "error_class": F.coalesce("error_class", F.when(status == "malformed_response", "malformed_response")),
        "uncertainty_flags": F.to_json("uncertainty_flags"),
        "cost_usd": F.when(failed, 0.0).otherwise(F.coalesce("cost_usd", F.lit(0.0))),
    })
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in _ROW], F.lit(wave).cast("long").alias("wave"))


def _put(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def run(
    spark: SparkSession,
    path: str,
    prompts: DataFrame,
    models: dict[str, str],
    ask: Ask,
    max_output_tokens: int,
    cfg: VerdictConfig = VerdictConfig(),
    force: bool = False,
) -> DataFrame:
    """Ask what has no good answer yet, as far as the budget of this run goes, and give the verdicts of all questions.

    ``ask`` gets questions and gives them back with the columns of ``ANSWER``; it is evaluated once per wave. Failed questions are asked again by
    the next run, not by this one; ``force`` asks all again. The result is in the layout of the raw verdict table: the last good answer to
    a question, else its last failure, else a row that says it was skipped. ``path`` must be in a folder that all executors reach.
    """
    work = f"{path}/work/{uuid.uuid4().hex}"
    wanted = _put(spark, questions(prompts, models), f"{work}/questions")
    number = first = latest(spark, path)
    while True:
        ledger = read_ledger(spark, path, number)
        now = F.col("wave") > first
        spent = ledger.filter(now).agg(F.sum("cost_usd")).first()[0] or 0.0
        if spent >= cfg.budget_usd:
            break
        done = ledger.filter(now if force else now | (F.col("status") == "ok")).select(*_KEY)
        left = price_ceiling(join_null_safe(wanted, done, _KEY, "left_anti"), max_output_tokens, cfg)
        gated = budget_gate(left, cfg=replace(cfg, budget_usd=cfg.budget_usd - spent)).filter(F.col("gate_reason").isNull())
        todo = _put(spark, gated.select(*wanted.columns), f"{work}/wave-{number + 1}")
        if todo.isEmpty():
            break
        folders = entry_folders(spark, path, number) if number else {}
        folder = f"waves/{uuid.uuid4().hex}"
        _judged(ask(todo), number + 1, cfg).write.parquet(f"{path}/{folder}")
        add_entry(spark, path, number + 1, folders | {f"wave/{number + 1}": folder})
        number += 1
    return verdicts(wanted, read_ledger(spark, path, number))


def verdicts(wanted: DataFrame, ledger: DataFrame) -> DataFrame:
    """A row per question in the layout of the raw verdict table; see ``run``."""
    best = ledger.groupBy(*_KEY).agg(F.max_by(F.struct(*_ROW.names), F.struct(F.col("status") == "ok", F.col("wave"))).alias("v"))
    skipped = {"verdict_id": verdict_id(F.col("provider"), F.col("prompt_hash")), "status": F.lit("skipped_no_key"), "error_class": F.lit("budget_cap"), "cost_usd": F.lit(0.0)}
    skipped |= {n: F.lit(0) for n in ("latency_ms", "input_tokens", "output_tokens")} | {"uncertainty_flags": F.lit("[]")}
    met = join_null_safe(wanted, best, _KEY, "left")

    def value(f: T.StructField):
        asked = F.col(f"v.{f.name}")
        own = F.col(f.name) if f.name in wanted.columns else skipped.get(f.name, F.lit(None))
        return F.when(F.col("v").isNotNull(), asked).otherwise(own).cast(f.dataType).alias(f.name)

    return met.select(*[value(f) for f in _ROW])
