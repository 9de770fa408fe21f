"""Batch preparation of model verdicts: evidence, prompts, answer parsing, cost, reuse and budget."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.config import VerdictConfig
from glasswatch.functions.expressions import ladder, sha256_prefix, strip_fence, sum_when
from glasswatch.functions.joins import spread_join
from glasswatch.functions.prefix import running_total
from glasswatch.operators.signals import SIGNAL_COLUMNS


def picked_tracks(flags: DataFrame, expectations: DataFrame, tracks: DataFrame) -> DataFrame:
    """The flag row of the highest-scoring track of every scenario (ties: smallest id), with ``scenario_id``.

    A ``min_by`` aggregate, so a scenario with very many tracks needs no ranked window. Expectations and tracks are shuffled: as
    files they are far smaller than as rows, so Spark would send rows of all tracks through the driver.
    """
    return (
        flags.join(expectations.select("scenario_id", "track_id").hint("merge"), "track_id")
        # only flagged tracks that are listed can represent a scenario
        .join(tracks.select("track_id").hint("merge"), "track_id", "left_semi")
        .groupBy("scenario_id")
        .agg(
            F.min_by(
                F.struct(*flags.columns),
                F.struct((-F.col("composite_suspicion_score")).alias("s"), F.col("track_id")),
            ).alias("f")
        )
        .select("scenario_id", "f.*")
    )


def plays_of_tracks(streams: DataFrame, picked: DataFrame) -> DataFrame:
    """The plays of the picked tracks: all that their spike, country, listener and household numbers depend on."""
    return streams.join(picked.select("track_id").distinct(), "track_id", "left_semi")


def plays_of_sessions(streams: DataFrame, plays: DataFrame) -> DataFrame:
    """All plays of the sessions that occur in ``plays``: what the session shares of their tracks depend on."""
    return streams.join(plays.select("session_id").distinct(), "session_id", "left_semi")


def scenario_evidence(
    flags: DataFrame,
    expectations: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    spike: DataFrame,
    geo: DataFrame,
    ratio: DataFrame,
    concentration: DataFrame,
    stuffing: DataFrame,
) -> DataFrame:
    """The picked track of every scenario with what the five signals measured on it.

    Signal details are only known for tracks inside the spike window, which is where all signals are looked up from.
    Signals may be given for the picked tracks only, from ``plays_of_tracks`` and ``plays_of_sessions``.
    """
    picked = picked_tracks(flags, expectations, tracks)
    listed = tracks.select("track_id", "artist_id", "ai_generated_label", "release_date")
    homes = artists.select("artist_id", F.col("country_iso2").alias("artist_country"))
    measured = (
        spike.select("track_id", "spike_ratio", (F.col("recent_streams") + F.col("baseline_streams")).alias("_total"))
        .join(geo.select("track_id", F.col("top_country").alias("_top"), "top_country_share"), "track_id", "left")
        .join(ratio.select("track_id", "streams_per_listener"), "track_id", "left")
        .join(concentration.select("track_id", "hhi_value"), "track_id", "left")
        .join(stuffing.select("track_id", "session_ai_share"), "track_id", "left")
    )
    share = F.col("top_country_share")

    def text_or(value: Column, shown: Column, missing: str) -> Column:
        # a share of 0 is shown as missing too
        return F.when(value != 0, shown).otherwise(F.lit(missing))

    def zero_if_null(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    return (
        picked.join(listed.hint("merge"), "track_id")
        .join(homes, "artist_id", "left")
        .join(measured, "track_id", "left")
        .select(
            "scenario_id",
            "track_id",
            F.coalesce(F.nullif(F.col("artist_country").cast("string"), F.lit("")), F.lit("unknown")).alias(
                "artist_country"
            ),
            ladder(
                [(F.col("ai_generated_label"), "True"), (~F.col("ai_generated_label"), "False")], "None"
            ).alias("ai_generated_label"),
            F.coalesce(F.col("release_date").cast("string"), F.lit("None")).alias("release_date"),
            F.coalesce(F.col("_total"), F.lit(0)).alias("total_streams"),
            F.coalesce(F.nullif(F.col("_top").cast("string"), F.lit("")), F.lit("unknown")).alias("top_country"),
            text_or(share, F.format_string("%.1f", F.bround(100 * share, 1)), "n/a").alias("top_country_share_pct"),
            *[f"{s}_{part}" for s in SIGNAL_COLUMNS for part in ("fires", "severity")],
            zero_if_null("spike_ratio").alias("spike_ratio"),
            zero_if_null("top_country_share").alias("top_country_share"),
            zero_if_null("streams_per_listener").alias("streams_per_listener"),
            zero_if_null("hhi_value").alias("hhi_value"),
            text_or(
                F.col("session_ai_share"), F.format_string("%.2f", F.bround("session_ai_share", 2)), "n/a"
            ).alias("session_ai_share"),
            "composite_suspicion_score",
            F.col("recommended_action").alias("heuristic_action"),
        )
    )


# One line per fact: (format, evidence columns). The text is ours to choose; a changed template changes the hash and
# so asks the models again.
PROMPT_LINES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Review one music track for artificial streaming and say what a moderator should do.", ()),
    ("Track %s, artist country %s, generated by AI: %s, released %s", (
        "track_id", "artist_country", "ai_generated_label", "release_date")),
    ("Plays in the last 90 days: %d, most from %s (%s%%)", ("total_streams", "top_country", "top_country_share_pct")),
    ("listen_spike: fires %d, severity %.2f, ratio %.1f", (
        "listen_spike_fires", "listen_spike_severity", "spike_ratio")),
    ("geo_anomaly: fires %d, severity %.2f, share %.2f", (
        "geo_anomaly_fires", "geo_anomaly_severity", "top_country_share")),
    ("stream_to_listener_ratio: fires %d, severity %.2f, ratio %.2f", (
        "s2l_ratio_fires", "s2l_ratio_severity", "streams_per_listener")),
    ("repeat_listener_concentration: fires %d, severity %.2f, hhi %.3f", (
        "repeat_listener_fires", "repeat_listener_severity", "hhi_value")),
    ("playlist_stuffing: fires %d, severity %.2f, AI share %s", (
        "playlist_stuffing_fires", "playlist_stuffing_severity", "session_ai_share")),
    ("Suspicion score %.1f of 100, heuristic action %s", ("composite_suspicion_score", "heuristic_action")),
    ("Answer with one JSON object: recommendation, confidence (0 to 1), primary_signal, reasoning, uncertainty_flags.",
     ()),
)


_SPEC = re.compile(r"%(?:\.\d)?[sdf]")


def render_prompt(evidence: DataFrame, lines: tuple[tuple[str, tuple[str, ...]], ...] = PROMPT_LINES) -> DataFrame:
    """Add the prompt text and its SHA-256."""

    def shown(spec: str, column: str) -> Column:
        # an exact half goes to the even digit, while the formatter alone would go up
        digits = re.fullmatch(r"%\.(\d)f", spec)
        return F.bround(column, int(digits[1])) if digits else F.col(column)

    rendered = [
        F.format_string(fmt, *[shown(spec, c) for spec, c in zip(_SPEC.findall(fmt), cols, strict=True)])
        if cols
        else F.lit(fmt)
        for fmt, cols in lines
    ]
    return evidence.withColumn("prompt", F.concat_ws("\n", *rendered)).withColumn(
        "prompt_hash", F.sha2("prompt", 256)
    )


def verdict_id(provider: Column, prompt_hash: Column) -> Column:
    return sha256_prefix(F.concat(provider, F.lit(":"), prompt_hash), "v_")


# fixed values: keys of a model's answer and their types
_ANSWER_KEYS = {
    "recommendation": "string",
    "confidence": "double",
    "primary_signal": "string",
    "reasoning": "string",
    "uncertainty_flags": "array<string>",
}


def parse_responses(responses: DataFrame, cfg: VerdictConfig = VerdictConfig()) -> DataFrame:
    """Read the JSON answer in ``response_text`` and judge it.

    Text that is no JSON object, a value outside its enumeration or range, or a value of the wrong type makes the row
    ``malformed_response`` with an empty body. A key that is not there is NULL and does no harm.
    """
    # Each step names what later ones use several times, so it is worked out once per row.
    # The parser stops after the first value. A marker behind the answer is only found if nothing else was there.
    framed = F.try_parse_json(F.concat(F.lit("["), F.col("_body"), F.lit(',"'), F.col("_marker"), F.lit('"]')))
    parsed = (
        responses.withColumn("_body", strip_fence(F.col("response_text")))
        .withColumn("_marker", F.sha2("_body", 256))
        .withColumn("_doc", framed)
    )

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("_doc", f"$[0].{name}", kind)

    fields = parsed.select(
        *responses.columns,
        (F.try_variant_get("_doc", "$[1]", "string") == F.col("_marker")).alias("_whole"),
        F.schema_of_variant(F.try_variant_get("_doc", "$[0]", "variant")).alias("_shape"),
        *[field(n, "variant").alias(f"_raw_{n}") for n in _ANSWER_KEYS],
        *[field(n, kind).alias(f"_{n}") for n, kind in _ANSWER_KEYS.items()],
    )

    def absent(name: str) -> Column:
        # a JSON null is as good as no key
        raw = F.col(f"_raw_{name}")
        return raw.isNull() | F.is_variant_null(raw)

    def valid(name: str, condition: Column) -> Column:
        return absent(name) | F.coalesce(condition, F.lit(False))

    # looking for anything in a list that holds a NULL gives NULL
    no_gaps = F.array_contains("_uncertainty_flags", F.lit("")).isNotNull()
    texts = F.schema_of_variant("_raw_uncertainty_flags").isin("ARRAY<STRING>", "ARRAY<VOID>")
    good = (
        F.coalesce(F.col("_whole") & F.col("_shape").startswith("OBJECT"), F.lit(False))
        & valid("recommendation", F.col("_recommendation").isin(*cfg.recommendations))
        & valid("primary_signal", F.col("_primary_signal").isin(*cfg.primary_signals))
        & valid("confidence", F.col("_confidence").between(0.0, 1.0))
        & valid("uncertainty_flags", texts & no_gaps)
    )
    judged = fields.withColumn("_good", good)

    def if_good(c: Column) -> Column:
        return F.when(F.col("_good"), c)

    reasoning = F.coalesce(F.col("_reasoning"), F.lit(""))
    return judged.select(
        *responses.columns,
        if_good(F.col("_recommendation")).alias("recommendation"),
        if_good(F.col("_confidence")).alias("confidence"),
        if_good(F.col("_primary_signal")).alias("primary_signal"),
        if_good(reasoning).alias("reasoning"),
        F.coalesce(if_good(F.col("_uncertainty_flags")), F.array().cast("array<string>")).alias("uncertainty_flags"),
        F.sha2("response_text", 256).alias("response_hash"),
        F.when(F.col("_good"), "ok").otherwise("malformed_response").alias("status"),
    )


def with_cost(calls: DataFrame, cfg: VerdictConfig = VerdictConfig()) -> DataFrame:
    """Add ``cost_usd`` from the token counts; NULL for a provider without a price."""
    million = F.lit(1_000_000.0)

    def price(side: int) -> Column:
        return ladder([(F.col("provider") == p, F.lit(both[side])) for p, both in cfg.prices.items()])

    cost = F.col("input_tokens") * price(0) / million + F.col("output_tokens") * price(1) / million
    return calls.withColumn("cost_usd", cost)


_CALL_KEYS = ["scenario_id", "provider", "prompt_hash"]


def reuse_cached(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """Wanted calls with the verdict id of an earlier successful answer to the same prompt, if there is one."""
    usable = (
        cached.filter(F.col("status") == "ok").groupBy(*_CALL_KEYS).agg(F.min("verdict_id").alias("cached_verdict_id"))
    )
    return spread_join(wanted, usable, _CALL_KEYS, "left").withColumn("is_cached", F.col("cached_verdict_id").isNotNull())


def work_list(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """Wanted calls that still have to be made."""
    return wanted.join(cached.filter(F.col("status") == "ok").select(*_CALL_KEYS), _CALL_KEYS, "left_anti")


def budget_gate(
    calls: DataFrame, order: str = "call_seq", slot_width: int = 100_000, cfg: VerdictConfig = VerdictConfig()
) -> DataFrame:
    """Mark the calls that come after the budget was spent.

    A call is skipped once the calls before it cost the budget or more; skipped calls cost nothing. Costs are never
    negative, so the spend before a call is its exclusive running total, found slot by slot over the whole-number
    ``order``. Calls of equal order follow one another by a hash of their columns.
    """
    amount = F.coalesce(F.col("cost_usd"), F.lit(0.0))
    run = running_total(calls.withColumn("_cost", amount), "_cost", order, F.floor(F.col(order) / slot_width), out="_run", slots_per_run=1000)
    # the total includes all calls of equal order: take off this one and those that follow it
    tied = Window.partitionBy(order).orderBy(F.xxhash64(*calls.columns).desc()).rowsBetween(Window.unboundedPreceding, 0)
    before = F.round(F.col("_run") - F.col("_later"), 9)
    run = run.withColumn("_later", F.sum("_cost").over(tied))
    skipped = before >= cfg.budget_usd
    return run.select(
        *calls.columns,
        before.alias("spent_before_usd"),
        F.when(skipped, 0.0).otherwise(amount).alias("charged_usd"),
        F.when(skipped, "skipped_no_key").otherwise(F.col("status") if "status" in calls.columns else F.lit("ok")).alias(
            "gated_status"
        ),
        F.when(skipped, "budget_cap").alias("gate_reason"),
    )


def status_summary(verdicts: DataFrame) -> DataFrame:
    status = F.col("status")
    return verdicts.agg(
        F.count(F.lit(1)).alias("n_verdicts"),
        sum_when(status == "ok").alias("n_ok"),
        sum_when(status.startswith("skipped")).alias("n_skipped"),
        sum_when(status.isin("api_error", "malformed_response")).alias("n_errored"),
    )
