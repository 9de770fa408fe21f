"""Mixing sources to target weights along a time-varying curriculum, in Spark expressions only.

Targets: sources in code-point order (null last) get repeating weights and share all words by them. No target exceeds ``MOST``
times its source; what is above is shared again among the others by weight until none is above.

Schedule: a source's weight changes linearly over the training run, from ``1 + slope`` to ``1 - slope`` times its mean. Its
integral is the share of the source's target that is due by time ``t``; a document's place in the source's cumulative demand,
put through the inverse, is its training position in [0, 1]. Every source is gone through in a fixed pseudo-random order as
often as its target says, and in the last round up to the target. Documents are taken whole: the words taken differ from the
target by less than the largest document. Decisions depend on ``doc_id`` and text only, so runs agree, and repeated rows
are decided alike.

Running totals are cut into slots (``running_total``), so a source that holds a third of all rows is no single task's.
Null texts have size 0. Extra columns are kept by ``mixed`` and ignored otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.functions.joins import join_null_safe
from glasswatch.functions.prefix import running_total
from glasswatch.llm.tables import stored

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)
MOST = 3
SLOT_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size``, and ``k``, a hash of id and text that also orders a source's documents."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("k"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``slope``, ``target``: a row per source."""
    ranked = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source; the window numbers them all
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("rank") % len(values) + 1).cast("int"))
    ranked = stored(ranked.withColumn("rank", rank).withColumns({"weight": pick(weights), "slope": pick(slopes)}), "sources")
    cap = F.lit(most) * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, -1
    while True:  # each round finds at least one more source that is full
        over = cap <= F.lit(level) * F.col("weight")
        full, used, free = ranked.agg(F.count(F.when(over, 1)), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if full == before or not free:
            break
        before, level = full, (total - (used or 0)) / free
    target = F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "source_size", "slope", target.alias("target"))


def slot_of(order: str, rows: int) -> Column:
    """A non-decreasing function of a signed 64-bit hash with about SLOT_ROWS rows to a value."""
    bits = max(4, math.ceil(math.log2(max(1, rows / SLOT_ROWS))) + 1)
    return F.shiftright(order, 64 - bits)


def due_time(share: Column, slope: Column) -> Column:
    """The time by which a share of a source's words is due: the inverse of ``(1 + slope) t - slope t^2``."""
    root = F.sqrt(F.greatest((slope + 1) * (slope + 1) - slope * share * 4, F.lit(0.0)))
    return F.when(slope == 0, share).otherwise((slope + 1 - root) / (slope * 2))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES, most: int = MOST) -> DataFrame:
    """Per document: ``doc_id``, ``k``, ``source``, ``size``, ``source_size``, ``target``, ``slope``, ``before`` (words of its source
    ahead of its middle), ``times`` it is used and ``taken`` words."""
    sized = stored(sizes(docs), "sizes")
    by_source = stored(targets(sized, weights, slopes, most), "targets")
    placed = running_total(sized, "size", "k", slot_of("k", sized.count()), ["source"], "upto")
    rows = join_null_safe(placed, by_source, ["source"], "left")
    rounds = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    before = F.col("upto") - F.col("size") / 2
    last = before <= (rounds - F.floor(rounds)) * F.col("source_size")
    times = (F.floor(rounds) + F.when(last & (rounds > F.floor(rounds)), 1).otherwise(0)).cast("int")
    rows = rows.withColumn("before", before).withColumn("times", times)
    return rows.select("doc_id", "k", "source", "size", "source_size", "target", "slope", "before", "times", (F.col("size") * F.col("times")).alias("taken"))


def position(turn: Column) -> Column:
    """Training position of a document's use in round ``turn`` (from 0)."""
    share = (turn * F.col("source_size") + F.col("before")) / F.col("target")
    return due_time(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)), F.col("slope"))


def planned(mix: DataFrame) -> DataFrame:
    """The mixture in training order: range-sorted by the first ``position`` (null: not used)."""
    first = F.when((F.col("times") > 0) & (F.col("target") > 0), position(F.lit(0)))
    return in_order(mix.withColumn("position", first))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name.lower() in (c.lower() for c in df.columns):
        name = "_" + name
    return name


def in_order(rows: DataFrame, key: str = "k", at: str = "position") -> DataFrame:
    keys = [F.col(at).asc_nulls_last(), F.xxhash64(key), F.col(key)]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents as often as the mixture uses them, in training order, with their own columns."""
    key, at = free_name(docs, "k"), free_name(docs, "position")
    mix = mixture(docs, **options).filter("times > 0 and target > 0").dropDuplicates(["k"])
    uses = mix.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    uses = uses.select(F.col("k").alias(key), position(F.col("turn")).alias(at))
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(uses, key)
    return in_order(rows, key, at).select(*[F.col(f"`{c}`") for c in docs.columns])
