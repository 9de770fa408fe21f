"""Quality rules whose cutoffs come from labelled documents, with a bound on how many good ones they reject.

Four features are measured on every text. A stratum (a language) rejects what lies above a cutoff of any of them. Its
rules are tried as one chain from the loosest: every step lowers one cutoff, so that each rule rejects what the one
before rejects and more. Of ``n`` labelled good documents the joint rule rejects ``k``; the chain goes on while the exact
binomial (Clopper-Pearson) upper bound of that rate is within the allowed rate, and ends at the first rule that isn't. Nested
rules tried in a fixed order need no correction for the length of the chain; only the strata share the error probability, so with
probability ``1 - error`` no stratum loses more than ``rate`` of its good documents. The order of the steps comes from
documents other than the labelled good ones: the next step has most labelled bad documents among what it newly rejects. So
all labels are used, good ones for the bound and bad ones for the order. A stratum without enough labels has no cutoff:
0 of ``n`` rejected is enough from ``log(strata / error) / rate`` good ones, 218 for four strata.

Null and empty texts have no words and fail the base rules. A null stratum is a stratum. Rows of ``labels`` without an id or
a quality are ignored; of several labels for an id the lowest counts. Repeated documents are judged alike. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.llm.tables import ship, stored
from glasswatch.llm.words import IS_SPACE, SMALL_CHUNK, chunks, mix, ngrams, words_of

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
#: Features in thousandths, and the cutoffs tried for each.
FEATURES = {
    "symbol_rate": "1000 * n_symbols / greatest(word_chars, 1)",
    "dup_line_rate": "1000 * n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "1000 * n_repeat_words / greatest(n_words, 1)",
    "upper_rate": "1000 * n_upper / greatest(word_chars, 1)",
}
CUTOFFS = (2, 5, 10, 15, 20, 30, 40, 50, 75, 100, 150, 200, 300, 400, 500, 600, 700, 800)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
WINDOW = 5


@dataclass(frozen=True)
class Risk:
    """At most ``rate`` of good documents rejected in each stratum, with probability ``1 - error``."""

    rate: float = 0.02
    error: float = 0.05


def _counts(c) -> list[np.ndarray]:
    """The columns of COUNTS for the rows of a chunk."""
    data, offsets = c.data, c.offsets
    n = len(offsets) - 1
    w = words_of(c)
    row_sum = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])
    lead = (data & 0xC0) != 0x80  # one per code point
    at, h = ngrams(w, WINDOW)
    row = w.row[at]
    order = np.lexsort((h, row))
    r, g = row[order], h[order]
    same = (r[1:] == r[:-1]) & (g[1:] == g[:-1])
    again = np.zeros(len(r), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = at[order[again]]
    covered = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(covered, hit, 1)
    np.add.at(covered, np.minimum(hit + WINDOW, len(w.hash)), -1)
    repeated = np.bincount(w.row[np.cumsum(covered[:-1]) > 0], minlength=n) if len(w.hash) else np.zeros(n, np.int64)
    # lines: pieces between line feeds and text ends
    text = data.tobytes()
    dup, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        own = [x for x in text[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip()]
        lines[i] = len(own)
        dup[i] = len(own) - len(set(own))
    return [np.diff(w.first), row_sum(lead & ~IS_SPACE[data]), row_sum(SYMBOLS[data]), dup, repeated, lines, row_sum(UPPER[data])]


def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and the counts of COUNTS for every document."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            for c in chunks(b.column(b.num_columns - 1), SMALL_CHUNK):
                kept = [b.column(i).slice(c.lo, c.hi - c.lo) for i in range(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x.astype(np.int64)) for x in _counts(c))], [*keep, *COUNTS])

    source = docs.select(*keep, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "text")
    return source.mapInArrow(run, f"{types}, " + ", ".join(f"{x} long" for x in COUNTS))


def upper_bound(k: int, n: int, error: float) -> float:
    """The exact upper confidence bound of a rate of which ``k`` of ``n`` trials were seen."""
    if n == 0 or k >= n:
        return 1.0
    choose = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]
    lo, hi = k / n, 1.0
    for _ in range(50):
        p = (lo + hi) / 2
        below = math.fsum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(choose))
        lo, hi = (p, hi) if below > error else (lo, p)
    return hi


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


def chain(levels: np.ndarray, bad: np.ndarray, other: np.ndarray) -> list[np.ndarray]:
    """Rules from the loosest: per feature the place of its cutoff in CUTOFFS, ``len(CUTOFFS)`` for none.

    ``levels`` has a row per kind of document, with the number of cutoffs that each feature exceeds; of a kind there are
    ``bad`` labelled bad and ``other`` unlabelled documents. Steps that reject no more bad ones aren't taken.
    """
    rule, rules = np.full(len(FEATURES), len(CUTOFFS)), []
    left = np.ones(len(levels), bool)
    while bad[left].any():
        steps = []
        for f in range(len(FEATURES)):
            # documents and bad ones that each lower cutoff of the feature would newly reject
            reach = lambda x, f=f: np.bincount(levels[left, f], x[left], len(CUTOFFS) + 1)[::-1].cumsum()[::-1][1:]
            b, all_ = reach(bad), reach(bad + other)
            steps += [(b[c] / all_[c], b[c], CUTOFFS[c], -f, c) for c in range(rule[f]) if b[c]]
        if not steps:
            break
        *_, f, c = max(steps)
        rule = rule.copy()
        rule[-f] = c
        rules.append(rule)
        left &= levels[:, -f] <= c
    return rules


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: Risk = Risk()) -> dict[tuple[str | None, str], int]:
    """``(stratum, feature)`` to its cutoff, for those that have one. All labels are used; of documents, counts per combination of levels are collected."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    names = list(FEATURES)
    level = lambda value: sum((F.expr(f"{value} > {c}").cast("int") for c in CUTOFFS), F.lit(0))
    rows = measured.filter(~base_failed() & F.col("doc_id").isNotNull()).select("doc_id", F.col(stratum).alias("_s"), *[level(v).alias(n) for n, v in FEATURES.items()])
    count = lambda c: F.count(F.when(c, 1))
    quality = F.col("quality")
    sums = rows.join(known, "doc_id", "left").groupBy("_s", *names).agg(
        count(quality == 1).alias("good"), count(quality == 0).alias("bad"), count(quality.isNull()).alias("other")
    ).toArrow()
    levels = np.stack([sums.column(n).to_numpy() for n in names], 1).astype(np.int64).reshape(-1, len(names))
    good, bad, other = (sums.column(n).to_numpy() for n in ("good", "bad", "other"))
    by_stratum: dict[str | None, list[int]] = {}
    for i, s in enumerate(sums.column("_s").to_pylist()):
        by_stratum.setdefault(s, []).append(i)
    tried = {s: i for s, i in by_stratum.items() if good[i].any() and bad[i].any()}
    found = {}
    for s, i in tried.items():
        last = None
        for rule in chain(levels[i], bad[i], other[i]):
            rejected = (levels[i] > rule).any(1)
            if upper_bound(int(good[i][rejected].sum()), int(good[i].sum()), risk.error / len(tried)) > risk.rate:
                break
            last = rule
        if last is not None:
            found |= {(s, n): CUTOFFS[c] for n, c in zip(names, last.tolist(), strict=True) if c < len(CUTOFFS)}
    return found


def judged(measured: DataFrame, cuts: dict[tuple[str | None, str], int], stratum: str) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    rejected = F.lit(False)
    for (s, name), cut in sorted(cuts.items(), key=str):
        rejected = rejected | (F.col(stratum).eqNullSafe(F.lit(s)) & (F.expr(FEATURES[name]) > cut))
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: Risk = Risk(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``doc_id``, the stratum, the columns ``keep``, the counts, ``base_failed`` and ``kept``."""
    measured = stored(text_counts(docs, "doc_id", stratum, *keep), "measured")
    return judged(measured, cutoffs(measured, labels, stratum, risk), stratum)
