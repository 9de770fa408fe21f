"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space around a cell or a model answer.
BLANKS = " \t\r\n"


def ladder(steps: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Searched CASE: the first true condition wins; none true gives ``default``."""
    out: Column | None = None
    for condition, value in steps:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    assert out is not None, "a ladder needs at least one step"
    return out.otherwise(default) if default is not None else out


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double; NULL when ``b`` is 0 or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct(a: Column, b: Column) -> Column:
    """``100 * a / b`` rounded to two digits; NULL unless ``b`` is positive."""
    return F.when(b > 0, F.round(F.try_divide(F.lit(100.0) * a, b), 2))


def flag(condition: Column) -> Column:
    """1 when true, else 0 (also for an unknown condition)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def count_when(condition: Column) -> Column:
    """Number of rows where the condition holds."""
    return F.count(F.when(condition, F.lit(1)))


def sum_when(condition: Column) -> Column:
    """Like ``count_when``, but NULL for a group without rows, as SUM(CASE …) gives."""
    return F.sum(flag(condition).cast("bigint"))


def key_of(*parts: str) -> Column:
    """Parts joined by ``|``; NULL as soon as one part is NULL."""
    columns: list[Column] = []
    for part in parts:
        columns += [F.lit("|"), F.col(part)] if columns else [F.col(part)]
    return F.concat(*columns)


def sha256_prefix(c: Column, label: str) -> Column:
    """A label followed by the first 16 hex digits of the SHA-256 of the text."""
    return F.concat(F.lit(label), F.substring(F.sha2(c, 256), 1, 16))


def first_forwarded_ip(header: Column, fallback: Column) -> Column:
    """First entry of a comma-separated proxy header, trimmed; ``fallback`` if it is empty or missing."""
    first = F.btrim(F.split(header, ",", 2)[0], F.lit(BLANKS))
    return F.coalesce(F.nullif(first, F.lit("")), fallback)


def string_agg_sorted(c: Column, sep: str = ",") -> Column:
    """All values of a group in order. For groups known to be small, such as the periods of one product."""
    return F.array_join(F.sort_array(F.collect_list(c)), sep)


def days_inclusive(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def strip_fence(text: Column) -> Column:
    """The body of a Markdown code fence (with or without a ``json`` tag); other text is only trimmed."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    body = F.regexp_replace(F.regexp_extract(trimmed, r"(?s)^```(.*?)(?:```|\z)", 1), r"^json", "")
    return F.when(trimmed.startswith("```"), F.btrim(body, F.lit(BLANKS))).otherwise(trimmed)
