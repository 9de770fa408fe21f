"""Gaps between reporting periods, and parts against disclosed totals."""

from datetime import date

from glasswatch.operators import quality


def test_period_gaps(spark, rows):
    schema = "product_line string, reporting_period_canonical string, reporting_period_start date, reporting_period_end date"
    table = [
        ("a", "1", date(2025, 1, 1), date(2025, 6, 30)), ("a", "1", date(2025, 1, 1), date(2025, 6, 30)), ("a", "2", date(2025, 7, 1), date(2025, 12, 31)),
        ("b", "1", date(2025, 1, 1), date(2025, 12, 31)), ("b", "q", date(2025, 3, 1), date(2025, 3, 31)), ("b", "2", date(2026, 1, 1), date(2026, 6, 30)),
        (None, "1", date(2025, 1, 1), date(2025, 1, 31)), (None, "3", date(2025, 3, 1), date(2025, 3, 31)), ("c", "1", None, date(2025, 1, 1)),
    ]
    got = rows(quality.period_gaps(spark.createDataFrame(table, schema)))
    # the short period lies within the year, so the year's end counts for the next one
    assert got == [("b", "1", "q", "overlap", 306), (None, "1", "3", "gap", 28)]
    assert quality.period_gaps(spark.createDataFrame([], schema)).count() == 0


def test_totals_reconciled(spark, rows):
    schema = "k string, n long, m double"
    parts = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), (None, 5, 0.5), ("only parts", 1, None), ("near", 3, 1.0)], schema)
    totals = spark.createDataFrame([("a", 4, 1.0), (None, 5, 0.5), ("only total", 7, None), ("near", 3, 1.01)], schema)
    got = rows(quality.totals_reconciled(parts, totals, ["k"], ["n", "m"], 0.1))
    assert got == [("a", "n", 3.0, 4.0), ("only parts", "n", 1.0, None), ("only total", "n", None, 7.0)]
    assert ("near", "m", 1.0, 1.01) in rows(quality.totals_reconciled(parts, totals, ["k"], ["n", "m"]))
