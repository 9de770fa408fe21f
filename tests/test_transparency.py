from datetime import date

import pytest

from glasswatch.config import FixedPeriod, YearlyPeriods
from glasswatch.operators import staging as st
from glasswatch.operators import transparency as tr
from glasswatch.schemas import PROVENANCE, bronze_type, sheet_columns


def bronze(spark, sheet, rows):
    """A sheet's bronze table from dictionaries; what is not given is NULL."""
    columns = [*sheet_columns(sheet), *PROVENANCE]
    ddl = ", ".join(f"{c} {bronze_type(sheet, c).simpleString()}" for c in columns)
    filled = [{"source_period": "annual_2025", "source_sha256": "sha", **r} for r in rows]
    assert not {k for r in filled for k in r} - set(columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in filled], ddl)


def stage(spark, sheet, rows, period=FixedPeriod()):
    return st.stage_sheet(bronze(spark, sheet, rows), sheet, period)


def notice(product, category, law=0.0, tc=0.0, received=0.0, **more):
    return dict(source_product=product, category_of_illegal_content=category, n_actions_on_law=law, n_actions_on_tc=tc,
                n_notices_received=received, **more)


def own(product, category, measures, automated, column="category_of_illegal_content", **more):
    return {"source_product": product, column: category, "n_measures_own_initiative": measures,
            "n_measures_automated_detection": automated, **more}


def own_tc(*args, **more):
    return own(*args, column="category_of_incompatibility_tc", **more)


@pytest.mark.parametrize(
    ("sheet", "n"),
    [("report_identification", 4 + 5), ("categories_names", 4 + 5), ("member_states_orders", 4 + 5 + 14 + 3),
     ("notices", 4 + 4 + 20 + 3), ("own_initiative_illegal", 4 + 4 + 32 + 3), ("own_initiative_tc", 4 + 4 + 32 + 3),
     ("appeals_and_recidivism", 4 + 7 + 3), ("automated_means", 4 + 7 + 1 + 3), ("qualitative", 4 + 4 + 3)],
)
def test_staged_widths(spark, sheet, n):
    staged = stage(spark, sheet, [{"source_product": "main"}])
    # identification: 4 head, applicability, service, indicator, value, 3 provenance; names have no start and end
    expected = {"report_identification": 4 + 4 + 3, "categories_names": 2 + 4 + 3}.get(sheet, n)
    assert len(staged.columns) == expected and staged.count() == 1


def test_staging_casts(spark):
    row = stage(spark, "notices", [notice("main", "TOTAL", law=2.7, tc=float("nan"), received=2.5,
                                          median_time_to_take_action=1.5, ctx_n_actions_on_law="why")]).collect()[0]
    # doubles are rounded, not cut; not-a-number has no whole number
    assert (row["actions_on_law"], row["notices_received"]) == (3, 3)
    assert row["median_time_to_take_action_hours"] == 1.5 and row["ctx_actions_on_law"] == "why"
    assert row["reporting_period_canonical"] == "annual_2025"
    assert row["reporting_period_start"] == date(2025, 1, 1) and row["reporting_period_end"] == date(2025, 12, 31)


def test_yearly_periods(spark):
    rows = [notice("main", "TOTAL", source_period=p) for p in ("annual_2024", "h1_2024")]
    got = {r[0]: (r[1], r[2]) for r in stage(spark, "notices", rows, YearlyPeriods()).select(
        "reporting_period_canonical", "reporting_period_start", "reporting_period_end").collect()}
    assert got == {"annual_2024": (date(2024, 1, 1), date(2024, 12, 31)), "h1_2024": (None, None)}


def test_quality_kind_and_scope_are_kept(spark):
    texts = ["Accuracy of the automated means - Precision", "Accuracy of the automated means - Recall",
             "Accuracy of the automated means - Accuracy", "Number of measures solely taken by automated means"]
    rows = [dict(source_product="main", indicator=t, scope="Own-initiative ", value=i / 10) for i, t in enumerate(texts)]
    staged = stage(spark, "automated_means", rows)
    kinds = [r["quality_metric_kind"] for r in staged.orderBy("value").collect()]
    assert kinds == ["precision", "recall", "accuracy", None]
    wide = tr.automated_quality(staged).collect()[0]
    assert wide["scope"] == "Own-initiative "
    assert (wide["precision_score"], wide["recall"], wide["accuracy"], wide["measures_solely_automated"]) == (0.0, 0.1, 0.2, 0.3)
    assert wide["notices_solely_automated"] is None


@pytest.fixture
def sheets(spark):
    notices = stage(spark, "notices", [
        notice("main", "TOTAL", 10.0, 30.0, 100.0, n_items_in_notices=7.0),
        notice("main", "A", 4.0, 6.0, 50.0),
        notice("main", "KEYWORD_OTHER", 1.0, 0.0, 1.0),
        notice("main", "KEYWORD_OTHER", 2.0, 0.0, 2.0),
        notice("main", None, 9.0, 9.0, 9.0),
        notice("authors", "TOTAL", 0.0, 0.0, 0.0),
    ])
    illegal = stage(spark, "own_initiative_illegal", [
        own("main", "TOTAL", 5.0, 3.0, account_suspension=4.0),
        own("main", "KEYWORD_OTHER", 1.0, 1.0, account_suspension=4.0, account_termination=1.0),
        own("main", "KEYWORD_OTHER", 2.0, 0.0),
    ])
    tc = stage(spark, "own_initiative_tc", [own_tc("main", "TOTAL", 5.0, 2.0), own_tc("artists", "B", 8.0, 8.0)])
    return notices, illegal, tc


def test_unified_quirks(sheets):
    u = tr.unified(*sheets)
    by = {}
    for r in u.collect():
        by.setdefault((r["product_line"], r["category_code"]), []).append(r)
    # a code used twice in two sheets multiplies rows
    assert len(by["main", "KEYWORD_OTHER"]) == 4
    total = by["main", "TOTAL"][0]
    assert (total["total_decisions"], total["automated_decisions"]) == (10 + 30 + 5 + 5, 5)
    # termination is unknown, so the sum is, and the suspensions are lost
    assert total["own_initiative_illegal_account_actions"] == 0
    assert by["main", "KEYWORD_OTHER"][0]["own_initiative_illegal_account_actions"] in (0, 5)
    # a missing category keeps a row but finds no numbers
    assert by["main", None][0]["notices_received"] == 0
    # a product that is missing from a sheet still appears
    b = by["artists", "B"][0]
    assert (b["notices_received"], b["total_decisions"], b["source_sha256"]) == (0, 8, None)


def test_decisions_fact(sheets):
    rows = tr.fct_decisions(tr.unified(*sheets)).collect()
    assert all(r["category_code"] is not None for r in rows)
    share = {(r["product_line"], r["category_code"]): r["automated_share_pct"] for r in rows}
    assert share["main", "TOTAL"] == 10.0 and share["authors", "TOTAL"] is None and share["artists", "B"] == 100.0


def test_periods(sheets):
    aligned = tr.period_aligned(*sheets)
    assert [tuple(r) for r in aligned.collect()] == [("annual_2025", date(2025, 1, 1), date(2025, 12, 31), 365)]
    dim = tr.dim_reporting_periods(aligned, "X").collect()[0]
    assert (dim["period_granularity"], dim["calendar_year"]) == ("annual", 2025)


@pytest.mark.parametrize(("days", "name"), [(350, "annual"), (349, "biannual"), (175, "biannual"), (85, "quarterly"), (84, "other")])
def test_granularity(spark, days, name):
    aligned = spark.createDataFrame(
        [("p", date(2025, 1, 1), date(2025, 2, 1), days)],
        "reporting_period_canonical string, reporting_period_start date, reporting_period_end date, period_days int",
    )
    assert tr.dim_reporting_periods(aligned, "X").collect()[0]["period_granularity"] == name


def test_category_levels(spark):
    rows = [dict(source_product="main", category_label=c, category_of_illegal_or_tc=v, category_description=d) for c, v, d in (
        ("TOTAL", "TOTAL", None), ("Category 9", "a", "x"), ("Category 99", "b", "x"), ("Category 10a", "KEYWORD_OTHER", "x"),
        ("Category 9", "b", None), ("Other", None, "x"), (None, "c", "x"))]
    rows.append(dict(source_product="artists", category_label="Category 1"))
    dim = {r["category_id"]: r for r in tr.dim_categories(stage(spark, "categories_names", rows)).collect()}
    levels = {k: r["category_level"] for k, r in dim.items()}
    assert levels == {"TOTAL": "aggregate", "Category 9": "top_level", "Category 99": "top_level",
                      "Category 10a": "sub_category", "Other": "sub_category"}
    assert dim["Category 9"]["category_code"] == "b"


def test_products(spark):
    df = spark.createDataFrame([("main",), ("artists",), ("main",), ("else",), (None,)], "product_line string")
    got = {r["product_id"]: tuple(r)[1:] for r in tr.dim_products(df, "P").collect()}
    assert got == {
        "main": ("P Main", "music_streaming", "consumer"),
        "artists": ("P for Artists", "music_artist_platform", "creator"),
        "authors": ("P for Authors", "audiobook_author_platform", "creator"),
        "creators": ("P for Creators", "podcast_creator_platform", "creator"),
        "else": (None, None, None),
    }


def _summary(spark, sheets, **kw):
    appeals = tr.appeals_wide(stage(spark, "appeals_and_recidivism", [
        dict(source_product="main", indicator="Number of complaints submitted to the x", value=5.0),
        dict(source_product="main", indicator="Number of decisions reversed", value=2.0),
    ]))
    quality = tr.automated_quality(stage(spark, "automated_means", [
        dict(source_product="main", scope="Total number", indicator=f"Accuracy of the automated means - {k}", value=v)
        for k, v in (("Accuracy", 1.0), ("Precision", 0.5), ("Recall", 0.97))
    ] + [dict(source_product="main", scope="NAM Total", indicator="Accuracy of the automated means - Recall", value=0.1)]))
    return tr.cross_product_summary(*sheets, appeals, quality, **kw), appeals


def test_summary_and_reports(spark, sheets):
    summary, appeals = _summary(spark, sheets)
    got = {r["product_line"]: r for r in summary.collect()}
    assert set(got) == {"main", "authors"}
    m = got["main"]
    assert (m["notice_actions_total"], m["own_initiative_total"], m["total_decisions"], m["automated_decisions"]) == (40, 10, 50, 5)
    assert (m["automated_share_pct"], m["complaints_submitted"], m["automated_recall_pct"]) == (10.0, 5.0, 97.0)
    assert got["authors"]["automated_share_pct"] is None and got["authors"]["complaints_submitted"] == 0.0
    posture = {r["product_line"]: r["automation_posture"] for r in tr.automated_vs_human(summary).collect()}
    assert posture == {"main": "conservative", "authors": "balanced"}
    trend = {r["product_line"]: r for r in tr.period_trends(summary).collect()}
    assert trend["main"]["period_seq"] == trend["main"]["n_periods_available"] == 1
    assert trend["main"]["total_decisions_delta_vs_prior"] is None
    life = tr.appeals_lifecycle(tr.fct_appeals(appeals), summary).collect()[0]
    assert (life["reversal_rate_pct"], life["complaints_per_100_decisions"]) == (40.0, 10.0)


@pytest.mark.parametrize(("accuracy", "recall", "label"), [
    (97.0, 94.0, "conservative"), (97.0, 94.01, "balanced"), (95.0, 95.5, "aggressive"), (95.0, 95.4, "balanced"),
    (None, 95.0, "balanced")])
def test_posture_thresholds(spark, accuracy, recall, label):
    df = spark.createDataFrame(
        [("p", "q", 1, 1, 1.0, 3.0, 1.0, accuracy, 1.0, recall)],
        "product_line string, reporting_period_canonical string, total_decisions long, automated_decisions long, "
        "automated_share_pct double, measures_solely_automated double, measures_not_automated double, "
        "automated_accuracy_pct double, automated_precision_pct double, automated_recall_pct double",
    )
    row = tr.automated_vs_human(df).collect()[0]
    assert row["automation_posture"] == label and row["measures_solely_automated_share_pct"] == 75.0


def test_join_by_product_only_multiplies_periods(spark):
    years = YearlyPeriods()
    def two(f):
        return [f(p) for p in ("annual_2024", "annual_2025")]
    notices = stage(spark, "notices", two(lambda p: notice("main", "TOTAL", 1.0, 1.0, source_period=p)), years)
    illegal = stage(spark, "own_initiative_illegal", two(lambda p: own("main", "TOTAL", 1.0, 1.0, source_period=p)), years)
    tc = stage(spark, "own_initiative_tc", [own_tc("main", "TOTAL", 1.0, 0.0, source_period="annual_2024")], years)
    summary, _ = _summary(spark, (notices, illegal, tc))
    assert summary.count() == 2
    loose, _ = _summary(spark, (notices, illegal, tc), by_period=False)
    assert loose.count() == 4
    trend = {r["reporting_period_canonical"]: r for r in tr.period_trends(summary).collect()}
    assert trend["annual_2025"]["total_decisions_delta_vs_prior"] == 3 - 4
    assert trend["annual_2025"]["period_seq"] == 2


def test_member_states(spark):
    orders = stage(spark, "member_states_orders", [
        dict(source_product="main", category_of_illegal_content=c, scope=s, n_orders_to_act=n, median_time_to_inform_act=m)
        for c, s, n, m in (("A", "TOTAL", 3.0, 1.0), ("B", "TOTAL", 4.0, 2.0), ("A", "DE", 9.0, 9.0), (None, "TOTAL", 8.0, 8.0))
    ])
    seed = spark.createDataFrame([("EU_AGGREGATE", "all", True, True), ("GR", "Greece", True, False), ("EL", "Greece", True, False)],
                                 "member_state_code string, member_state_name string, is_eu boolean, is_aggregate boolean")
    fact = tr.fct_eu_orders(orders)
    assert fact.count() == 3 and {r[0] for r in fact.select("member_state_id").collect()} == {"EU_AGGREGATE"}
    row = tr.member_state_breakdown(fact, tr.dim_member_states(seed)).collect()[0]
    assert (row["orders_to_act"], row["avg_median_time_to_inform_act_hours"], row["member_state_name"]) == (7, 1.5, "all")


def test_users_flags(spark):
    df = spark.createDataFrame(
        [("u_99000001", "family"), ("u_00000001", "free"), ("ux9905", None), (None, "family")], "user_id string, plan_type string"
    ).selectExpr("user_id", "'SE' country", "plan_type", "'bad' signup_ts", "'18-24' age_band", "'h' household_id")
    got = {r["user_id"]: (r["is_family_plan"], r["is_synth_fraud_injected_user"], r["signup_ts"]) for r in st.stage_table(df, "users").collect()}
    assert got == {"u_99000001": (True, True, None), "u_00000001": (False, False, None), "ux9905": (False, True, None),
                   None: (True, False, None)}


def test_sheet_headers():
    assert sheet_columns("appeals_and_recidivism") == [
        "applicability", "service", "reporting_period", "section", "indicator", "scope", "value", "contextual_information"]
    assert sheet_columns("qualitative") == ["applicability", "service", "reporting_period", "indicator", "value"]
    assert len(sheet_columns("notices")) == 5 + 20 and len(sheet_columns("own_initiative_tc")) == 5 + 32
