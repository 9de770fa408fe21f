"""Bronze tables all the way to stored marts, and the declared tests over them."""

from datetime import datetime, timedelta

from test_transparency import bronze, notice, own, own_tc

from glasswatch.operators import transparency
from glasswatch.operators.staging import SHEETS
from glasswatch.plans import expectations as ex
from glasswatch.plans import marts
from glasswatch.schemas import BRONZE

T0 = datetime(2026, 4, 30)
LINES = ("main", "artists", "authors", "creators")


def _sheets(spark):
    kinds = {"Accuracy": 1.0, "Precision": 0.9, "Recall": 0.9}
    rows = {
        "report_identification": [dict(source_product=p, indicator="i", value="v") for p in LINES],
        "categories_names": [
            dict(source_product=p, category_label=c, category_of_illegal_or_tc=c) for p in LINES for c in ("TOTAL", "Category 1")
        ],
        "member_states_orders": [
            dict(source_product=p, scope="TOTAL", category_of_illegal_content="TOTAL", n_orders_to_act=2.0) for p in LINES
        ],
        "notices": [notice(p, c, 1.0, 2.0, 3.0) for p in LINES for c in ("TOTAL", "Category 1")],
        "own_initiative_illegal": [own(p, "TOTAL", 4.0, 1.0) for p in LINES],
        "own_initiative_tc": [own_tc(p, "TOTAL", 4.0, 1.0) for p in LINES],
        "appeals_and_recidivism": [
            dict(source_product=p, section="s", indicator="Number of complaints submitted to x", value=3.0) for p in LINES
        ],
        "automated_means": [
            dict(source_product=p, scope="Total number", indicator=f"Accuracy of the automated means - {k}", value=v)
            for p in LINES for k, v in kinds.items()
        ],
        "qualitative": [dict(source_product=p, indicator="i", value="text") for p in LINES],
    }
    return {s: bronze(spark, s, rows[s]) for s in SHEETS}


def _tables(spark):
    rows = {
        "users": [(f"u_{i:08d}", "SE", "family", T0, "25-34", "h_00000001") for i in range(5)],
        "artists": [("a_00000001", "x", "US", "d", 5)],
        "tracks": [(f"t_{i:08d}", "a_00000001", "x", "SE-ABC-25-00001", 20000, T0.date(), "d", False) for i in range(2)],
        "streams": [
            (f"s_{i:010d}", f"u_{i % 5:08d}", "t_00000000", T0 - timedelta(hours=i % 24), "SE", "web", 1, f"se_{i:012x}")
            for i in range(120)
        ],
        "moderation_actions": [("m_00000001", "track", "t_00000000", "VIOLENCE", "remove", "manual", T0, "user_notice")],
        "appeals": [("ap_000001", "m_00000001", T0, None, "pending", None)],
        "llm_verdicts": [
            ("v_" + c * 16, "family_plan_abuse", "t_00000000", p, "m", "recommend_remove", 0.9, "none", "r", "[]", T0, T0, 50,
             10, 1, 0.01, "0" * 64, None, "ok", None)
            for c, p in (("a", "anthropic"), ("b", "openai"), ("c", "google"))
        ],
        "researcher_keys": [("rk_1", "Ann", "U", "study", "h", T0, "active")],
        "researcher_queries": [("q_1", "rk_1", "/schema", "{}", 10, 200, 5, T0, "h")],
    }
    return {n: spark.createDataFrame(r, BRONZE[n]) for n, r in rows.items()}


def test_from_bronze_to_passing_marts(spark, tmp_path):
    root = str(tmp_path)
    sheets, tables = marts.staged_sheets(_sheets(spark)), marts.staged_tables(_tables(spark))
    seed = transparency.member_state_seed(spark)
    assert seed.count() == 29
    keep = marts.written(spark, root)
    out = marts.transparency_marts(sheets, seed, "P", keep)
    out |= marts.store(spark, marts.safety_marts(tables), root)
    out |= marts.verdict_marts(tables, out["fct_artificial_streaming_flags"], keep)
    out |= marts.researcher_marts(tables, keep=keep)
    # a mart that reads others reads what was written
    posture = transparency.automated_vs_human(out["rpt_cross_product_summary"])
    assert all("/rpt_cross_product_summary/" in f for f in posture.inputFiles())
    out |= sheets | tables | {"eu_member_states": seed}
    missing = set(ex.EXPECTATIONS) - set(out)
    assert missing == {"fraud_scenario_expectations"}
    failures = [tuple(r) for r in ex.check_all(out).filter("n_failures > 0").collect()]
    assert failures == []
    flag = out["fct_artificial_streaming_flags"].collect()[0]
    assert flag["recommended_action"] == "recommend_remove"
    assert out["rpt_llm_agreement_rate"].collect()[0]["unanimous_agree"] == 1
    # facts are stored by product and period
    assert (tmp_path / "fct_dsa_decisions" / "product_line=main" / "reporting_period_canonical=annual_2025").is_dir()


def test_failures_are_counted(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 50), (None, "c", 7)], "id int, v string, n int")
    expect = ex.Expect(("id", "v"), ("id",), {"v": ("a", "b")}, {"n": (0, 10)}, {"id": ("parent", "id")})
    got = {r[0]: r[1] for r in ex.check_table(df, expect, {"parent": df.filter("id = 2")}).collect()}
    assert got == {"not_null:id": 1, "not_null:v": 1, "accepted_values:v": 1, "between:n": 1, "unique:id": 1, "relationships:id": 1}


def test_number_of_declared_tests():
    all_ = ex.EXPECTATIONS.values()
    counts = (
        sum(len(e.not_null) for e in all_), sum(len(e.unique) for e in all_),
        sum(len(e.accepted) for e in all_), sum(len(e.found_in) for e in all_), sum(len(e.between) for e in all_),
    )
    assert counts == (122, 29, 50, 9, 6)
