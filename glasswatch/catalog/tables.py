"""The driver's tables in the roles of this domain, in Spark and as SQL pieces.

Plays are line items of an order (the session) by a customer (the listener); tracks are parts and artists suppliers.
Report sheets are yearly order and line-item counts per market segment (the product) and order priority (the
category). Verdicts and the request log are events.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glasswatch.catalog.registry import cte
from glasswatch.catalog.store import schema_of, stored
from glasswatch.config import SignalConfig, YearlyPeriods
from glasswatch.functions.expressions import count_when
from glasswatch.operators import signals, staging, transparency, verdicts
from glasswatch.sources.readers import read_parquet

# thresholds that fire on these tables
SIGNALS = SignalConfig(
    reference_time=datetime(2001, 11, 4),
    recent_days=95,
    baseline_days=270,
    spike_multiplier=2.0,
    spike_min_baseline_per_day=0.005,
    geo_share=0.15,
    geo_min_streams=20,
    ratio_threshold=1.03,
    ratio_min_streams=20,
    hhi_threshold=0.15,
    hhi_min_streams=20,
    stuffing_ai_share=0.5,
    stuffing_min_tracks=3,
    built_at=datetime(2001, 11, 4),
)
PERIODS = YearlyPeriods()
PLATFORM = "Sample"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_parquet(spark, path, schema_of(spark, path))


# --- plays -----------------------------------------------------------------------------------------------------


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays, as a stored table: the score reads them three times."""
    return stored(spark, sf_dir, "plays", _plays)


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # orders meet customers first: the small result is what line items are joined with
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("track_id"),
        F.col("l_shipdate").alias("streamed_at"),
        F.col("c_nationkey").alias("stream_country_iso2"),
        F.col("l_orderkey").alias("session_id"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), (F.col("c_custkey") % 10).alias("household_id")
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"),
        (F.col("p_partkey") % 10).alias("artist_id"),
        (F.col("p_type") == "PROMO").alias("ai_generated_label"),
        F.format_string("20%02d-01-01", F.col("p_size")).alias("release_date"),
    )


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_nationkey").alias("country_iso2")
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag mart, as its readers see it."""
    return stored(spark, sf_dir, "flags", computed_flags)


def computed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.artificial_streaming_flags(
        streams(spark, sf_dir), users(spark, sf_dir), tracks(spark, sf_dir), artists(spark, sf_dir), SIGNALS
    )


def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios are brands; the size is the score expected."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("scenario_id"),
        F.col("p_partkey").alias("track_id"),
        F.col("p_size").alias("expected_min_score"),
    )


cte(
    "streams",
    "SELECT o_custkey AS user_id, l_partkey AS track_id, l_shipdate AS streamed_at, c_nationkey AS country, "
    "l_orderkey AS session_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey",
)
cte("users", "SELECT c_custkey AS user_id, c_custkey % 10 AS household_id FROM customer")
cte(
    "tracks",
    "SELECT p_partkey AS track_id, p_partkey % 10 AS artist_id, p_type = 'PROMO' AS ai, "
    "'20' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-01-01' AS release_date FROM part",
)
cte("artists", "SELECT s_suppkey AS artist_id, s_nationkey AS home FROM supplier")
cte(
    "expectations",
    "SELECT p_brand AS scenario_id, p_partkey AS track_id, p_size AS expected_min_score FROM part",
)

# --- report sheets ---------------------------------------------------------------------------------------------


def _by_category(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """Yearly figures per product and category plus a TOTAL row, from one pass."""
    return (
        rows.groupingSets([["product", "y", "category"], ["product", "y"]], "product", "y", "category")
        .agg(F.grouping("category").alias("_all"), *aggregates)
        .withColumn("category", F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("category")))
        .drop("_all")
    )


def _stamped(df: DataFrame, sheet: str) -> DataFrame:
    return df.withColumns(
        {
            "source_product": F.col("product"),
            "source_period": F.concat(F.lit("annual_"), F.col("y").cast("string")),
            "source_sheet": F.lit(sheet),
            "source_row_index": (F.col("y") - 1993).cast("bigint"),
            "source_sha256": F.sha2(F.concat_ws("/", "product", "y"), 256),
            "applicability": F.lit("yes"),
            "service": F.col("product"),
            "reporting_period": F.col("y").cast("string"),
        }
    ).drop("product", "y")


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        F.col("c_mktsegment").alias("product"),
        F.year("o_orderdate").alias("y"),
        F.col("o_orderpriority").alias("category"),
        "c_nationkey",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    placed = _placed(spark, sf_dir).select("o_orderkey", "product", "y", "category")
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))


def _double(c: Column, name: str) -> Column:
    return c.cast("double").alias(name)


def _with_remarks(df: DataFrame, sheet: str) -> DataFrame:
    """Fill what the sheet has beyond the mapped columns: missing numbers and empty remarks."""
    layout = staging.SHEETS[sheet]
    blank = {m: F.lit(None).cast("double") for m in layout.metrics if m not in df.columns}
    remarks = {f"ctx_{m}": F.concat(F.lit("see "), F.col("source_period")) for m in layout.metrics}
    return df.withColumns({**blank, **remarks, "description_subcategory_other": F.lit(None).cast("string")})


def raw_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    sums = _by_category(
        _placed(spark, sf_dir),
        _double(F.count(F.lit(1)), "n_notices_received"),
        _double(count_when(status == "O"), "n_notices_from_trusted_flaggers"),
        _double(count_when(F.col("o_totalprice") > 200000), "n_items_in_notices"),
        _double(count_when((F.col("o_totalprice") > 200000) & (status == "O")), "n_items_in_tf_notices"),
        _double(F.max(F.dayofmonth("o_orderdate")), "median_time_to_take_action"),
        _double(F.min(F.dayofmonth("o_orderdate")), "median_time_to_take_action_tf"),
        _double(count_when(status == "F"), "n_actions_on_law"),
        _double(count_when(status == "P"), "n_actions_on_tc"),
    )
    return _with_remarks(
        _stamped(sums, "4_notices").withColumnRenamed("category", "category_of_illegal_content"), "notices"
    )


def _raw_own_initiative(spark: SparkSession, sf_dir: str, flag: str, sheet: str, column: str) -> DataFrame:
    line = F.col("l_linenumber")
    sums = _by_category(
        _lines(spark, sf_dir).filter(F.col("l_returnflag") == flag),
        _double(F.count(F.lit(1)), "n_measures_own_initiative"),
        _double(count_when(F.col("l_linestatus") == "F"), "n_measures_automated_detection"),
        _double(count_when(F.col("l_quantity") > 25), "vis_restriction_removal"),
        _double(count_when(F.col("l_quantity") > 49), "account_suspension"),
        # a count of none is left blank, as sheets do
        F.nullif(count_when((line == 7) & (F.col("l_quantity") > 48)), F.lit(0)).cast("double").alias(
            "account_termination"
        ),
    )
    return _with_remarks(_stamped(sums, sheet).withColumnRenamed("category", column), sheet)


def raw_illegal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_own_initiative(spark, sf_dir, "R", "own_initiative_illegal", "category_of_illegal_content")


def raw_tc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_own_initiative(spark, sf_dir, "A", "own_initiative_tc", "category_of_incompatibility_tc")


def _long(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """One row per indicator, from the named columns."""
    entries = [F.struct(F.lit(text).alias("indicator"), F.col(name).alias("value")) for name, text in pairs.items()]
    kept = [c for c in df.columns if c not in pairs]
    return df.select(*kept, F.explode(F.array(*entries)).alias("e")).select(*kept, "e.indicator", "e.value")


# indicator texts of the appeals and automated-means sheets, as the report template words them
APPEAL_INDICATORS = {
    "submitted": "Number of complaints submitted to the internal-complaints mechanism",
    "reversed": "Number of decisions reversed",
    "upheld": "Number of decisions upheld",
    "repeat": "Number of suspensions for recidivism",
}
MEANS_INDICATORS = {
    "accuracy": "Accuracy of the automated means - Accuracy",
    "precision_score": "Accuracy of the automated means - Precision",
    "recall": "Accuracy of the automated means - Recall",
    "solely": "Number of measures solely taken by automated means",
    "not_solely": "Number of measures not taken by automated means",
    "n_solely": "Number of notices solely processed by automated means",
    "n_not_solely": "Number of notices not processed by automated means",
}


def raw_appeals(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    wide = (
        _placed(spark, sf_dir)
        .groupBy("product", "y")
        .agg(
            _double(count_when(status == "O"), "submitted"),
            _double(count_when((status == "O") & (price > 300000)), "reversed"),
            _double(count_when((status == "O") & (price <= 300000)), "upheld"),
            _double(F.nullif(count_when(price > 499000), F.lit(0)), "repeat"),
        )
    )
    return _long(_stamped(wide, "appeals_and_recidivism"), APPEAL_INDICATORS).withColumns(
        {
            "section": F.lit("Internal complaints"),
            "scope": F.lit("Total number"),
            "contextual_information": F.lit(None).cast("string"),
        }
    )


def raw_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line status predicts the return flag: how well is the quality of the automated means."""
    truth, guess = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    both = count_when(truth & guess).cast("double")
    wide = (
        _lines(spark, sf_dir)
        .withColumn("scope", F.when(F.col("l_quantity") > 25, "Own-initiative ").otherwise("NAM Total"))
        .groupingSets([["product", "y", "scope"], ["product", "y"]], "product", "y", "scope")
        .agg(
            F.grouping("scope").alias("_all"),
            F.try_divide(count_when(truth == guess).cast("double"), F.count(F.lit(1))).alias("accuracy"),
            F.try_divide(both, count_when(guess)).alias("precision_score"),
            F.try_divide(both, count_when(truth)).alias("recall"),
            _double(count_when(guess), "solely"),
            _double(count_when(~guess), "not_solely"),
            _double(count_when(guess & truth), "n_solely"),
            _double(count_when(~guess & truth), "n_not_solely"),
        )
        .withColumn("scope", F.when(F.col("_all") == 1, "Total number").otherwise(F.col("scope")))
        .drop("_all")
    )
    return _long(_stamped(wide, "automated_means"), MEANS_INDICATORS).withColumns(
        {"section": F.lit("Automated means"), "contextual_information": F.lit(None).cast("string")}
    )


def raw_orders_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of authorities: per category and nation, and a TOTAL scope over all nations."""
    status = F.col("o_orderstatus")
    sums = (
        _placed(spark, sf_dir)
        .withColumn("scope", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
        .groupingSets(
            [["product", "y", "category", "scope"], ["product", "y", "category"]], "product", "y", "category", "scope"
        )
        .agg(
            F.grouping("scope").alias("_all"),
            _double(count_when(status == "F"), "n_orders_to_act"),
            _double(F.count(F.lit(1)), "n_items_in_orders_to_act"),
            _double(F.max(F.dayofmonth("o_orderdate")), "median_time_to_inform_act"),
            _double(F.min(F.dayofmonth("o_orderdate")), "median_time_to_give_effect_act"),
            _double(count_when(status == "P"), "n_orders_to_provide_info"),
        )
        .withColumn("scope", F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("scope")))
        .drop("_all")
    )
    return _with_remarks(
        _stamped(sums, "member_states_orders").withColumnRenamed("category", "category_of_illegal_content"),
        "member_states_orders",
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy read off the orders: priorities, priorities within a segment, and TOTAL. Segments are products."""
    placed = _placed(spark, sf_dir).select("product", "category").distinct()
    number = F.substring("category", 1, 1)
    labels = F.array(
        F.struct(F.concat(F.lit("Category "), number).alias("label"), F.nullif("category", F.lit("4-NOT SPECIFIED")).alias("code")),
        F.struct(
            F.concat(F.lit("Category "), number, F.lit(" in "), F.col("product")).alias("label"),
            F.when(F.col("category") != "5-LOW", F.lit("KEYWORD_OTHER")).alias("code"),
        ),
        F.struct(F.lit("TOTAL").alias("label"), F.lit("TOTAL").alias("code")),
    )
    return placed.select("product", "category", F.explode(labels).alias("l")).select(
        F.col("product").alias("source_product"),
        F.lit("annual_2025").alias("source_period"),
        F.col("l.label").alias("category_label"),
        F.concat(F.lit("about "), F.col("category")).alias("category_description"),
        F.col("l.code").alias("category_of_illegal_or_tc"),
        F.lit(None).cast("string").alias("contextual_information"),
        F.lit("categories_names").alias("source_sheet"),
        number.cast("bigint").alias("source_row_index"),
        F.sha2("product", 256).alias("source_sha256"),
    )


def raw_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per product and year: first and last day with an order."""
    wide = (
        _placed(spark, sf_dir)
        .groupBy("product", "y")
        .agg(
            F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first"),
            F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last"),
        )
    )
    return _long(
        _stamped(wide, "report_identification"),
        {"first": "Starting date of the reporting period", "last": "Ending date of the reporting period"},
    )


def raw_qualitative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as narrative text; the source is the product."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_product"),
        F.lit("annual_2025").alias("source_period"),
        F.lit("yes").alias("applicability"),
        F.col("lang").alias("service"),
        F.lit("2025").alias("reporting_period"),
        F.concat(F.lit("narrative "), F.col("lang")).alias("indicator"),
        F.col("text").alias("value"),
        F.lit("qualitative").alias("source_sheet"),
        F.col("doc_id").alias("source_row_index"),
        F.sha2("text", 256).alias("source_sha256"),
    )


RAW_SHEETS = {
    "report_identification": raw_identification,
    "categories_names": raw_categories,
    "member_states_orders": raw_orders_received,
    "notices": raw_notices,
    "own_initiative_illegal": raw_illegal,
    "own_initiative_tc": raw_tc,
    "appeals_and_recidivism": raw_appeals,
    "automated_means": raw_means,
    "qualitative": raw_qualitative,
}


def staged(spark: SparkSession, sf_dir: str, sheet: str) -> DataFrame:
    """A report sheet in its staged form, over the sheet as it was delivered."""
    return staging.stage_sheet(stored(spark, sf_dir, sheet, RAW_SHEETS[sheet]), sheet, PERIODS)


def three_sheets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    names = ("notices", "own_initiative_illegal", "own_initiative_tc")
    a, b, c = (staged(spark, sf_dir, s) for s in names)
    return a, b, c


def summary(spark: SparkSession, sf_dir: str, by_period: bool = True) -> DataFrame:
    return transparency.cross_product_summary(
        *three_sheets(spark, sf_dir), appeals_wide(spark, sf_dir), quality(spark, sf_dir), by_period
    )


def appeals_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transparency.appeals_wide(staged(spark, sf_dir, "appeals_and_recidivism"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transparency.automated_quality(staged(spark, sf_dir, "automated_means"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transparency.fct_decisions(transparency.unified(*three_sheets(spark, sf_dir)))


def appeals_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transparency.fct_appeals(appeals_wide(spark, sf_dir))


def categories_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transparency.dim_categories(staged(spark, sf_dir, "categories_names"), "BUILDING")


def member_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as member states, and the aggregate row beside the first of them."""
    nation = table(spark, sf_dir, "nation")
    own = F.struct(
        F.col("n_name").alias("member_state_code"),
        F.concat(F.lit("State "), F.col("n_name")).alias("member_state_name"),
        (F.col("n_regionkey") == 3).alias("is_eu"),
        F.lit(False).alias("is_aggregate"),
    )
    total = F.struct(
        F.lit("EU_AGGREGATE").alias("member_state_code"),
        F.lit("All states").alias("member_state_name"),
        F.lit(True).alias("is_eu"),
        F.lit(True).alias("is_aggregate"),
    )
    rows = F.when(F.col("n_nationkey") == 0, F.array(own, total)).otherwise(F.array(own))
    return nation.select(F.explode(rows).alias("r")).select("r.*")


cte(
    "placed",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, c_mktsegment AS product, year(o_orderdate) AS y, "
    "o_orderpriority AS category, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey",
)
cte(
    "lines",
    "SELECT l_linenumber, l_quantity, l_returnflag, l_linestatus, product, y, category "
    "FROM lineitem JOIN placed ON l_orderkey = o_orderkey",
    "placed",
)
_PERIOD_SQL = (
    "product AS product_line, 'annual_' || y AS reporting_period_canonical, make_date(y, 1, 1) AS "
    "reporting_period_start, make_date(y, 12, 31) AS reporting_period_end"
)
_CATEGORY_SQL = "CASE WHEN grouping(category) = 1 THEN 'TOTAL' ELSE category END AS category_code"
_SETS_SQL = "GROUP BY GROUPING SETS ((product, y, category), (product, y))"
_SHA_SQL = "sha256(product || '/' || y) AS source_sha256"
cte(
    "notices",
    f"SELECT {_PERIOD_SQL}, {_CATEGORY_SQL}, count(*) AS notices_received, "
    "count(*) FILTER (o_orderstatus = 'O') AS notices_from_trusted_flaggers, "
    "count(*) FILTER (o_totalprice > 200000) AS items_in_notices, "
    "count(*) FILTER (o_totalprice > 200000 AND o_orderstatus = 'O') AS items_in_tf_notices, "
    "CAST(max(day(o_orderdate)) AS DOUBLE) AS median_time_to_take_action_hours, "
    "CAST(min(day(o_orderdate)) AS DOUBLE) AS median_time_to_take_action_tf_hours, "
    "count(*) FILTER (o_orderstatus = 'F') AS actions_on_law, CAST(NULL AS BIGINT) AS actions_on_law_tf, "
    "count(*) FILTER (o_orderstatus = 'P') AS actions_on_tc, CAST(NULL AS BIGINT) AS actions_on_tc_tf, "
    f"{_SHA_SQL} FROM placed {_SETS_SQL}",
    "placed",
)
for _name, _flag in (("illegal", "R"), ("tc", "A")):
    cte(
        _name,
        f"SELECT {_PERIOD_SQL}, {_CATEGORY_SQL}, count(*) AS measures_own_initiative, "
        "count(*) FILTER (l_linestatus = 'F') AS measures_automated_detection, "
        "count(*) FILTER (l_quantity > 25) AS vis_restriction_removal, "
        "count(*) FILTER (l_quantity > 49) AS account_suspension, "
        "nullif(count(*) FILTER (l_linenumber = 7 AND l_quantity > 48), 0) AS account_termination, "
        f"{_SHA_SQL} FROM lines WHERE l_returnflag = '{_flag}' {_SETS_SQL}",
        "lines",
    )
cte(
    "appeals",
    f"SELECT {_PERIOD_SQL}, CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS complaints_submitted, "
    "CAST(count(*) FILTER (o_orderstatus = 'O' AND o_totalprice > 300000) AS DOUBLE) AS complaints_reversed, "
    "CAST(count(*) FILTER (o_orderstatus = 'O' AND o_totalprice <= 300000) AS DOUBLE) AS complaints_upheld, "
    "CAST(nullif(count(*) FILTER (o_totalprice > 499000), 0) AS DOUBLE) AS recidivism_count "
    "FROM placed GROUP BY product, y",
    "placed",
)
cte(
    "quality",
    f"SELECT {_PERIOD_SQL}, CASE WHEN grouping(s) = 1 THEN 'Total number' ELSE s END AS scope, "
    "CAST(count(*) FILTER ((l_returnflag = 'R') = (l_linestatus = 'F')) AS DOUBLE) / count(*) AS accuracy, "
    "CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS DOUBLE) "
    "/ nullif(count(*) FILTER (l_linestatus = 'F'), 0) AS precision_score, "
    "CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS DOUBLE) "
    "/ nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS recall, "
    "CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) AS measures_solely_automated, "
    "CAST(count(*) FILTER (l_linestatus <> 'F') AS DOUBLE) AS measures_not_automated, "
    "CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS DOUBLE) AS notices_solely_automated, "
    "CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus <> 'F') AS DOUBLE) AS notices_not_automated "
    "FROM (SELECT *, CASE WHEN l_quantity > 25 THEN 'Own-initiative ' ELSE 'NAM Total' END AS s FROM lines) "
    "GROUP BY GROUPING SETS ((product, y, s), (product, y))",
    "lines",
)
cte(
    "authority_orders",
    f"SELECT {_PERIOD_SQL}, category AS category_code, CASE WHEN grouping(s) = 1 THEN 'TOTAL' ELSE s END AS scope, "
    "count(*) FILTER (o_orderstatus = 'F') AS orders_to_act, count(*) AS items_in_orders_to_act, "
    "CAST(max(day(o_orderdate)) AS DOUBLE) AS median_time_to_inform_act_hours, "
    "CAST(min(day(o_orderdate)) AS DOUBLE) AS median_time_to_give_effect_act_hours, "
    "count(*) FILTER (o_orderstatus = 'P') AS orders_to_provide_info, "
    f"{_SHA_SQL} FROM (SELECT *, 'NATION_' || c_nationkey AS s FROM placed) "
    "GROUP BY GROUPING SETS ((product, y, category, s), (product, y, category))",
    "placed",
)
cte(
    "categories",
    "SELECT DISTINCT product, category, unnest(['Category ' || category[1], 'Category ' || category[1] || ' in ' || "
    "product, 'TOTAL']) AS label, unnest([nullif(category, '4-NOT SPECIFIED'), CASE WHEN category <> '5-LOW' THEN 'KEYWORD_OTHER' END, 'TOTAL']) "
    "AS code FROM placed",
    "placed",
)
cte(
    "member_states",
    "SELECT n_name AS member_state_id, 'State ' || n_name AS member_state_name, n_regionkey = 3 AS is_eu, "
    "false AS is_aggregate FROM nation UNION ALL "
    "SELECT 'EU_AGGREGATE', 'All states', true, true FROM nation WHERE n_nationkey = 0",
)

# --- verdicts and request log ----------------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _pick(c: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), c + 1)


def raw_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("k") >= 10
    e = events(spark, sf_dir)
    return e.select(
        F.concat(
            F.lit("v_"), F.substring(F.sha2(F.concat_ws(":", "event_type", "event_id"), 256), 1, 16)
        ).alias("verdict_id"),
        F.col("user_id").cast("string").alias("scenario_id"),
        (F.col("event_id") % 2500).cast("string").alias("track_id"),
        F.col("event_type").alias("provider"),
        F.concat(F.lit("model-"), F.col("event_type")).alias("model"),
        F.when(
            ok, _pick(F.col("k") % 3, "recommend_remove", "recommend_rank_lower", "recommend_no_action")
        ).alias("recommendation"),
        F.when(ok, F.col("k") / 100.0).alias("confidence"),
        F.when(ok, F.lit("listen_spike")).alias("primary_signal"),
        F.when(ok, F.concat(F.lit("because of "), F.col("k").cast("string"))).alias("reasoning"),
        F.lit("[]").alias("uncertainty_flags"),
        F.col("ts").alias("requested_at"),
        F.col("ts").alias("completed_at"),
        F.when(ok, F.floor(F.col("value") * 10)).otherwise(F.lit(0)).cast("bigint").alias("latency_ms"),
        (F.col("k") * 100).cast("bigint").alias("input_tokens"),
        (F.col("k") * 10).cast("bigint").alias("output_tokens"),
        (F.col("k") / 1000.0).alias("cost_usd"),
        F.sha2(F.col("user_id").cast("string"), 256).alias("prompt_hash"),
        F.when(ok, F.sha2(F.col("props"), 256)).alias("response_hash"),
        F.when(ok, "ok").otherwise("api_error").alias("status"),
        F.when(~ok, F.lit("timeout")).alias("error_class"),
    )


def staged_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_table(raw_verdicts(spark, sf_dir), "llm_verdicts")


def verdict_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = flags(spark, sf_dir).withColumn("track_id", F.col("track_id").cast("string"))
    return verdicts.with_heuristic(staged_verdicts(spark, sf_dir), scored)


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    kinds = {
        "click": "/dsa/cross_product",
        "view": "/dsa/time_series",
        "purchase": "/dsa/member_state",
        "signup": "/dsa/categories",
    }
    endpoint = F.lit("/schema")
    for event, path in kinds.items():
        endpoint = F.when(F.col("event_type") == event, path).otherwise(endpoint)
    return events(spark, sf_dir).select(
        F.concat(F.lit("q_"), F.col("event_id").cast("string")).alias("query_id"),
        F.concat(F.lit("rk_"), F.col("user_id").cast("string")).alias("key_id"),
        endpoint.alias("endpoint"),
        F.col("props").alias("query_params_json"),
        (k * 100).cast("bigint").alias("response_size_bytes"),
        F.when(k < 70, 200).when(k < 80, 429).when(k < 90, 404).otherwise(503).cast("bigint").alias(
            "response_status_code"
        ),
        F.floor(F.col("value") * 10).cast("bigint").alias("latency_ms"),
        F.col("ts").alias("requested_at"),
        F.sha2(F.col("user_id").cast("string"), 256).alias("client_ip_hash"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_table(raw_requests(spark, sf_dir), "researcher_queries")


def raw_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("rk_"), key.cast("string")).alias("key_id"),
        F.col("c_name").alias("researcher_name"),
        F.col("c_mktsegment").alias("institution"),
        F.lit("study").alias("purpose"),
        F.sha2(F.col("c_name"), 256).alias("email_hash"),
        F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("created_at"),
        F.when(F.col("c_acctbal") < 0, "revoked").when(F.col("c_acctbal") < 2000, "active").alias("status"),
    )


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_table(raw_keys(spark, sf_dir), "researcher_keys")


cte("ev", "SELECT *, CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS INTEGER) AS k FROM events")
cte(
    "verdicts",
    "SELECT 'v_' || substr(sha256(event_type || ':' || event_id), 1, 16) AS verdict_id, "
    "CAST(user_id AS VARCHAR) AS scenario_id, CAST(event_id % 2500 AS VARCHAR) AS track_id, event_type AS provider, "
    "'model-' || event_type AS model_name, CASE WHEN k >= 10 THEN 'ok' ELSE 'api_error' END AS status, "
    "CASE WHEN k < 10 THEN 'timeout' END AS error_class, "
    "CASE WHEN k >= 10 THEN ['recommend_remove', 'recommend_rank_lower', 'recommend_no_action'][k % 3 + 1] END "
    "AS recommendation, CASE WHEN k >= 10 THEN CAST(k AS DOUBLE) / 100 END AS confidence, "
    "CASE WHEN k >= 10 THEN 'listen_spike' END AS primary_signal, "
    "CASE WHEN k >= 10 THEN 'because of ' || k END AS reasoning, '[]' AS uncertainty_flags_json, "
    "ts AS requested_at, ts AS completed_at, "
    "CASE WHEN k >= 10 THEN CAST(floor(value * 10) AS BIGINT) ELSE 0 END AS latency_ms, "
    "CAST(k * 100 AS BIGINT) AS input_tokens, CAST(k * 10 AS BIGINT) AS output_tokens, "
    "CAST(k AS DOUBLE) / 1000 AS cost_usd, sha256(CAST(user_id AS VARCHAR)) AS prompt_hash, "
    "CASE WHEN k >= 10 THEN sha256(props) END AS response_hash "
    "FROM ev",
    "ev",
)
cte(
    "requests",
    "SELECT 'q_' || event_id AS query_id, 'rk_' || user_id AS key_id, "
    "CASE event_type WHEN 'click' THEN '/dsa/cross_product' WHEN 'view' THEN '/dsa/time_series' "
    "WHEN 'purchase' THEN '/dsa/member_state' WHEN 'signup' THEN '/dsa/categories' ELSE '/schema' END AS endpoint, "
    "props AS query_params_json, CAST(k * 100 AS BIGINT) AS response_size_bytes, "
    "CAST(CASE WHEN k < 70 THEN 200 WHEN k < 80 THEN 429 WHEN k < 90 THEN 404 ELSE 503 END AS BIGINT) "
    "AS response_status_code, CAST(floor(value * 10) AS BIGINT) AS latency_ms, ts AS requested_at, "
    "sha256(CAST(user_id AS VARCHAR)) AS client_ip_hash FROM ev",
    "ev",
)
cte(
    "keys",
    "SELECT 'rk_' || c_custkey AS key_id, c_name AS researcher_name, c_mktsegment AS institution, 'study' AS purpose, "
    "sha256(c_name) AS email_hash, TIMESTAMP '2024-01-01 00:00:00' AS created_at, "
    "CASE WHEN c_acctbal < 0 THEN 'revoked' WHEN c_acctbal < 2000 THEN 'active' END AS status FROM customer",
)
