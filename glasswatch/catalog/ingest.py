"""Sources, sinks and the checks on the way in."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.catalog import tables as t
from glasswatch.catalog.registry import register
from glasswatch.plans import deliveries
from glasswatch.schemas import BRONZE
from glasswatch.session import new_path
from glasswatch.sources import files, ingest, readers, sinks

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority"


def _merged(s, d):
    """Two deliveries with different columns, written and read back as one table."""
    orders = t.table(s, d, "orders")
    paid = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderpriority")
    other = orders.filter("o_orderstatus <> 'F'").select("o_orderstatus", "o_orderkey")
    paths = new_path(s, "delivery_a"), new_path(s, "delivery_b")
    sinks.write_mart(paid, paths[0])
    sinks.write_mart(other, paths[1])
    return readers.read_merged(s, *paths).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


register(
    "src_union_by_name", _merged,
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, nullif(o_orderstatus, 'F') AS "
    "o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority FROM orders",
)
_ORDER_SCHEMA = T.StructType(
    [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.TimestampNTZType())]
)
register(
    "src_parquet",
    lambda s, d: readers.read_parquet(s, f"{d}/orders.parquet", _ORDER_SCHEMA),
    "SELECT o_orderkey, o_orderdate FROM orders",
    times="o_orderdate",
)


def _csv(s, d):
    path = new_path(s, "keys_csv")
    t.raw_keys(s, d).write.option("header", True).csv(path)
    return readers.read_csv(s, path, BRONZE["researcher_keys"])


register("src_csv_header", _csv, "SELECT * FROM keys", "keys", times="created_at")


def _seed(s, d):
    path = new_path(s, "states_csv")
    t.member_states(s, d).write.option("header", True).csv(path)
    return readers.read_seed(s, path, "eu_member_states")


register(
    "src_seed", _seed,
    "SELECT member_state_id AS member_state_code, member_state_name, is_eu, is_aggregate FROM member_states",
    "member_states",
)


def _scenarios(s, d):
    """Scenario documents written as JSON, one per part; small parts expect no tracks, some have no list at all."""
    key = F.col("p_partkey").cast("string")
    docs = t.table(s, d, "part").select(
        F.concat_ws("/", "p_brand", key).alias("scenario_id"),
        F.col("p_size").alias("expected_score_min"),
        F.when(F.col("p_size") > 10, F.array(key, F.concat(key, F.lit("b")))).when(F.col("p_size") > 5, F.array().cast("array<string>"))
        .alias("track_ids"),
    )
    path = new_path(s, "scenarios")
    # each file holds one document, as delivered
    files.write_each(docs.select(F.col("scenario_id").alias("document"), F.to_json(F.struct(*docs.columns)).alias("json")), path)
    return readers.read_scenarios(s, path)


register(
    "src_scenario_json", _scenarios,
    "SELECT p_brand || '/' || p_partkey AS scenario_id, unnest([CAST(p_partkey AS VARCHAR), p_partkey || 'b']) AS track_id, "
    "p_size AS expected_min_score FROM part WHERE p_size > 10",
)
_HEADER = ("small", "ring")
register(
    "ingest_schema_contract",
    # words of a part's name as the delivered header
    lambda s, d: ingest.header_drift(
        t.table(s, d, "part").select(F.col("p_partkey").alias("source"), F.split("p_name", " ").alias("header")), _HEADER
    ),
    "SELECT source, CAST(i AS INTEGER) AS position, h[i + 1] AS got, w[i + 1] AS want FROM (SELECT p_partkey AS source, "
    "string_split(p_name, ' ') AS h, ['small', 'ring'] AS w, unnest(range(greatest(2, len(string_split(p_name, ' '))))) "
    "AS i FROM part) WHERE h[i + 1] IS DISTINCT FROM w[i + 1]",
)


_PART = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_size", T.LongType()), T.StructField("p_name", T.StringType())])


def _delivered_parts(s, d):
    """Parts as Parquet files, a folder for each brand. Brands 1x deliver sizes as text, 2x in another order, 3x without names, 4x a column more."""
    parts = t.table(s, d, "part").select("p_brand", F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("long").alias("p_size"), "p_name")
    path = new_path(s, "parts")
    shapes = {
        "Brand#1%": parts.withColumn("p_size", F.col("p_size").cast("string")),
        "Brand#2%": parts.select("p_brand", "p_size", "p_partkey", "p_name"),
        "Brand#3%": parts.drop("p_name"),
        "Brand#4%": parts.withColumn("note", F.lit("x")),
    }
    others = reduce(lambda c, brand: c & ~F.col("p_brand").like(brand), shapes, F.lit(True))
    for which, shaped in [(F.col("p_brand").like(brand), shaped) for brand, shaped in shapes.items()] + [(others, parts)]:
        sinks.clustered(shaped.filter(which), ["p_brand"]).write.mode("append").partitionBy("p_brand").parquet(path)
    breaches = deliveries.contract_breaches(s, path, _PART)
    return breaches.withColumn("source", F.regexp_extract("source", r"p_brand=Brand(?:#|%23)(\d+)/", 1)).distinct()


register(
    "ingest_file_contract", _delivered_parts,
    "SELECT DISTINCT string_split(p_brand, '#')[-1] AS source, CAST(c[2] AS INTEGER) AS position, c[3] AS got, c[4] AS want FROM part JOIN "
    "(SELECT unnest([['1', '1', 'p_size string', 'p_size bigint'], ['2', '0', 'p_size bigint', 'p_partkey bigint'], "
    "['2', '1', 'p_partkey bigint', 'p_size bigint'], ['3', '2', NULL, 'p_name string'], ['4', '3', 'note string', NULL]]) AS c) "
    "ON starts_with(string_split(p_brand, '#')[-1], c[1])",
)


def _cells(s, d):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    orders = t.table(s, d, "orders").select(
        "o_orderkey",
        F.when(status == "F", " N/A\t").when(priority == "5-LOW", "").when(priority == "2-HIGH", "Na").otherwise(
            F.concat(F.lit(" "), priority, F.lit(" "))
        ).alias("cell"),
        F.when(status == "P", F.col("o_orderdate") + F.expr("INTERVAL '10:30' HOUR TO MINUTE")).otherwise(F.col("o_orderdate")).alias("at"),
    )
    return ingest.normalise_cells(orders)


register(
    "ingest_norm_cells", _cells,
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority NOT IN ('5-LOW', '2-HIGH') THEN ' ' || "
    "o_orderpriority || ' ' END AS cell, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN "
    "'T10:30:00' ELSE '' END AS \"at\" FROM orders",
)


def _sparse(s, d):
    """Orders as sheet rows whose cells are mostly blank."""
    blank = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    rows = t.table(s, d, "orders").select(
        blank.alias("a"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderstatus")).alias("b"),
        F.col("o_orderkey").alias("source_row_index"),
    )
    return ingest.drop_empty_rows(ingest.normalise_cells(rows))


register(
    "ingest_drop_empty_rows", _sparse,
    "SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS a, CASE WHEN o_totalprice > 250000 THEN "
    "o_orderstatus END AS b, o_orderkey AS source_row_index FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 250000",
)
register(
    "ingest_provenance",
    lambda s, d: ingest.stamp_provenance(
        t.table(s, d, "documents").select("text", "doc_id", "source"),
        F.col("source"), F.lit("annual_2025"), F.lit("9_qualitative"), F.col("doc_id"), F.sha2("text", 256),
    ).drop("doc_id", "source"),
    "SELECT text, source AS source_product, 'annual_2025' AS source_period, '9_qualitative' AS source_sheet, doc_id + 2 AS "
    "source_row_index, sha256(text) AS source_sha256 FROM documents",
)
register(
    "ingest_typed_by_prefix",
    lambda s, d: ingest.typed_by_prefix(
        t.table(s, d, "orders").selectExpr(
            "cast(o_orderkey as string) source_row_index", "cast(o_totalprice as string) n_total",
            "o_orderpriority median_priority", "o_custkey ctx_n_total", "cast(o_custkey as string) value", "o_orderstatus scope",
        ),
        "automated_means",
    ),
    "SELECT o_orderkey AS source_row_index, o_totalprice AS n_total, TRY_CAST(o_orderpriority AS DOUBLE) AS "
    "median_priority, CAST(o_custkey AS VARCHAR) AS ctx_n_total, CAST(o_custkey AS DOUBLE) AS value, o_orderstatus AS scope "
    "FROM orders",
    rounded="n_total median_priority value",
)


def _play_rows(s, d):
    """Line items under play-event names; about half of them break a rule."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")

    def numbered(prefix, column, width):
        return F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), width, "0"))

    return t.table(s, d, "lineitem").select(
        numbered("s_", "l_orderkey", 10).alias("stream_id"),
        F.when(flag == "R", numbered("u_", "l_suppkey", 7)).otherwise(numbered("u_", "l_suppkey", 8)).alias("user_id"),
        numbered("t_", "l_partkey", 8).alias("track_id"),
        F.col("l_shipdate").alias("ts"),
        F.when(status == "O", "DE").when(F.col("l_quantity") > 25, "D").otherwise("FR").alias("country"),
        F.when(F.col("l_linenumber") == 7, "radio").otherwise("web").alias("device"),
        (F.col("l_quantity") - 3).cast("bigint").alias("ms_played"),
        F.when(F.col("l_linenumber") != 6, F.concat(F.lit("se_"), F.substring(F.md5(F.col("l_orderkey").cast("string")), 1, 12))).alias("session_id"),
    )


register(
    "ingest_row_constraints",
    lambda s, d: ingest.violations(_play_rows(s, d), "streams").select("stream_id", "track_id", "violations"),
    "SELECT 's_' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS stream_id, 't_' || lpad(CAST(l_partkey AS VARCHAR), 8, "
    "'0') AS track_id, concat_ws(',', CASE WHEN l_returnflag = 'R' THEN 'user_id' END, CASE WHEN l_linestatus <> 'O' AND "
    "l_quantity > 25 THEN 'country' END, CASE WHEN l_linenumber = 7 THEN 'device' END, CASE WHEN l_quantity < 3 THEN "
    "'ms_played' END, CASE WHEN l_linenumber = 6 THEN 'session_id' END) AS violations FROM lineitem",
)


def _changed(s, d):
    """Documents as files; the manifest misses one source and has an old hash for French ones."""
    docs = t.table(s, d, "documents")
    path = F.concat(F.lit("f/"), F.col("doc_id").cast("string"))
    files = docs.select(path.alias("path"), F.col("text").cast("binary").alias("content"))
    manifest = docs.filter("source <> 'src0'").select(
        path.alias("path"), F.when(F.col("lang") == "fr", "old").otherwise(F.sha2("text", 256)).alias("sha256")
    )
    return ingest.changed_files(files, manifest)


register(
    "ingest_changed_files", _changed,
    "SELECT 'f/' || doc_id AS path, sha256(text) AS sha256, CASE WHEN source = 'src0' THEN NULL WHEN lang = 'fr' THEN 'old' "
    "ELSE sha256(text) END AS previous_sha256, source = 'src0' OR lang = 'fr' AS changed FROM documents",
)


def _files_twice(s, d):
    """Documents as files, one each, read twice: in between Spanish ones are withdrawn, French ones rewritten, and source src0 comes."""
    docs = t.table(s, d, "documents").select("doc_id", "lang", "source", "text")
    first, second, manifests = (new_path(s, f"files_{n}") for n in ("first", "second", "manifests"))
    rewritten = F.when(F.col("lang") == "fr", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    files.write_each(docs.filter("source is distinct from 'src0'").select("doc_id", "text"), first)
    named = F.regexp_extract("path", r"/(doc_id=\d+)(/|$)", 1)
    deliveries.check_delivery(s, first, manifests, named)
    files.delete(s, first)  # the next run meets the manifest only
    files.write_each(docs.filter("lang is distinct from 'es'").select("doc_id", rewritten.alias("text")), second)
    return deliveries.check_delivery(s, second, manifests, named)


_FIRST = "source <> 'src0'"
_SECOND = "lang <> 'es'"
_OLD = f"CASE WHEN {_FIRST} THEN sha256(text || chr(10)) END"
_NEW = f"CASE WHEN {_SECOND} THEN sha256(text || CASE WHEN lang = 'fr' THEN '!' ELSE '' END || chr(10)) END"
register(
    "ingest_delivered_files", _files_twice,
    f"SELECT 'doc_id=' || doc_id AS file, {_NEW} AS sha256, {_OLD} AS previous_sha256, CASE WHEN NOT ({_SECOND}) THEN 'gone' WHEN NOT "
    f"({_FIRST}) THEN 'new' WHEN lang = 'fr' THEN 'changed' ELSE 'same' END AS status FROM documents WHERE {_FIRST} OR {_SECOND}",
)


def _reloaded(s, d):
    """A table partitioned by status, loaded twice: the second load only replaces the partition it brings."""
    orders = t.table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    path = new_path(s, "reload")
    parts = {v: orders.filter(F.col("o_orderstatus") == v) for v in ("F", "O", "P")}
    sinks.truncate_reload(parts, path, ["o_orderstatus"])
    sinks.truncate_reload({"P": parts["P"].withColumn("o_custkey", -F.col("o_custkey"))}, path, ["o_orderstatus"])
    return s.read.schema(orders.schema).parquet(path)


register(
    "sink_truncate_reload", _reloaded,
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS o_custkey, o_orderpriority, "
    "o_orderstatus FROM orders",
)


def _sorted(s, d):
    """Written in order and read back: every file with its range must not overlap the next one's."""
    path = new_path(s, "sorted")
    events = t.table(s, d, "events").select("ts", "event_id", F.array("event_type", "props").alias("tags"))
    sinks.write_sorted(events, path)
    return s.read.parquet(path)


register(
    "sink_sorted_parquet", _sorted,
    "SELECT ts, event_id, '[\"' || event_type || '\",\"' || replace(props, '\"', '\\\"') || '\"]' AS tags FROM events",
    times="ts",
)


def _appended(s, d):
    path = new_path(s, "audit")
    log = t.requests(s, d)
    for endpoint in ("/schema", "/dsa/categories"):
        sinks.append_rows(log.filter(F.col("endpoint") == endpoint), path)
    sinks.append_rows(log.filter(~F.col("endpoint").isin("/schema", "/dsa/categories")), path)
    return s.read.schema(log.schema).parquet(path)


register("sink_append_audit", _appended, "SELECT * FROM requests", "requests", times="requested_at")
