"""Reading bronze tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.schemas import BRONZE, SCENARIO_DOCUMENT
from glasswatch.sources import files


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One Parquet table, with a declared schema or the file's own."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of several products as one table: columns by name, missing ones NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """The same for frames; keeps every row and every column any of them has."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line. The schema is declared, since a file without rows offers nothing to infer."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A reference CSV, such as the member states or the scenario expectations."""
    return read_csv(spark, path, BRONZE[name])


def read_scenarios(spark: SparkSession, path: str) -> DataFrame:
    """Scenario documents (one JSON object per file) as one row per expected track."""
    reader = spark.read.schema(SCENARIO_DOCUMENT)
    found = files.documents(spark, path)
    if found is None:
        return explode_scenarios(reader.option("multiLine", True).json(path))
    texts = getattr(found.select("text")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return explode_scenarios(DataFrame(reader._jreader.json(texts), spark))


def explode_scenarios(docs: DataFrame) -> DataFrame:
    """One row per (scenario, track); a document without tracks gives none."""
    return docs.select(
        "scenario_id", F.explode("track_ids").alias("track_id"), F.col("expected_score_min").alias("expected_min_score")
    )


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end`` for each row of ``bounds``."""
    days = F.sequence(F.col(start).cast("date"), F.date_sub(F.col(end).cast("date"), 1))
    return bounds.filter(F.col(start).cast("date") < F.col(end).cast("date")).select(
        F.explode(days).alias("date_day")
    ).distinct()
