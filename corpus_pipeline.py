"""A training corpus from raw documents: quality rules, near duplicates, benchmark decontamination, mixing, token files.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read back as the next stage's
documents. All but the last keep the columns of ``documents``, whatever they are called. Decontamination judges a row in the
pass that reads its text; the others know a row by a hash of its columns. So rows without id or with one id are each judged by their own
text. Texts without words fail the base rules; texts of any length are read whole. Empty tables give empty results.

A stage's work tables are deleted when the next stage begins, by which time its result is written.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasswatch.llm import decontaminate, mixing, ngram_join, quality, token_files
from glasswatch.llm.mixing import free_name
from glasswatch.llm.tables import delete, stored, work_folder
from glasswatch.session import new_path


#: Keys of eight bytes that may be sent to all tasks.
SENT_ROWS = 1 << 20


def in_work_folder(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with work_folder(spark, docs):
            return stage(spark, docs, sf_dir)

    return run


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``key``, a hash of all columns and of which are null: rows with one key are alike, whatever their ids."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn(key, F.xxhash64(*[c.isNull() for c in columns], *columns))


def _only(docs: DataFrame, key: str, rows: DataFrame, how: str) -> DataFrame:
    """The documents whose key is (``left_semi``) or isn't (``left_anti``) among ``rows(_row)``, a stored table.

    Its rows are counted before the join is planned: up to SENT_ROWS keys go to all tasks, and texts stay where they are. Beyond that Spark
    decides, and may shuffle both sides by the key.
    """
    keyed = _keyed(docs, key)
    rows = F.broadcast(rows) if rows.count() <= SENT_ROWS else rows
    return keyed.join(rows, keyed[key] == rows["_row"], how).select(*[F.col(f"`{c}`") for c in docs.columns])


@in_work_folder
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs; each row is judged by its own text."""
    key = free_name(docs, "_row")
    keyed = _keyed(docs, key).withColumn("_row", F.col(f"`{key}`"))
    verdicts = quality.quality_verdicts(keyed, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=("_row",))
    return _only(docs, key, stored(verdicts.filter("not kept").select("_row").distinct(), "rejected"), "left_anti")


@in_work_folder
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id; one without id only if none has one. Of equal rows one."""
    key = free_name(docs, "_row")
    keyed = _keyed(docs, key).select(F.col(f"`{key}`").alias("_row"), "doc_id", "text")
    groups = ngram_join.ngram_components(keyed.select(F.col("_row").alias("doc_id"), "text"), size=5, percent=80)
    groups = groups.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = keyed.select("_row", "doc_id").groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("n"))
    rows = stored(groups.join(ids, "_row").select("component_id", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row").alias("f"), "n"), "rows")
    first = rows.groupBy("component_id").agg(F.min("f").alias("first"))
    judged = rows.join(first, "component_id").select("f._row", "n", (F.col("f._row") == F.col("first._row")).alias("stays"))
    # rows that occur several times are taken out too, and one of each that stays is put back
    out = stored(judged.filter("not stays or n > 1"), "out")
    left = _only(docs, key, out.select("_row"), "left_anti")
    again = stored(out.filter("stays").select("_row"), "again")
    return left if again.isEmpty() else left.union(_only(docs, key, again, "left_semi").distinct())


@in_work_folder
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each row is judged by its own text."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_work_folder
def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them, in training order."""
    return mixing.mixed(docs)


@in_work_folder
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back: offset, length and checksum of every document."""
    read = token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing_weights),
    ("token files", token_output),
]

#: Links, latent retrieval and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
