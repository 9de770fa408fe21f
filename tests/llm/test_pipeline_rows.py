"""Pipeline stages on rows without ids and with repeated ids: each row is judged by its own text."""

import numpy as np
import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(9)
    words = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 3000, n))
    item = words(40)
    texts = {name: words(80) for name in ("a", "b", "c", "d", "e")}
    texts |= {"bad": "one two three", "leak": words(60) + " " + item, "a2": texts["a"] + " more"}
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, texts


def stage(spark, folder, f, rows):
    path, texts = folder
    names = {t: n for n, t in texts.items()}
    docs = spark.createDataFrame([(i, texts[n], "en", None, len(texts[n])) for i, n in rows], SCHEMA)
    out = corpus_pipeline.stored(f(spark, docs, path), "stage")
    assert out.columns == docs.columns
    return sorted(((r["doc_id"], names[r["text"]]) for r in out.collect()), key=str)


def test_filters_judge_rows_by_their_text(spark, folder):
    rows = [(None, "a"), (None, "bad"), (None, "leak"), (7, "b"), (7, "bad"), (7, "leak"), (8, "c"), (8, "c")]
    for f, out in ((corpus_pipeline.quality_rules, "bad"), (corpus_pipeline.decontamination, "leak")):
        assert stage(spark, folder, f, rows) == sorted((r for r in rows if r[1] != out), key=str)


def test_near_duplicates_without_ids(spark, folder):
    rows = [(None, "a"), (None, "a"), (None, "a2"), (None, "b"), (5, "b"), (4, "c"), (3, "c"), (7, "d"), (7, "e"), (6, "e"), (6, "e")]
    assert stage(spark, folder, corpus_pipeline.near_duplicates, rows) in (
        sorted([(None, x), (5, "b"), (3, "c"), (7, "d"), (6, "e")], key=str) for x in ("a", "a2")
    )
