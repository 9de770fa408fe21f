"""Cases that earlier versions got wrong: space marks in texts, long names in licence notices, more hash ranges than listed n-grams,
very many secrets in a text."""

import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from glasswatch.llm import licenses, ngram_join, secret_scan
from glasswatch.llm.token_counts import Counter


def test_counts_of_texts_with_marks_equal_the_library():
    counter = Counter(public_tokenizers.path("piece_bpe_32k.model"))
    r = random.Random(3)
    parts = ["▁", "▁▁", " ", "a", "the", "é", "\n", "\t", "<s>", "</s>", "<unk>", "x9", "漢", "　", "\xa0", "\x00"]
    texts = ["▁ ", "▁  a", "▁", *("".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(5000))]
    assert [counter.count(t) for t in texts] == [len(counter.model.encode(t)) for t in texts]


def test_names_of_any_length(spark):
    name = " ".join(f"holder{i}" for i in range(300))
    notice = "\n".join([*licenses.BSD, licenses.NO_ENDORSEMENT.replace("<name>", name)])
    docs = spark.createDataFrame([(1, notice), (2, "\n".join(licenses.BSD))], "doc_id long, text string")
    found = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(docs).collect()}
    assert found == {1: "BSD-3-Clause", 2: "BSD-2-Clause"}


def test_list_of_frequent_ngrams_never_exceeds_its_limit(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit(f"w{i}") for i in range(400)]).alias("text"))
    listed, _ = ngram_join.frequent_ngrams(docs, 4, limit=5)  # fewer than the 64 ranges
    assert 0 < len(listed) <= 5


def test_texts_with_very_many_secrets(spark):
    run, n = "0123456789abcdef01234567", 100_000
    docs = spark.createDataFrame([(1, f"é{run} " * n), (2, run), (3, ""), (4, None)], "doc_id long, text string")
    found = secret_scan.secret_scan(docs).select("doc_id", F.size("base").alias("n"), F.try_element_at("base", F.lit(-1)).alias("last"))
    got = {r["doc_id"]: (r["n"], r["last"] and (r["last"]["start"], r["last"]["end"])) for r in found.collect()}
    end = 26 * n - 1
    assert got == {1: (n, (end - 24, end)), 2: (1, (0, 24)), 3: (0, None), 4: (0, None)}


def test_sets_of_many_texts_take_little_memory_at_a_time():
    words = " ".join(f"w{i}" for i in range(400))
    texts = pa.array([f"{i} {words} {i}" for i in range(2000)])
    list(ngram_join._sets(texts.slice(0, 10), 5))
    tracemalloc.start()
    try:
        found = sum(len(h) for _, _, h in ngram_join._sets(texts, 5))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 2000 * 398
    assert peak < 30 << 20
