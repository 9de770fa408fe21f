"""Fill-in-the-middle texts against a version that works on Python strings."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glasswatch.llm import fill_middle
from glasswatch.llm.fill_middle import exceptions

TEXTS = [None, "", "a", "é", "plain ascii text " * 5, "naïve café　\U0001f600x" * 7, "has <P> inside", "<S", "x<M>", "ends with <", "<P" * 9, "\x00\n\t"]
TEXTS += ["漢字" * 40_000, "w" * 200_000, "ab\U0001f468‍\U0001f469 c" * 3_000]


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    spm = h[3] % 100 < 20
    out = f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"
    return n, "spm" if spm else "psm", a, b - a, len(pre.encode()), len(mid.encode()), out


def test_texts_against_brute_force(spark):
    rows = [(None if i == 37 else i, TEXTS[i % len(TEXTS)], "x", i, "mine") for i in range(150)] + [(3, TEXTS[3], "x", 3, "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, row int, form string").repartition(4)
    out = fill_middle.fill_in_middle(docs)
    assert out.columns == ["doc_id", "_key", "row", "n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"]
    got = out.withColumn("back", fill_middle.restored("output", "form")).collect()
    assert len(got) == len(rows) and {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        text = TEXTS[r["row"] % len(TEXTS)]
        assert tuple(r)[3:10] == expected(r["doc_id"], text)
        assert r["back"] == (text or "") and r["_key"] == "x"


def test_shares_and_other_markers(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some text of words").alias("text"))
    markers = fill_middle.Markers("{pre}", "{suf}", "{mid}")
    out = fill_middle.fill_in_middle(docs, markers, plain_percent=50, spm_percent=100)
    counts = {r["form"]: r["count"] for r in out.groupBy("form").count().collect()}
    assert set(counts) == {"plain", "spm"} and 850 < counts["plain"] < 1150
    assert out.filter(fill_middle.restored("output", "form", markers) != "some text of words").count() == 0


def test_empty_table(spark):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("bad", [("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "ba", "c"), ("a", "xay", "c"), ("aba", "c", "d")])
def test_markers_that_cannot_be_told_apart(bad):
    with pytest.raises(ValueError):
        fill_middle.check_markers(fill_middle.Markers(*bad))


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_index_converts_both_ways(text):
    index = exceptions(np.frombuffer(text.encode(), np.uint8))
    places = np.arange(len(text) + 1)
    want = np.array([len(text[:i].encode()) for i in places])
    assert (index.to_bytes(places) == want).all() and (index.to_places(want) == places).all()
    assert len(index.place) == sum(ord(c) > 127 for c in text)
