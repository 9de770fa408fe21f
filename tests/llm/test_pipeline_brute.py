"""Every filter stage of the pipeline against a brute-force version, on bad, copied and contaminated documents."""

import numpy as np

import corpus_pipeline
from glasswatch.llm.decontaminate import last_sentence

from .test_operators import components, lcs, quality_counts

rng = np.random.default_rng(21)


def prose(n):
    return " ".join(f"w{i}" for i in rng.integers(0, 2000, n))


def test_stages_keep_what_brute_force_keeps(spark, tmp_path):
    items = [prose(int(n)) for n in rng.integers(20, 50, 6)]
    texts = [prose(60) for _ in range(170)]  # good ones, labelled
    texts += [prose(50) + " ##### ***** $$$$$ %%%%% ##### *****" for _ in range(25)]  # bad ones, of which 15 are labelled
    texts += [prose(int(n)) for n in (0, 1, 5, 9, 10)] + ["again and again and again " * 8]
    labels = [(i, int(i < 170)) for i in range(185)]
    for i in range(12):  # copies with a word changed here and there
        copy = texts[3 * i].split()
        for j in range(i // 3):
            copy[5 + 11 * j] = "changed"
        texts.append(" ".join(copy))
    for i, item in enumerate(items):
        for share in (0, 0.2, 0.3, 0.5):
            copy = item.split()
            for j in rng.permutation(len(copy))[: int(share * len(copy))]:
                copy[j] = f"x{i}y{j}"
            texts.append(prose(50) + " " + " ".join(copy) + " " + prose(20))
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def good(t):
        n, chars, symbols, _, repeated = quality_counts(t)
        return n >= 10 and 100 * repeated <= 20 * n and symbols == 0

    def leaked(t):
        words = t.lower().split()
        for item in items:
            share, answer = (lcs(x, words) / len(x) for x in (item.split(), last_sentence(item).split()))
            if share >= 0.8 or share >= 0.6 and answer >= 0.5:
                return True
        return False

    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    now = {r[0]: r[1] for r in rows}
    for stage, keep in (
        (corpus_pipeline.quality_rules, lambda d: good(now[d])),
        (corpus_pipeline.near_duplicates, lambda d: d in firsts),
        (corpus_pipeline.decontamination, lambda d: not leaked(now[d])),
    ):
        firsts = {root for _, _, root in components(list(now.items()), 5, 80)}
        want = {d: t for d, t in now.items() if keep(d)}
        assert 0 < len(want) < len(now)
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), "stage")
        assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(want)
        now = want
